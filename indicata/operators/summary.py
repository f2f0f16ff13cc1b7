"""Analytics layer: one nested row per discharge.

Shape on Spark: each child fact is aggregated once by ``patient_id``
(arrays of structs), and the discharge fact is left-joined to both
aggregates. The aggregates come out hash-partitioned by ``patient_id``, so
the assembly shuffles only the discharge fact.

Codes are looked up again by text, as in the source model, so an unmapped
code keeps a NULL ``code_sk`` inside its struct even though the fact row
carries a fallback key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.functions import text_list
from indicata.operators.facts import code_keys
from indicata.operators.joins import bounded_broadcast, lookup, narrowed
from indicata.operators.reference import code_identifiers
from indicata.operators.skew import counted, salt, salted_arrays

# Fixed value: text fallback for a DRG missing from the dimension.
DRG_TEXT_FALLBACK = "Unknown"


def _empty_ids():
    return F.array().cast(T.ArrayType(T.StringType()))


def _identifiers_lookup(df: DataFrame, ci: DataFrame, code_type: str, sk_col: str) -> DataFrame:
    ids = narrowed(ci, ci.filter(F.col("code_type") == code_type).select(F.col("code_sk").alias(sk_col), "identifiers"))
    return df.join(bounded_broadcast(ids), sk_col, "left").withColumn(
        "identifiers", F.coalesce(F.col("identifiers"), _empty_ids())
    )


def _by(code: str, year: int | None) -> list[str]:
    """Columns that a code is looked up by: with its row's own year where there is no one year."""
    return [code] if year is not None else [code, "reference_year"]


#: Runs: arrays of distinct elements with their number in this field.
RUN = "n"


def _lines(rows: DataFrame, columns: list[str], runs: bool) -> DataFrame:
    return counted(rows, *columns) if runs else rows.select(*columns)


def _run(runs: bool) -> list[Column]:
    return [F.col(RUN)] if runs else []


def _public_run(s: Column, runs: bool) -> list[Column]:
    return [s[RUN].alias(RUN)] if runs else []


def diagnosis_structs(diagnosis: DataFrame, dim: DataFrame, ci: DataFrame, year: int | None, runs: bool = False) -> DataFrame:
    """Diagnosis lines with the struct fields of the summary; with ``runs`` equal
    lines of an encounter are one row with their number."""
    columns = ["patient_id", *_by("diag_code", year), "diag_rank_num", "is_principal_diag", "is_present_on_admission"]
    looked = lookup(
        _lines(diagnosis, columns, runs),
        code_keys(dim, "Diagnosis", year, "diag_code", "code_sk"),
        _by("diag_code", year),
    )
    return _identifiers_lookup(looked, ci, "Diagnosis", "code_sk")


def _diag_struct(with_rank: bool, runs: bool = False) -> Column:
    fields = [
        F.col("diag_rank_num").alias("rank"),
        F.col("diag_code").alias("code"),
        F.col("is_present_on_admission").alias("is_present_on_admission"),
        F.col("code_sk").alias("code_sk"),
        F.col("identifiers").alias("identifiers"),
        *_run(runs),
    ]
    return F.struct(*(fields if with_rank else fields[1:]))


def _public_diag(s: Column, runs: bool = False) -> Column:
    return F.struct(
        s["code_sk"].alias("code_sk"),
        s["code"].alias("code"),
        s["identifiers"].alias("identifiers"),
        s["is_present_on_admission"].alias("is_present_on_admission"),
        *_public_run(s, runs),
    )


def _arrays(rows: DataFrame, arrays: dict[str, Column], least: dict[str, Column], salted: bool) -> DataFrame:
    """Sorted arrays and minima per encounter, in two salted stages for hot encounters."""
    if salted:
        return salted_arrays(rows, "patient_id", arrays, least, salt("code_sk"))
    return rows.groupBy("patient_id").agg(*[F.sort_array(F.collect_list(v)).alias(n) for n, v in arrays.items()], *[F.min(v).alias(n) for n, v in least.items()])


def diagnosis_arrays(diag_structs: DataFrame, salted: bool = False, runs: bool = False) -> DataFrame:
    """Per encounter: the principal diagnosis (first by rank, ties by code then
    present flag; NULL when none) and the ordered secondary diagnoses (their runs, see ``expanded``)."""
    principal = F.col("is_principal_diag") == 1
    agg = _arrays(diag_structs, {"_s": F.when(~principal, _diag_struct(True, runs))}, {"_p": F.when(principal, _diag_struct(True))}, salted)
    return agg.select(
        "patient_id",
        F.when(F.col("_p").isNotNull(), _public_diag(F.col("_p"))).alias("principal_diagnosis"),
        F.transform("_s", lambda s: _public_diag(s, runs)).alias("secondary_diagnoses"),
    )


def procedure_arrays(procedure: DataFrame, dim: DataFrame, ci: DataFrame, year: int | None, salted: bool = False, runs: bool = False) -> DataFrame:
    looked = lookup(
        _lines(procedure, ["patient_id", *_by("procedure_code", year)], runs),
        code_keys(dim, "Procedure", year, "procedure_code", "code_sk"),
        _by("procedure_code", year),
    )
    structs = _identifiers_lookup(looked, ci, "Procedure", "code_sk")
    agg = _arrays(structs, {"_p": F.struct(F.col("procedure_code").alias("code"), F.col("code_sk"), F.col("identifiers"), *_run(runs))}, {}, salted)
    return agg.select(
        "patient_id",
        F.transform(
            "_p",
            lambda s: F.struct(s["code_sk"].alias("code_sk"), s["code"].alias("code"), s["identifiers"].alias("identifiers"), *_public_run(s, runs)),
        ).alias("procedures"),
    )


def discharge_summary(
    discharge: DataFrame,
    diagnosis: DataFrame,
    procedure: DataFrame,
    dim: DataFrame,
    bridge: DataFrame | None,
    year: int | None,
    ci: DataFrame | None = None,
    runs: bool = False,
) -> DataFrame:
    """Nested one-row-per-discharge summary; arrays are never NULL.

    Without a ``year`` every row is looked up in its own ``reference_year``
    (``versioned.rekeyed``), and ``ci`` must be given.
    With ``runs``, for encounters with very many lines, equal lines are counted
    before anything else, and the arrays hold each distinct one once with its
    number ``n``: no row grows with an encounter's repeats (``flatten_summary``
    reads both forms, ``expanded`` repeats the elements). The arrays are built in
    two salted stages and written, and broadcast to the discharges if small.

    ``ci`` is the per-code identifier array table (``code_identifiers``) when
    it is already materialized; it is derived from ``bridge`` otherwise.
    """
    ci = ci if ci is not None else narrowed(bridge, code_identifiers(bridge, year))
    drg = _identifiers_lookup(
        lookup(discharge, code_keys(dim, "DRG", year, "drg", "_drg_sk"), _by("drg", year)), ci, "DRG", "_drg_sk"
    )
    dx = diagnosis_arrays(diagnosis_structs(diagnosis, dim, ci, year, runs), runs, runs)
    px = procedure_arrays(procedure, dim, ci, year, runs, runs)
    if runs:
        from indicata.sources.sinks import materialize

        dx, px = (bounded_broadcast(materialize(a, f"hot-arrays-{n}")) for a, n in ((dx, "diagnosis"), (px, "procedure")))
    counts = [T.StructField(RUN, T.LongType())] if runs else []
    empty_dx = F.array().cast(
        T.ArrayType(
            T.StructType(
                [
                    T.StructField("code_sk", T.StringType()),
                    T.StructField("code", T.StringType()),
                    T.StructField("identifiers", T.ArrayType(T.StringType())),
                    T.StructField("is_present_on_admission", T.LongType()),
                    *counts,
                ]
            )
        )
    )
    empty_px = F.array().cast(
        T.ArrayType(
            T.StructType(
                [
                    T.StructField("code_sk", T.StringType()),
                    T.StructField("code", T.StringType()),
                    T.StructField("identifiers", T.ArrayType(T.StringType())),
                    *counts,
                ]
            )
        )
    )
    return (
        drg.join(dx, "patient_id", "left")
        .join(px, "patient_id", "left")
        .select(
            "patient_id",
            "birth_date",
            "birth_date_sk",
            "age_at_admission",
            "is_adult",
            "admission_date",
            "admission_date_sk",
            "admission_type",
            "is_elective",
            "discharge_date",
            "discharge_date_sk",
            "drg",
            F.coalesce(F.col("_drg_sk"), F.lit(DRG_TEXT_FALLBACK)).alias("drg_code_sk"),
            F.col("identifiers").alias("drg_identifiers"),
            "principal_diagnosis",
            F.coalesce(F.col("secondary_diagnoses"), empty_dx).alias("secondary_diagnoses"),
            F.coalesce(F.col("procedures"), empty_px).alias("procedures"),
        )
    )


def _in_runs(summary: DataFrame, array_col: str) -> bool:
    return RUN in summary.schema[array_col].dataType.elementType.names


def expanded(summary: DataFrame) -> DataFrame:
    """A summary in runs with every element repeated as often as it occurs."""
    out = summary
    for name in ("secondary_diagnoses", "procedures"):
        if _in_runs(summary, name):
            fields = [f for f in summary.schema[name].dataType.elementType.names if f != RUN]
            repeat = lambda s: F.array_repeat(F.struct(*[s[f].alias(f) for f in fields]), s[RUN].cast("int"))  # noqa: E731,B023
            out = out.withColumn(name, F.flatten(F.transform(name, repeat)))
    return out


def _codes(summary: DataFrame, array_col: str) -> Column:
    """The codes of an array as text, without nulls."""
    if not _in_runs(summary, array_col):
        return text_list(F.transform(array_col, lambda s: s["code"]))
    # A separator before every code; the first one goes.
    texts = F.transform(array_col, lambda s: F.repeat(F.concat(F.lit(","), s["code"]), s[RUN].cast("int")))
    return F.substr(F.array_join(texts, ""), F.lit(2))


def _length(summary: DataFrame, array_col: str) -> Column:
    if not _in_runs(summary, array_col):
        return F.size(array_col).cast("bigint")
    return F.aggregate(array_col, F.lit(0).cast("bigint"), lambda a, s: a + s[RUN])


def flatten_summary(summary: DataFrame) -> DataFrame:
    """Flat text rendering of the nested columns (for checks and exports). Of a
    summary in runs the texts are repeated, no array is; a text's limit is 2 GB."""
    return summary.select(
        *[c for c in summary.columns if c not in ("drg_identifiers", "principal_diagnosis", "secondary_diagnoses", "procedures")],
        text_list(F.col("drg_identifiers")).alias("drg_identifiers"),
        F.col("principal_diagnosis.code").alias("principal_code"),
        F.col("principal_diagnosis.code_sk").alias("principal_code_sk"),
        text_list(F.col("principal_diagnosis.identifiers")).alias("principal_identifiers"),
        F.col("principal_diagnosis.is_present_on_admission").alias("principal_poa"),
        _codes(summary, "secondary_diagnoses").alias("secondary_codes"),
        _length(summary, "secondary_diagnoses").alias("n_secondary"),
        _codes(summary, "procedures").alias("procedure_codes"),
        _length(summary, "procedures").alias("n_procedures"),
    )


def explode_positions(df: DataFrame, array_col: str, fields: list[str]) -> DataFrame:
    """One row per array element with its 1-based position."""
    return df.select("patient_id", F.posexplode(array_col).alias("_pos", "_e")).select(
        "patient_id",
        (F.col("_pos") + 1).cast("bigint").alias("position"),
        *[F.col(f"_e.{f}").alias(f) for f in fields],
    )
