"""Deterministic projection of the driver tables onto the encounter contract.

The driver ships TPC-H-like tables (``orders``, ``lineitem``, ``part``); the
projection maps them onto the raw encounter and code-list shapes so every
operator reads data whose volume grows with the scale factor. The same
projection exists as a DuckDB CTE prefix in ``indicata.plans.oracle``.

Every function here is a narrow projection (no shuffle) except the
procedure list, which is DISTINCT by contract, and the versioned code lists,
whose parts are dealt out.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the projection (documented in FIXTURES.md).
FIXTURE_YEAR = 1997
FIXTURE_RUN_DATE = _dt.date(1997, 12, 15)
FIXTURE_ROLLING_RUN_DATE = _dt.date(1997, 6, 30)
PRIORITY_TO_ADMISSION_TYPE = {
    "1-URGENT": "Emergency",
    "2-HIGH": "Urgent",
    "3-MEDIUM": "Elective",
    "5-LOW": "ELECTIVE",
}
RETURNFLAG_TO_POA = {"A": "Y", "N": "N"}


_TABLES: dict[tuple[int, str], tuple[SparkSession, DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver table ``name`` (read once per session; schema from the footer)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    hit = _TABLES.get((id(spark), path))
    if hit is None or hit[0] is not spark:
        hit = (spark, spark.read.parquet(path))
        _TABLES[(id(spark), path)] = hit
    return hit[1]


def _pad3(c: Column) -> Column:
    return F.lpad(c.cast("string"), 3, "0")


def _case(c: Column, mapping: dict[str, str]) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(c == k, v) if out is None else out.when(c == k, v))
    return out


def _patient_columns() -> list[Column]:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    day = F.to_date("o_orderdate")
    drg = F.when(key % 20 == 0, F.lit(None).cast("string")).when(key % 20 == 1, "999").otherwise(_pad3(cust % 50))
    birth = F.when(key % 97 == 0, "1997-13-45").otherwise(
        F.date_format(F.date_sub(day, ((cust * 97) % 36500).cast("int")), "yyyy-MM-dd")
    )
    return [
        key.cast("string").alias("patient_id"),
        drg.alias("drg"),
        birth.alias("birth_date"),
        F.date_format(day, "yyyy-MM-dd").alias("admission_date"),
        F.date_format(F.date_add(day, (key % 15).cast("int")), "yyyy-MM-dd").alias("discharge_date"),
        _case(F.col("o_orderpriority"), PRIORITY_TO_ADMISSION_TYPE).alias("admission_type"),
    ]


def raw_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(_patient_columns())


def raw_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("patient_id"),
        F.concat(F.lit("D"), _pad3(F.col("l_partkey") % 100)).alias("diag_code"),
        F.col("l_linenumber").cast("bigint").alias("diag_rank_num"),
        _case(F.col("l_returnflag"), RETURNFLAG_TO_POA).alias("present_on_admission_ind"),
    )


def raw_procedure(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (
        li.filter(F.col("l_linestatus") == "F")
        .select(
            F.col("l_orderkey").cast("string").alias("patient_id"),
            F.concat(F.lit("P"), _pad3(F.col("l_suppkey") % 10)).alias("procedure_code"),
        )
        .distinct()
    )


def _code_list_rows(part: DataFrame, sepsis_hi: Column, extra: list[Column] | None = None) -> DataFrame:
    """All five code lists from ONE scan of ``part``: each part row yields
    the list entries whose condition it meets (explode of conditional
    structs), instead of a five-way UNION ALL of separate scans. Entries
    are in the struct column ``_r``."""
    k = F.col("p_partkey")
    proc = F.concat(F.lit("P"), _pad3(k % 10))
    drg = _pad3(k % 50)
    diag = F.concat(F.lit("D"), _pad3(k % 100))
    # Which list carries which identifier (see FIXTURES.md).
    entries = [
        ("appendix_a", proc, "Procedure", "ORPROC", k % 10 < 4),
        ("appendix_e", drg, "DRG", "SURGI2R", k % 50 < 30),
        ("appendix_f", diag, "Diagnosis", "INFECID", k % 100 < 8),
        ("appendix_o", diag, "Diagnosis", "MDC14PRINDX", (k % 100).between(20, 29)),
        ("appendix_o", diag, "Diagnosis", "MDC15PRINDX", (k % 100).between(25, 34)),
        ("sepsis_codes", diag, "Diagnosis", "SEPTI2D", (k % 100 >= 5) & (k % 100 <= sepsis_hi)),
    ]
    rows = F.array(
        *[
            F.when(
                cond,
                F.struct(
                    F.lit(name).alias("list_name"),
                    code.alias("code"),
                    F.col("p_name").alias("code_description"),
                    F.lit(code_type).alias("code_type"),
                    F.lit(ident).alias("identifier"),
                ),
            )
            for name, code, code_type, ident, cond in entries
        ]
    )
    return part.select(*(extra or []), F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("_r"))


def code_list_rows(spark: SparkSession, sf_dir: str, sepsis_hi: int = 12) -> DataFrame:
    """The five code lists as one frame with a ``list_name`` column."""
    return _code_list_rows(table(spark, sf_dir, "part"), F.lit(sepsis_hi)).select("_r.*")


def code_lists(spark: SparkSession, sf_dir: str, sepsis_hi: int = 12) -> dict[str, DataFrame]:
    """The five code lists as separate frames (one file each in the contract);
    ``sepsis_hi`` moves the upper end of the sepsis range."""
    rows = code_list_rows(spark, sf_dir, sepsis_hi)
    names = ("appendix_a", "appendix_e", "appendix_f", "appendix_o", "sepsis_codes")
    return {
        n: rows.filter(F.col("list_name") == n).select("code", "code_description", "code_type", "identifier")
        for n in names
    }


def versioned_code_lists(spark: SparkSession, sf_dir: str, first_year: int = 1995, last_year: int = 2001) -> DataFrame:
    """One code-list version per year, effective Jan 1 .. Dec 31.

    The sepsis list widens by one code per year after the fixture year.
    Returns all versions with ``ref_version``, ``effective_start_date``,
    ``effective_end_date`` and ``reference_year``, from a single scan. The
    parts are dealt out first: their few file splits become some ten times the rows.
    """
    yr = F.col("_yr")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name").repartition("p_partkey").select(
        "p_partkey", "p_name", F.explode(F.sequence(F.lit(first_year), F.lit(last_year))).alias("_yr")
    )
    rows = _code_list_rows(part, F.lit(12) + yr - FIXTURE_YEAR, extra=[yr])
    return rows.select(
        "_r.code",
        "_r.code_description",
        "_r.code_type",
        "_r.identifier",
        F.concat(yr.cast("string"), F.lit("-01-01")).alias("ref_version"),
        F.make_date(yr, F.lit(1), F.lit(1)).alias("effective_start_date"),
        F.make_date(yr, F.lit(12), F.lit(31)).alias("effective_end_date"),
        yr.cast("bigint").alias("reference_year"),
    )


def code_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity ranges of diagnosis codes that occur in ``part``: six per code,
    of 60 to 660 days, that overlap and leave gaps; the last of every fourth code is open."""
    codes = table(spark, sf_dir, "part").select((F.col("p_partkey") % 100).alias("k")).distinct()
    rows = codes.select("k", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("j"))
    start = F.date_add(F.lit(_dt.date(1995, 1, 1)), (F.col("j") * 400 + (F.col("k") * 13 + F.col("j") * 97) % 300).cast("int"))
    length = (60 + (F.col("k") * 31 + F.col("j") * 211) % 600).cast("int")
    return rows.select(
        F.concat(F.lit("D"), _pad3(F.col("k"))).alias("diag_code"),
        start.alias("effective_start_date"),
        F.when((F.col("j") < 5) | (F.col("k") % 4 > 0), F.date_add(start, length)).alias("effective_end_date"),
        F.concat_ws("-", F.lit("r"), F.col("k"), F.col("j")).alias("range_name"),
    )


def staged_patient(spark: SparkSession, sf_dir: str, versions: tuple[int, ...] = (1, 2)) -> DataFrame:
    """Raw patient rows with ``updated_at`` extract metadata, two versions for some.

    Version 1 of every encounter is stamped ``o_orderdate + o_orderkey % 10``
    days; encounters with ``o_orderkey % 5 = 0`` get a version 2 twenty days
    later whose DRG is the ungroupable sentinel ``'999'``.
    """
    base = table(spark, sf_dir, "orders").select(*_patient_columns(), "o_orderkey", "o_orderdate")
    v1_ts = F.col("o_orderdate") + F.make_dt_interval(days=(F.col("o_orderkey") % 10).cast("int"))
    v1 = base.withColumn("updated_at", v1_ts)
    v2 = (
        base.filter(F.col("o_orderkey") % 5 == 0)
        .withColumn("drg", F.lit("999"))
        .withColumn("updated_at", v1_ts + F.make_dt_interval(days=F.lit(20)))
    )
    cols = ["patient_id", "drg", "birth_date", "admission_date", "discharge_date", "admission_type", "updated_at"]
    parts = [v.select(cols) for n, v in ((1, v1), (2, v2)) if n in versions]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def staged_lines(lines: DataFrame, name: str) -> DataFrame:
    """Raw child lines as a correction restates them: diagnoses up to rank 3,
    procedures without the last code."""
    return lines.filter("diag_rank_num <= 3" if name == "diagnosis" else "procedure_code <> 'P009'")


@dataclass(frozen=True)
class RawInputs:
    patient: DataFrame
    diagnosis: DataFrame
    procedure: DataFrame
    code_lists: DataFrame  # all lists, with ``list_name``


def raw_inputs(spark: SparkSession, sf_dir: str, sepsis_hi: int = 12) -> RawInputs:
    return RawInputs(
        patient=raw_patient(spark, sf_dir),
        diagnosis=raw_diagnosis(spark, sf_dir),
        procedure=raw_procedure(spark, sf_dir),
        code_lists=code_list_rows(spark, sf_dir, sepsis_hi=sepsis_hi),
    )


#: Fixed values of the projection: the encounters that take the diagnosis lines, procedures and discharges of the orders with their remainder by 3.
HOT_ENCOUNTERS = {"diagnosis": "3", "procedure": "4", "patient": "5"}


def hot_inputs(spark: SparkSession, sf_dir: str) -> RawInputs:
    """The inputs with a third of the rows of each table at one encounter
    (discharges with the ungroupable DRG stay where they are)."""
    raw = raw_inputs(spark, sf_dir)
    number = F.col("patient_id").cast("bigint")

    def moved(df: DataFrame, name: str, stays: Column = F.lit(False)) -> DataFrame:
        ids = F.when((number % 3 == int(HOT_ENCOUNTERS[name]) % 3) & ~stays, HOT_ENCOUNTERS[name]).otherwise(F.col("patient_id"))
        return df.withColumn("patient_id", ids)

    ungroupable = F.coalesce(F.col("drg") == "999", F.lit(False))
    return RawInputs(moved(raw.patient, "patient", ungroupable), moved(raw.diagnosis, "diagnosis"), moved(raw.procedure, "procedure"), raw.code_lists)
