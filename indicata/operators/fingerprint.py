"""Order-free fingerprints: two tables, or the arrays of a row and the rows they
came from, compared as multisets without sorting or ``exceptAll``.

A row's hash is one number, and a multiset's fingerprint is the sum of its rows'
hashes beside their count. Sums do not depend on order or partitioning and
combine map-side, so comparing two tables moves a few numbers, whatever their
size. Unlike an exclusive or, a sum keeps repeated rows apart.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.operators.joins import union_all

#: A 64-bit hash in so many digits that 10^18 of them can be summed.
NUMBER = T.DecimalType(20, 0)


def row_hash(*columns: Column) -> Column:
    """Hash of a row's values in their places. Nulls are marked, as the hash
    function itself passes over them; nested values are hashed as JSON text,
    which keeps nulls and places inside them."""
    parts = []
    for c in columns:
        parts += [c.isNull(), c]
    return F.xxhash64(*parts).cast(NUMBER)


def _plain(df: DataFrame, name: str) -> Column:
    nested = isinstance(df.schema[name].dataType, (T.ArrayType, T.StructType, T.MapType))
    c = F.col(f"`{name}`")
    return F.to_json(F.struct(c), {"ignoreNullFields": "false"}) if nested else c


def total(values: Column) -> Column:
    """Sum of hashes, 0 for none; wide enough for any table."""
    return F.coalesce(F.sum(values.cast("decimal(28, 0)")), F.lit(0)).cast("decimal(38, 0)")


def table_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row (rows, fingerprint) of a table's rows, in any order, with their repeats."""
    names = sorted(columns or df.columns)
    return df.agg(F.count(F.lit(1)).alias("rows"), total(row_hash(*[_plain(df, n) for n in names])).alias("fingerprint"))


def same_tables(check: str, pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Check rows: a table pair violates by one if their multisets of rows differ."""
    out = []
    for subject, (a, b) in pairs.items():
        names = sorted(a.columns)
        if names != sorted(b.columns):
            raise ValueError(f"{subject}: {names} and {sorted(b.columns)}")
        both = table_fingerprint(a, names).unionByName(table_fingerprint(b, names))
        differ = (F.min("rows") != F.max("rows")) | (F.min("fingerprint") != F.max("fingerprint"))
        out.append(
            both.agg(differ.cast("bigint").alias("violations")).select(
                F.lit(check).alias("check"), F.lit(subject).alias("subject"), "violations", (F.col("violations") == 0).alias("passed")
            )
        )
    return union_all(*out)


def array_fingerprint(array: str, element: Sequence[str]) -> Column:
    """Sum of the hashes of an array's elements, by the named fields."""
    hashes = F.transform(array, lambda e: row_hash(*[e[n] for n in element]).cast("decimal(38, 0)"))
    return F.aggregate(hashes, F.lit(0).cast("decimal(38, 0)"), lambda a, x: (a + x).cast("decimal(38, 0)"))


def reconcile_contents(summary: DataFrame, diagnosis: DataFrame, procedure: DataFrame) -> DataFrame:
    """Check rows: discharges whose arrays do not hold exactly their facts' lines.

    Secondary diagnoses are compared by code and present flag, procedures by
    code, the principal diagnosis with the first line by rank, code and flag.
    The facts are reduced to one row per encounter each (co-located where they
    are bucketed); no array is exploded and no line is joined to another.
    """
    flag, code = "is_present_on_admission", F.col("diag_code")
    principal = F.col("is_principal_diag") == 1
    first = F.min(F.when(principal, F.struct("diag_rank_num", "diag_code", flag)))
    dx = diagnosis.groupBy("patient_id").agg(
        total(F.when(~principal, row_hash(code, F.col(flag)))).alias("_secondary"), first.alias("_first")
    )
    px = procedure.groupBy("patient_id").agg(total(row_hash(F.col("procedure_code"))).alias("_procedures"))
    found = summary.select(
        "patient_id",
        array_fingerprint("secondary_diagnoses", ["code", flag]).alias("secondary"),
        array_fingerprint("procedures", ["code"]).alias("procedures"),
        F.col("principal_diagnosis.code").alias("code"),
        F.col(f"principal_diagnosis.{flag}").alias("flag"),
    )
    joined = found.join(dx, "patient_id", "left").join(px, "patient_id", "left")
    zero = F.lit(0).cast("decimal(38, 0)")
    wrong = {
        "principal_diagnosis": ~(F.col("code").eqNullSafe(F.col("_first.diag_code")) & F.col("flag").eqNullSafe(F.col(f"_first.{flag}"))),
        "procedures": F.col("procedures") != F.coalesce("_procedures", zero),
        "secondary_diagnoses": F.col("secondary") != F.coalesce("_secondary", zero),
    }
    counts = joined.agg(*[F.count_if(c).alias(n) for n, c in wrong.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("subject"), F.col(n).alias("violations")) for n in wrong])
    return counts.select(F.explode(rows).alias("r")).select(
        F.lit("reconcile_contents").alias("check"), "r.subject", "r.violations", (F.col("r.violations") == 0).alias("passed")
    )
