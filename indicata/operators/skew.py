"""Heavy hitters: keys with so many rows that they would fill a task, and
grouping them without one.

Finding them takes one sketch aggregate: rows are counted by a hash cell of
their key, which partial aggregation collapses map-side, whatever the keys. A
cell holds at least the rows of each of its keys, so a key beyond the
threshold is in a cell beyond it; only the rows of such cells (usually none)
are counted by key. The result is exact, and has at most
``rows / threshold`` keys for each table.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.operators.joins import union_all

#: Cells of the sketch for each share of the rows that makes a key hot, and the fewest cells.
CELLS_PER_SHARE = 16
LEAST_CELLS = 1 << 16
#: Tasks that a hot key's rows are spread over before they are brought together.
SALTS = 64


def _cell(key: str, cells: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(cells)).alias("cell")


def hot_keys(tables: Mapping[str, DataFrame], key: str, shares: int, least_rows: int) -> DataFrame | None:
    """Keys (null included) with more than ``1 / shares`` of a table's rows, and
    more than ``least_rows``, in any of ``tables``; None if there are none.

    ``shares`` counts; the sketch is written, three numbers reach the driver.
    """
    from indicata.sources.sinks import materialize

    cells = max(LEAST_CELLS, shares * CELLS_PER_SHARE)
    counts = [df.groupBy(_cell(key, cells)).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "cell", "n") for name, df in tables.items()]
    sketch = materialize(union_all(*counts), "skew-sketch")
    limits = {r["name"]: max(least_rows, r["total"] // shares) for r in sketch.groupBy("name").agg(F.sum("n").alias("total")).collect()}
    parts = []
    for name, df in tables.items():
        heavy = sketch.filter((F.col("name") == name) & (F.col("n") > limits.get(name, 0))).select("cell")
        if heavy.isEmpty():
            continue
        suspects = df.select(key, _cell(key, cells)).join(heavy, "cell", "left_semi")
        parts.append(suspects.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limits[name]).select(key))
    if not parts:
        return None
    found = materialize(union_all(*parts).distinct(), "hot-keys")
    return None if found.isEmpty() else found


def split(df: DataFrame, hot: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` with a key outside and inside ``hot`` (null equals null).

    ``hot`` is bounded by ``hot_keys`` and is broadcast; no row of ``df`` moves.
    """
    keys = F.broadcast(hot.select(F.col(key).alias("_hot")))
    same = F.col(key).eqNullSafe(F.col("_hot"))
    return df.join(keys, same, "left_anti"), df.join(keys, same, "left_semi")


def salt(*columns: str, salts: int = SALTS) -> Column:
    """A bucket that spreads rows of one key, also equal ones, over ``salts`` tasks."""
    return F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in columns]), F.lit(salts)).alias("_salt")


def salted_arrays(rows: DataFrame, key: str, arrays: Mapping[str, Column], least: Mapping[str, Column], salted_by: Column) -> DataFrame:
    """Per key the sorted array of each of ``arrays`` (nulls left out) and the minimum of each of ``least``.

    Two stages: sorted parts by key and salt, then parts by key. A hot key's
    rows are collected and sorted by many tasks; the last one merges parts.
    """
    parts = rows.withColumn("_salt", salted_by).groupBy(key, "_salt").agg(
        *[F.sort_array(F.collect_list(v)).alias(n) for n, v in arrays.items()], *[F.min(v).alias(n) for n, v in least.items()]
    )
    return parts.groupBy(key).agg(*[F.sort_array(F.flatten(F.collect_list(n))).alias(n) for n in arrays], *[F.min(n).alias(n) for n in least])


def counted(rows: DataFrame, *columns: str) -> DataFrame:
    """Distinct values of ``columns`` with the number ``n`` of their rows. Partial
    aggregation leaves at most a task's distinct values, whatever the keys."""
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def collapse_diagnoses(diagnosis: DataFrame) -> DataFrame:
    """Diagnosis lines of hot encounters, one for each encounter, code and flags,
    with the lowest rank: all that cohorts and audit rows ask of them. Partial
    aggregation leaves at most the code list's rows per encounter and task."""
    rest = [c for c in diagnosis.columns if c != "diag_rank_num"]
    # In a struct, so that a missing rank stays the lowest.
    least = diagnosis.groupBy(*rest).agg(F.min(F.struct("diag_rank_num")).alias("_r"))
    return least.withColumn("diag_rank_num", F.col("_r.diag_rank_num")).select(*diagnosis.columns)
