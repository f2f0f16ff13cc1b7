"""Nightly-run operators: lookback extract, keyed upserts, rolling windows,
month spine, metric upserts, numerator audit diff, run log and the
effective-dated reference lookup.

Latest-row-per-key is an aggregation (``max`` of a struct led by the
ordering column), not a window: partial aggregation collapses a hot key
map-side, so no task ever holds a whole group.
"""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.functions import month_label
from indicata.operators.indicator import Period
from indicata.operators.intervals import RangeTable
from indicata.operators.joins import bounded_broadcast, having, lacking, narrowed
from indicata.operators.quality import NON_FATAL


def lookback_extract(staged: DataFrame, watermark: _dt.date | _dt.datetime, lookback_days: int = 7, ts_col: str = "updated_at") -> DataFrame:
    """Rows changed since ``watermark`` minus a lookback buffer for late corrections."""
    if isinstance(watermark, _dt.datetime):
        since = watermark - _dt.timedelta(days=lookback_days)
    else:
        since = _dt.datetime.combine(watermark, _dt.time()) - _dt.timedelta(days=lookback_days)
    return staged.filter(F.col(ts_col) >= F.lit(since).cast(staged.schema[ts_col].dataType))


def latest_by_key(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Newest row per key by ``order_col``; ties broken by the remaining
    columns (deterministic). Skew-safe: a partial aggregate per task (a sort
    aggregate, as the row travels in the aggregate as a struct of strings)."""
    rest = [c for c in df.columns if c not in keys and c != order_col]
    packed = F.struct(F.col(order_col).alias(order_col), *[F.col(c).alias(c) for c in rest])
    agg = df.groupBy(*keys).agg(F.max(packed).alias("_row"))
    return agg.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in [order_col, *rest]]).select(*df.columns)


def upsert_latest(target: DataFrame, changes: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Keyed upsert (MERGE semantics on an immutable table format): the newest
    version of every key across the current table and the staged changes.
    Idempotent: applying the same changes twice gives the same rows.

    Rows of the table whose key did not change pass through; only changed keys
    are aggregated. Keys must not be null, and the table holds one row per key
    (as every earlier upsert leaves it).
    """
    changes = changes.select(target.columns)
    changed = changes.select(*keys).distinct()
    touched = latest_by_key(having(target, changed, list(keys)).unionByName(changes), keys, order_col)
    return lacking(target, changed, list(keys)).unionByName(touched)


def replace_children(target: DataFrame, staged: DataFrame, corrected: DataFrame, key: str = "patient_id") -> DataFrame:
    """Child lines (diagnoses, procedures) after a correction: the lines of each
    corrected encounter become its staged lines, so lines that the correction
    removed go, and an encounter without staged lines keeps none. Lines of
    other encounters, and of null keys, pass through; staged lines of encounters
    that were not corrected are ignored. Repeated lines stay. Idempotent."""
    ids = corrected.select(key).distinct()
    return lacking(target, ids, key).unionByName(having(staged.select(target.columns), ids, key))


def month_spine(spark: SparkSession, period: Period, month_col: str = "year_month") -> DataFrame:
    """One row per calendar month of ``period``."""
    n = (period.end.year - period.start.year) * 12 + period.end.month - period.start.month + 1
    return spark.range(n).select(
        month_label(F.add_months(F.lit(period.start), F.col("id").cast("int"))).alias(month_col)
    )


def with_month_spine(metrics: DataFrame, period: Period, month_col: str = "month") -> DataFrame:
    """Every month of the window appears; missing months get 0 / 0 / NULL rate."""
    spine = month_spine(metrics.sparkSession, period, month_col)
    return (
        spine.join(metrics, month_col, "left")
        .select(
            month_col,
            F.coalesce(F.col("numerator"), F.lit(0).cast("bigint")).alias("numerator"),
            F.coalesce(F.col("denominator"), F.lit(0).cast("bigint")).alias("denominator"),
            F.col("rate"),
        )
        .orderBy(month_col)
    )


def metrics_upsert(current: DataFrame, new: DataFrame, period: Period, month_col: str = "year_month", order_col: str = "computed_at") -> DataFrame:
    """Upsert monthly metrics keyed by month, then keep only the window's months.

    The current table never holds more months than the window; history
    lives in the numerator audit rows and the run log.
    """
    merged = latest_by_key(current.unionByName(new.select(current.columns)), [month_col], order_col)
    lo, hi = month_label(F.lit(period.start)), month_label(F.lit(period.end))
    return merged.filter(F.col(month_col).between(lo, hi))


def numerator_diff(run_a: DataFrame, run_b: DataFrame, keys: Sequence[str] = ("patient_id", "year_month")) -> DataFrame:
    """Membership change between two runs: added / removed / kept per key."""
    a = run_a.select(*keys).distinct().withColumn("_a", F.lit(1))
    b = run_b.select(*keys).distinct().withColumn("_b", F.lit(1))
    j = a.join(b, list(keys), "full_outer")
    change = (
        F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").otherwise("kept")
    )
    return j.select(*keys, change.alias("change"))


def metric_totals() -> dict[str, Column]:
    """Aggregates of published metric rows that a run log row holds."""
    return {
        "numerator": F.coalesce(F.sum("numerator"), F.lit(0)).cast("bigint"),
        "denominator": F.coalesce(F.sum("denominator"), F.lit(0)).cast("bigint"),
        "months": F.count_if(F.col("denominator") > 0),
    }


def failed_checks() -> dict[str, Column]:
    """The aggregate of check rows that a run log row holds."""
    return {"dq_failed": F.count_if(~F.col("passed") & ~F.col("check").isin(*NON_FATAL))}


def run_log_row(
    totals: DataFrame, *, run_id: str, execution_date: _dt.date, period: Period, ref_version: str | None, pipeline_status: str = "SUCCEEDED"
) -> DataFrame:
    """The run log row of one row of totals (numerator, denominator, months, dq_failed)."""
    return totals.select(
        F.lit(run_id).alias("run_id"),
        F.lit(execution_date).alias("execution_date"),
        F.lit(period.start).alias("window_start"),
        F.lit(period.end).alias("window_end"),
        F.lit(ref_version).cast("string").alias("ref_version"),
        "numerator",
        "denominator",
        "months",
        F.when(F.col("dq_failed") == 0, "PASSED").otherwise("FAILED").alias("dq_status"),
        F.lit(pipeline_status).alias("pipeline_status"),
    )


def run_log(
    metrics: DataFrame,
    *,
    run_id: str,
    execution_date: _dt.date,
    period: Period,
    ref_version: str | None,
    dq: DataFrame | None = None,
    pipeline_status: str = "SUCCEEDED",
) -> DataFrame:
    """One run-log row from published tables: window, version, totals, month
    count and DQ status. (A run that is being written takes them from its
    writes.)"""
    totals = metrics.agg(*[c.alias(n) for n, c in metric_totals().items()])
    if dq is None:
        totals = totals.withColumn("dq_failed", F.lit(0).cast("bigint"))
    else:
        failed = dq.agg(*[c.alias(n) for n, c in failed_checks().items()])
        totals = totals.withColumn("_one", F.lit(1)).join(failed.withColumn("_one", F.lit(1)), "_one")
    return run_log_row(totals, run_id=run_id, execution_date=execution_date, period=period, ref_version=ref_version, pipeline_status=pipeline_status)


def versioned_code_flags(versioned_map: DataFrame, code_type: str, identifiers: Sequence[str]) -> DataFrame:
    """Per (code, ref_version): 1 when the code carries any of ``identifiers``
    in that version, with the version's effective range."""
    return (
        versioned_map.filter(F.col("code_type") == code_type)
        .groupBy("code", "ref_version", "effective_start_date", "effective_end_date")
        .agg(F.max(F.when(F.col("identifier").isin(list(identifiers)), 1).otherwise(0)).cast("bigint").alias("in_set"))
    )


def effective_versions(versioned_map: DataFrame) -> DataFrame:
    """Distinct versions with their effective range."""
    return versioned_map.select("ref_version", "effective_start_date", "effective_end_date").distinct()


def with_version(rows: DataFrame, date_col: str, versions: RangeTable) -> DataFrame:
    """``rows`` with the reference version effective on ``date_col`` (null: none):
    a binary search in the resolved ranges, no join."""
    return rows.withColumn("ref_version", versions.at(F.col(date_col)))


def effective_dated_lookup(
    rows: DataFrame,
    date_col: str,
    code_col: str,
    versioned_flags: DataFrame,
    versions: RangeTable,
) -> DataFrame:
    """Attach the reference version effective on ``date_col`` and the code's
    membership flag in that version (an equi-join on code and version).
    """
    dated = with_version(rows, date_col, versions)
    flags = bounded_broadcast(
        narrowed(versioned_flags, versioned_flags.select(F.col("code").alias(code_col), "ref_version", "in_set"))
    )
    out = dated.join(flags, [code_col, "ref_version"], "left")
    return out.select(*rows.columns, "ref_version", F.coalesce(F.col("in_set"), F.lit(0)).cast("bigint").alias("in_set"))


def run_timestamp(run_date: _dt.date) -> Column:
    """Deterministic ``computed_at`` for reproducible reruns of a given date."""
    return F.lit(_dt.datetime.combine(run_date, _dt.time())).cast("timestamp_ntz")
