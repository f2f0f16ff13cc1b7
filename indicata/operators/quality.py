"""Data-quality checks. Each returns ``(check, subject, violations, passed)``
rows as a DataFrame; nothing is collected to the driver.

Counts use aggregations with partial (map-side) combine; lookups against
dimensions are broadcast after a size check; child-to-parent resolution is
a shuffled anti-join on the encounter key.
"""

from __future__ import annotations

import datetime as _dt
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.functions import safe_date
from indicata.operators.joins import bounded_broadcast, lacking, narrowed, union_all


def _result(df: DataFrame, check: str, subject: str | Column, violations: Column, passed: Column | None = None) -> DataFrame:
    v = F.coalesce(violations, F.lit(0)).cast("bigint")
    return df.select(
        F.lit(check).alias("check"),
        (F.lit(subject) if isinstance(subject, str) else subject).alias("subject"),
        v.alias("violations"),
        (passed if passed is not None else v == 0).alias("passed"),
    )


def _one(df: DataFrame, check: str, subject: str, violations: Column, passed: Column | None = None) -> DataFrame:
    """Single-row result from a global aggregate over ``df``."""
    agg = df.agg(violations.alias("_v"))
    return _result(agg, check, subject, F.col("_v"), None if passed is None else passed)


def _many(df: DataFrame, check: str, violations: Mapping[str, Column], passed: Mapping[str, Column] | None = None) -> DataFrame:
    """Several results from ONE global aggregate over ``df``: its one row is
    unpivoted (explode of structs), so the table is scanned once."""
    agg = df.agg(*[F.coalesce(v, F.lit(0)).cast("bigint").alias(f"_{i}") for i, v in enumerate(violations.values())], F.count(F.lit(1)).alias("_n"))
    rows = [
        F.struct(F.lit(subject).alias("subject"), F.col(f"_{i}").alias("violations"), (passed[subject] if passed else F.col(f"_{i}") == 0).alias("passed"))
        for i, subject in enumerate(violations)
    ]
    return agg.select(F.explode(F.array(*rows)).alias("r")).select(F.lit(check).alias("check"), "r.subject", "r.violations", "r.passed")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every table must have at least one row; a table is read up to its first row."""
    parts = [
        _one(df.select(F.lit(1).alias("_r")).limit(1), "row_count_nonzero", name, F.when(F.count(F.lit(1)) == 0, 1).otherwise(0))
        for name, df in tables.items()
    ]
    return union_all(*parts)


def pk_unique(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Surplus rows per declared primary key (rows beyond the first per key)."""
    parts = []
    for name, (df, keys) in tables.items():
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(_one(counts, "pk_unique", f"{name}({','.join(keys)})", F.sum(F.col("_n") - 1)))
    return union_all(*parts)


def fk_orphans(checks: Mapping[str, tuple[DataFrame, str, DataFrame, str, bool]]) -> DataFrame:
    """Child rows whose key has no parent row.

    ``checks[name] = (child, child_key, parent, parent_key, parent_is_small)``;
    small parents (dimensions) are broadcast after a size check.

    Every child table is scanned once: each of its keys is looked up by a left
    join to the parent's distinct keys (broadcast, or co-located where both
    are bucketed by the key), and one aggregate counts the misses of all keys.
    """
    tables: dict[int, tuple[DataFrame, list[tuple[str, str, DataFrame, str, bool]]]] = {}
    for name, (child, ckey, parent, pkey, small) in checks.items():
        tables.setdefault(id(child), (child, []))[1].append((name, ckey, parent, pkey, small))
    parts = []
    for child, keys in tables.values():
        rows = child.select(*dict.fromkeys(ckey for _, ckey, *_ in keys))
        misses = {}
        for i, (name, ckey, parent, pkey, small) in enumerate(keys):
            # One row per key, so that no child row is repeated.
            known = parent.groupBy(F.col(pkey).alias(f"_k{i}")).agg(F.lit(1).alias(f"_p{i}"))
            known = bounded_broadcast(narrowed(parent, known)) if small else known
            rows = rows.join(known, F.col(ckey) == F.col(f"_k{i}"), "left")
            misses[name] = F.count_if(F.col(f"_p{i}").isNull())
        parts.append(_many(rows, "fk_resolves", misses))
    return union_all(*parts)


def unknown_share(checks: Mapping[str, tuple[DataFrame, Column]], max_share: float = 0.05) -> DataFrame:
    """Rows resolving to an UNKNOWN member; passes while the share is at most ``max_share``."""
    tables: dict[int, tuple[DataFrame, dict[str, Column]]] = {}
    for name, (df, is_unknown) in checks.items():
        tables.setdefault(id(df), (df, {}))[1][name] = F.count_if(is_unknown)
    parts = []
    for df, counts in tables.values():  # one pass per table
        within = {name: F.col(f"_{i}") <= F.col("_n") * max_share for i, name in enumerate(counts)}
        parts.append(_many(df, "unknown_share", counts, within))
    return union_all(*parts)


def principal_rule(discharge: DataFrame, diagnosis: DataFrame) -> DataFrame:
    """Exactly one principal diagnosis per encounter with diagnoses; encounters
    without any diagnosis are reported separately."""
    per_enc = diagnosis.groupBy("patient_id").agg(F.sum("is_principal_diag").alias("_p"))
    not_one = _one(per_enc, "principal_diagnosis", "principal_count_not_one", F.sum(F.when(F.col("_p") != 1, 1).otherwise(0)))
    none = lacking(discharge.select("patient_id"), diagnosis.select("patient_id"), "patient_id")
    missing = _one(none, "principal_diagnosis", "encounters_without_diagnoses", F.count(F.lit(1)))
    return not_one.unionByName(missing)


def date_order(patient: DataFrame) -> DataFrame:
    """birth <= admission <= discharge where both dates are known."""
    b, a, d = F.col("birth_date"), F.col("admission_date"), F.col("discharge_date")
    return _many(patient, "date_order", {"birth_date<=admission_date": F.count_if(b > a), "admission_date<=discharge_date": F.count_if(a > d)})


def not_null(checks: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """NULL count per critical column (one pass per table)."""
    return union_all(*[_many(df, "not_null", {f"{name}.{c}": F.count_if(F.col(c).isNull()) for c in cols}) for name, (df, cols) in checks.items()])


def parses(checks: Mapping[str, tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Raw text values that are present but that the loader makes null or
    refuses (one pass per table): dates by the loader's own strict pattern."""
    parse = lambda c, kind: safe_date(F.col(c)) if kind == "date" else F.col(c).try_cast(kind)
    return union_all(
        *[
            _many(df, "parses", {f"{name}.{c}": F.count_if(F.col(c).isNotNull() & parse(c, kind).isNull()) for c, kind in cols.items()})
            for name, (df, cols) in checks.items()
        ]
    )


def metric_bounds(metrics: DataFrame, expected_months: int = 12, month_col: str = "month") -> DataFrame:
    """numerator <= denominator in every month, and the expected month count."""
    return _many(
        metrics,
        "metric_bounds",
        {
            "numerator<=denominator": F.count_if(F.col("numerator") > F.col("denominator")),
            f"months={expected_months}": F.abs(F.count(F.lit(1)) - expected_months),
        },
    )


def mom_change(metrics: DataFrame, max_abs_change: float = 0.1, month_col: str = "month") -> DataFrame:
    """Months whose rate moved by more than ``max_abs_change`` from the
    previous calendar month (self-join on the next month; no global window)."""
    cur = metrics.select(F.col(month_col).alias("_m"), F.col("rate").alias("_r"))
    prev = metrics.select(
        F.date_format(F.add_months(F.to_date(F.concat(F.col(month_col), F.lit("-01"))), 1), "yyyy-MM").alias("_m"),
        F.col("rate").alias("_pr"),
    )
    j = cur.join(prev, "_m")
    return _one(
        j, "mom_change", f"abs(rate change)<={max_abs_change}",
        F.sum(F.when(F.abs(F.col("_r") - F.col("_pr")) > max_abs_change, 1).otherwise(0)),
    )


#: Checks that are reported but do not fail a run.
NON_FATAL = ("reference_freshness",)


def freshness(versions: DataFrame, run_date: _dt.date) -> DataFrame:
    """Reference data is stale when the active version started in an earlier
    calendar year than the run date. Non-fatal: reported, never raised."""
    active = versions.filter(F.col("is_active"))
    agg = active.agg(F.max("effective_start_date").alias("_s"))
    stale = F.when(F.col("_s").isNull() | (F.year("_s") < run_date.year), 1).otherwise(0)
    return _result(agg, "reference_freshness", f"active_version_year>={run_date.year}", stale)


def reconcile(summary: DataFrame, discharge: DataFrame, diagnosis: DataFrame, procedure: DataFrame) -> DataFrame:
    """Summary rows and array sizes agree with the facts they came from."""
    dx = diagnosis.groupBy("patient_id").agg(
        F.sum(F.when(F.col("is_principal_diag") == 0, 1).otherwise(0)).alias("_nsec")
    )
    px = procedure.groupBy("patient_id").agg(F.count(F.lit(1)).alias("_nproc"))
    j = (
        summary.select("patient_id", F.size("secondary_diagnoses").alias("_s"), F.size("procedures").alias("_p"))
        .join(dx, "patient_id", "left")
        .join(px, "patient_id", "left")
    )
    sizes = _many(
        j,
        "reconcile",
        {
            "secondary_diagnoses_size": F.count_if(F.col("_s") != F.coalesce(F.col("_nsec"), F.lit(0))),
            "procedures_size": F.count_if(F.col("_p") != F.coalesce(F.col("_nproc"), F.lit(0))),
        },
    )
    counts = summary.select(F.lit(1).alias("_s"), F.lit(0).alias("_d")).unionByName(
        discharge.select(F.lit(0).alias("_s"), F.lit(1).alias("_d"))
    )
    rows = _one(counts, "reconcile", "summary_rows=discharge_rows", F.abs(F.sum("_s") - F.sum("_d")))
    return union_all(rows, sizes)
