"""The nightly run as one parameterised plan: apply the staged extract, recompute
the rolling window, upsert the published metrics, refresh the current table,
persist numerator audit rows, run the checks and append the run log.

Every output is written under ``out_dir`` keyed by ``run_id`` with dynamic
partition overwrite, so re-running a night replaces exactly that night's rows
(idempotent), earlier nights are kept for audit, and no plan reads and
overwrites the same files. Scheduling and alert delivery are outside the
library: the DQ rows and the run log are the alert inputs.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.operators import facts
from indicata.operators import incremental as inc
from indicata.operators import indicator as ind
from indicata.operators import quality as dq
from indicata.operators import versioned as ver
from indicata.operators.intervals import RangeTable
from indicata.operators.joins import having, union_all
from indicata.plans.warehouse import MONTH_COL, YEAR_COL, Facts, Warehouse, places
from indicata.sources.sinks import child_names, materialize, publish, read_published

#: Months that the current metrics table holds.
CURRENT_MONTHS = 12


@dataclass(frozen=True)
class VersionedReference:
    """Code-set flags per version (``versioned_flags``, a written table) and the
    versions' resolved effective ranges."""

    flags: DataFrame
    versions: RangeTable

    def version_on(self, day: _dt.date) -> str | None:
        return self.versions.on(day)


@dataclass(frozen=True)
class StagedExtract:
    """Raw rows that the source restated: encounters with ``updated_at``, and
    all lines of those encounters (lines of others are ignored)."""

    patient: DataFrame
    diagnosis: DataFrame
    procedure: DataFrame


@dataclass(frozen=True)
class RunOutputs:
    metrics: DataFrame
    current: DataFrame
    numerator_patients: DataFrame
    checks: DataFrame
    run_log: DataFrame


def _write_run(df: DataFrame, path: str, totals: dict[str, Column] | None = None) -> dict:
    """Write a run's rows, and return ``totals`` of them, collected by the write itself."""
    seen = Observation()
    if totals:
        df = df.observe(seen, *[c.alias(n) for n, c in totals.items()])
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )
    return seen.get if totals else {}


def _read_runs(df_schema: T.StructType, spark, path: str) -> DataFrame | None:
    """The published runs, or None if nothing was published yet; a published
    folder that cannot be read fails the run."""
    if not child_names(spark, path):
        return None
    fields = [f for f in df_schema.fields if f.name != "run_id"] + [T.StructField("run_id", T.StringType())]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def run_name(spec: ind.IndicatorSpec, run_date: _dt.date, period: ind.Period) -> str:
    """Run id of a night or backfill: indicator, run date and window, so that a
    backfill on a night's date never replaces the night's rows."""
    return f"{spec.name}-{run_date.isoformat()}-{period.start:%Y-%m}-{period.end:%Y-%m}"


def _corrections(w: Warehouse, staged: StagedExtract, built_on: _dt.date | None, lookback_days: int = 7) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The encounters changed since the facts were built (typed, newest version
    each) and their rows of the three facts. Only they are typed and keyed."""
    built_on = built_on or w.built_on
    if built_on is None:
        raise ValueError("built_on: the day whose extract the stored facts hold")
    changed = inc.lookback_extract(staged.patient, built_on, lookback_days)
    newest = inc.latest_by_key(changed, ["patient_id"], "updated_at").drop("updated_at")
    patient = materialize(facts.core_patient(newest), "nightly-extract")
    build = {"resolve_unknown": w.resolve_unknown}
    discharge = facts.fct_discharge(patient, w.dim_code, w.year, date_start=w.date_start, date_end=w.date_end, **build)
    lines = lambda df: having(df, patient, "patient_id")
    return patient, {
        "fct_discharge": discharge.withColumn(MONTH_COL, F.trunc("discharge_date", "MM")),
        "fct_diagnosis": facts.fct_diagnosis(lines(facts.core_diagnosis(staged.diagnosis)), w.dim_code, w.year, **build),
        "fct_procedure": facts.fct_procedure(lines(facts.core_procedure(staged.procedure)), w.dim_code, w.year, **build),
    }


def corrected_facts(w: Warehouse, staged: StagedExtract, built_on: _dt.date | None = None, lookback_days: int = 7) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three facts with the staged encounters in place of their older rows.

    The written facts are merged as they are read, so a run reads the years of
    its period and rewrites no table. All changes since ``built_on`` (default:
    the warehouse's; without either this raises) take part, so none is lost
    between nights; ``compact_corrections`` ends the merging. A changed
    encounter's rows have the year and month of its new discharge; its older rows
    are taken out wherever they lie. Of several staged versions the newest counts; an encounter
    without staged lines keeps none.
    """
    patient, fresh = _corrections(w, staged, built_on, lookback_days)
    old = (w.fct_discharge_by_month, w.fct_diagnosis_by_year, w.fct_procedure_by_year)
    dated = [n.join(places(patient), "patient_id", "left") if YEAR_COL in o.columns else n for o, n in zip(old, fresh.values())]
    return tuple(inc.replace_children(o, n, patient) for o, n in zip(old, dated))


def compact_corrections(w: Warehouse, staged: StagedExtract, through: _dt.date, built_on: _dt.date | None = None) -> list[int | None]:
    """Write the corrections since ``built_on`` into the stored facts, which then
    hold the extract of ``through``: the touched years are rewritten, the
    others keep their files, and later nights read bucketed facts again."""
    patient, fresh = _corrections(w, staged, built_on)
    return w.replace_encounters(places(patient), fresh, through)


def nightly_run(
    w: Warehouse,
    run_date: _dt.date,
    out_dir: str,
    *,
    spec: ind.IndicatorSpec | None = None,
    period: ind.Period | None = None,
    run_id: str | None = None,
    computed_at: Column | None = None,
    versions: DataFrame | None = None,
    reference: VersionedReference | None = None,
    staged: StagedExtract | None = None,
    built_on: _dt.date | None = None,
    max_mom_change: float = 0.1,
) -> RunOutputs:
    """Run one night (or a backfill, with ``period``) and return the published tables.

    With ``reference`` each discharge is judged by the code lists effective on
    its date, metrics carry the version effective at the month's end and audit
    rows their own; without it all months use the warehouse's reference year.
    With ``staged`` the changes since ``built_on`` (default: the warehouse's) are
    applied first, see ``corrected_facts``. Of two runs on one date the later
    one is the newer. The run log takes its totals from the writes themselves.

    The returned frames read ``out_dir`` as it is when the run ends; after a
    later run rewrites a night, read them again.
    """
    spark = w.spark
    spec = spec or ind.IndicatorSpec()
    period = period or ind.Period.rolling(run_date)
    run_id = run_id or run_name(spec, run_date, period)
    computed_at = computed_at if computed_at is not None else inc.run_timestamp(run_date)
    ref_version = reference.version_on(period.end) if reference else f"{w.year}-01-01"
    started = _dt.datetime.now(_dt.timezone.utc)
    parts = [Facts(*corrected_facts(w, staged, built_on))] if staged else w.parts
    prefilter = w.prefilter or staged is not None
    n_months = (period.end.year - period.start.year) * 12 + period.end.month - period.start.month + 1

    # 1. recompute the whole window (late data is picked up by recomputation)
    if reference:
        # Written once: the metrics and the audit rows read the same cohort.
        cohorts = [ver.eligible(p.discharge, p.diagnosis, p.procedure, reference.flags, reference.versions, spec, period) for p in parts]
        cohort = materialize(union_all(*cohorts), "nightly-cohort")
        months = inc.with_month_spine(ver.monthly(cohort, spec).drop("ref_version"), period)
        months = inc.with_version(months.withColumn("_end", F.last_day(F.to_date("month", "yyyy-MM"))), "_end", reference.versions)
    else:
        eligible = lambda p: ind.eligible(p.discharge, p.diagnosis, p.procedure, w.flags(spec), spec, period, prefilter)
        counted = ind.monthly_of(union_all(*map(eligible, parts)), spec) if staged else w.metrics_table(spec, period)
        months = inc.with_month_spine(counted, period).withColumn("ref_version", F.lit(ref_version))
    new = months.select(
        F.col("month").alias("year_month"),
        "numerator",
        "denominator",
        "rate",
        computed_at.alias("computed_at"),
        "ref_version",
        F.lit(run_id).alias("run_id"),
    )

    # 2. upsert the published metrics: newest row per month across earlier
    #    snapshots and this run, trimmed to the window. The merged rows are
    #    materialized first, then written as this run's snapshot, so the
    #    snapshot table is never read and overwritten in one plan.
    snap_path = f"{out_dir}/metrics_snapshots"
    values = [c for c in new.columns if c != "run_id"]
    snap_schema = T.StructType(
        [*[f for f in new.schema.fields if f.name != "run_id"], T.StructField("source_run_id", T.StringType()),
         T.StructField("run_seq", T.LongType()), T.StructField("run_id", T.StringType())]
    )
    # Runs are numbered in the order of their first publication.
    history = _read_runs(snap_schema, spark, snap_path)
    numbers = {} if history is None else {r["source_run_id"]: r["n"] for r in history.groupBy("source_run_id").agg(F.max("run_seq").alias("n")).collect()}
    run_seq = numbers.get(run_id, max(numbers.values(), default=0) + 1)
    order = F.struct("computed_at", "run_seq").alias("_order")
    numbered = new.withColumn("run_seq", F.lit(run_seq).cast("bigint"))
    if history is not None:
        # Only runs computed before this one: rerunning an older night never
        # publishes a newer night's rows.
        before = (F.col("computed_at") < computed_at) | ((F.col("computed_at") == computed_at) & (F.col("run_seq") < run_seq))
        earlier = history.filter((F.col("run_id") != run_id) & before).select(*values, F.col("source_run_id").alias("run_id"), "run_seq")
        merged = inc.metrics_upsert(earlier.select("*", order), numbered.select("*", order), period, order_col="_order").drop("_order")
    else:
        merged = numbered
    snapshot = materialize(merged, "metrics-merge").withColumnRenamed("run_id", "source_run_id").withColumn("run_id", F.lit(run_id))
    metric_totals = _write_run(snapshot, snap_path, inc.metric_totals())
    columns = [*values, F.col("source_run_id").alias("run_id")]
    snapshots = _read_runs(snap_schema, spark, snap_path)
    published = snapshots.filter(F.col("run_id") == run_id).select(*columns)

    # The one table that consumers read: the newest row of each of the latest
    # months over all snapshots, so rerunning an older night changes nothing
    # that a newer night published.
    newest = inc.latest_by_key(snapshots.select(*columns, order), ["year_month"], "_order").drop("_order")
    publish(newest.orderBy(F.col("year_month").desc()).limit(CURRENT_MONTHS), f"{out_dir}/metrics_current")
    current = read_published(spark, f"{out_dir}/metrics_current", new.schema)

    # 3. numerator audit rows, kept across runs
    if reference:
        num = ver.numerator_patients(cohort, run_id=run_id, computed_at=computed_at)
    else:
        audited = [
            ind.numerator_patients(
                p.discharge, p.diagnosis, p.procedure, w.flags(spec), spec, period, ref_version=ref_version, run_id=run_id,
                computed_at=computed_at, prefilter=prefilter,
            )
            for p in parts
        ]
        num = union_all(*audited)
    _write_run(num, f"{out_dir}/numerator_patients")
    numer = _read_runs(num.schema, spark, f"{out_dir}/numerator_patients")

    # 4. checks on what was published
    found = [
        dq.metric_bounds(published.withColumnRenamed("year_month", "month"), expected_months=n_months),
        dq.mom_change(published.withColumnRenamed("year_month", "month"), max_mom_change),
    ]
    if versions is None:
        start = reference.versions.started(run_date) if reference else _dt.date(w.year, 1, 1)
        versions = spark.range(1).select(F.lit(start).cast("date").alias("effective_start_date"), F.lit(True).alias("is_active"))
    found.append(dq.freshness(versions, run_date))
    checks = union_all(*found).withColumn("run_id", F.lit(run_id))
    check_totals = _write_run(checks, f"{out_dir}/checks", inc.failed_checks())
    checks_all = _read_runs(checks.schema, spark, f"{out_dir}/checks")

    # 5. run log row, from what the writes counted
    totals = spark.range(1).select(*[F.lit(v).cast("bigint").alias(n) for n, v in {**metric_totals, **check_totals}.items()])
    log = inc.run_log_row(totals, run_id=run_id, execution_date=run_date, period=period, ref_version=ref_version)
    times = {"started_at": started, "ended_at": _dt.datetime.now(_dt.timezone.utc)}
    log = log.select("*", *[F.lit(t).cast("timestamp").alias(n) for n, t in times.items()])
    _write_run(log, f"{out_dir}/run_log")
    logs = _read_runs(log.schema, spark, f"{out_dir}/run_log")
    return RunOutputs(metrics=published, current=current, numerator_patients=numer, checks=checks_all, run_log=logs)
