"""Named queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables through the fixture projection, so its
work grows with the scale factor. Parameters (reference year, run dates,
windows) are the fixture values documented in FIXTURES.md.
"""

from __future__ import annotations

import datetime as _dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.functions import safe_date, strict_bigint, text_list
from indicata.operators import facts
from indicata.operators import fingerprint as fp
from indicata.operators import incremental as inc
from indicata.operators import indicator as ind
from indicata.operators import quality as dq
from indicata.operators import reference as ref
from indicata.operators import summary as summ
from indicata.operators import versioned as ver
from indicata.operators.intervals import RangeTable, lookup_intervals, overlaps, resolved
from indicata.operators.joins import bounded_broadcast, lacking, lookup, narrowed
from indicata.plans.nightly import RunOutputs, StagedExtract, VersionedReference, compact_corrections, nightly_run
from indicata.plans.warehouse import LEAST_BUCKETS, Warehouse, fixture_warehouse
from indicata.sources import fixtures as fx
from indicata.sources import sinks
from indicata.sources.contract import (
    CODE_LIST_SCHEMA,
    DIAGNOSIS_SCHEMA,
    PATIENT_SCHEMA,
    PROCEDURE_SCHEMA,
    read_contract,
    read_quarantined,
)

from indicata.sources.touched import KeyedTable

YEAR = fx.FIXTURE_YEAR
RUN_DATE = fx.FIXTURE_RUN_DATE
ROLLING_RUN_DATE = fx.FIXTURE_ROLLING_RUN_DATE
PREVIOUS_ROLLING_RUN_DATE = _dt.date(1997, 5, 31)
BACKFILL = ("1996-01", "1997-12")
FRESHNESS_RUN_DATE = _dt.date(1998, 1, 15)
SPEC = ind.IndicatorSpec()
#: Partitions of the inputs when the model is built a second time, for each of the fewest buckets that a warehouse has.
RERUN_PARTITIONS = 5
#: Buckets of the patient store in (year, bucket) folders.
TOUCHED_BUCKETS = 16

_WAREHOUSES: dict[tuple, Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str, sepsis_hi: int = 12) -> Warehouse:
    """One lazily-built warehouse per (session, input, code-list variant)."""
    key = (spark, sf_dir, sepsis_hi)
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = fixture_warehouse(spark, sf_dir, YEAR, sepsis_hi)
    return _WAREHOUSES[key]


# -- sources and sinks ---------------------------------------------------------


def _csv_roundtrip(spark: SparkSession, df: DataFrame, name: str, schema: T.StructType) -> DataFrame:
    path = sinks.fresh_path(spark, name)
    sinks.write_csv(df, path)
    return read_contract(spark, path, schema)


def src_patient(spark, sf):
    return _csv_roundtrip(spark, fx.raw_patient(spark, sf), "src_patient", PATIENT_SCHEMA)


def src_procedure(spark, sf):
    return _csv_roundtrip(spark, fx.raw_procedure(spark, sf), "src_procedure", PROCEDURE_SCHEMA)


def src_diagnosis(spark, sf):
    return _csv_roundtrip(spark, fx.raw_diagnosis(spark, sf), "src_diagnosis", DIAGNOSIS_SCHEMA)


def src_codes(spark, sf):
    out = None
    for name, df in fx.code_lists(spark, sf).items():
        back = _csv_roundtrip(spark, df, f"src_{name}", CODE_LIST_SCHEMA).select(F.lit(name).alias("list_name"), "*")
        out = back if out is None else out.unionByName(back)
    return out


def src_quarantine(spark, sf):
    """Every diagnosis record of four deliveries, loaded or with the reason why it was not.

    One delivery is sound; the others have a wrong header, records without
    their last two fields, and ranks that are no numbers."""
    raw, kind = fx.raw_diagnosis(spark, sf), F.col("patient_id").cast("bigint") % 50
    paths = {n: sinks.fresh_path(spark, f"src_quarantine-{n}") for n in ("sound", "header", "short", "rank")}
    sinks.write_csv(raw.filter(kind > 2), paths["sound"])
    sinks.write_csv(raw.filter(kind == 0).withColumnRenamed("diag_code", "code"), paths["header"])
    sinks.write_csv(raw.filter(kind == 2).withColumn("diag_rank_num", F.concat(F.lit("no "), F.col("diag_rank_num"))), paths["rank"])
    lines = raw.filter(kind == 1).select(F.concat_ws(",", "patient_id", "diag_code").alias("value"))
    # Every task writes a file of its own, whose first record follows the header.
    header, first = ",".join(DIAGNOSIS_SCHEMA.names), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    lines.select(F.when(first, F.concat(F.lit(f"{header}\n"), "value")).otherwise(F.col("value")).alias("value")).write.text(paths["short"])
    good, bad = read_quarantined(spark, list(paths.values()), DIAGNOSIS_SCHEMA)
    columns = ["patient_id", "diag_code", "diag_rank_num"]
    loaded = good.select(F.lit("loaded").alias("reason"), "patient_id", "diag_code", F.col("diag_rank_num").cast("string").alias("diag_rank_num"))
    # Without the lines that are a wrong header themselves.
    return loaded.unionByName(bad.filter("patient_id <> 'patient_id'").select("reason", *columns))


def sink_month_roundtrip(spark, sf):
    fct = warehouse(spark, sf).fct_discharge
    path = sinks.fresh_path(spark, "fct_discharge")
    sinks.write_by_month(fct, path, "discharge_date")
    return sinks.read_by_month(spark, path, fct.schema)


def sink_year_roundtrip(spark, sf):
    cmap = warehouse(spark, sf).code_map
    path = sinks.fresh_path(spark, "code_map")
    sinks.write_by_year(cmap, path, cluster_by=("code_type", "code"))
    return sinks.read_by_year(spark, path, cmap.schema).select(cmap.columns)


def sink_clustered_roundtrip(spark, sf):
    """The code map in one layout that serves filters on code, type and identifier."""
    cmap = warehouse(spark, sf).code_map
    path = sinks.fresh_path(spark, "code_map-clustered")
    sinks.write_clustered(cmap, path, ("code", "code_type", "identifier"))
    return spark.read.schema(cmap.schema).parquet(path)


def sink_rerun_idempotent(spark, sf):
    fct = warehouse(spark, sf).fct_diagnosis
    path = sinks.fresh_path(spark, "fct_diagnosis")
    sinks.full_refresh(fct, path)
    sinks.full_refresh(fct, path)
    return spark.read.schema(fct.schema).parquet(path)


def sink_csv_roundtrip(spark, sf):
    metrics = warehouse(spark, sf).monthly()
    path = sinks.fresh_path(spark, "monthly_csv")
    sinks.export_csv(metrics, path, order_by="month")
    schema = T.StructType(
        [
            T.StructField("month", T.StringType()),
            T.StructField("numerator", T.LongType()),
            T.StructField("denominator", T.LongType()),
            T.StructField("rate", T.DoubleType()),
        ]
    )
    return read_contract(spark, path, schema)


# -- typed tables, projections ---------------------------------------------------


def core_patient(spark, sf):
    return warehouse(spark, sf).core_patient


def core_procedure(spark, sf):
    return warehouse(spark, sf).core_procedure


def core_diagnosis(spark, sf):
    return warehouse(spark, sf).core_diagnosis


def safe_date_parse(spark, sf):
    raw = fx.raw_patient(spark, sf)
    return raw.select(
        strict_bigint(F.col("patient_id")).alias("patient_id"),
        F.col("birth_date").alias("birth_date_text"),
        safe_date(F.col("birth_date")).alias("birth_date"),
    )


def age_at_admission(spark, sf):
    return warehouse(spark, sf).fct_discharge.select("patient_id", "age_at_admission")


def adult_flag(spark, sf):
    from indicata.functions import adult_flag as _adult

    p = warehouse(spark, sf).core_patient
    return p.select(
        "patient_id",
        _adult(F.col("birth_date"), F.col("admission_date")).alias("is_adult"),
        _adult(F.col("birth_date"), F.col("admission_date"), strict_age=True).alias("is_adult_strict"),
    )


def elective_flag(spark, sf):
    return warehouse(spark, sf).fct_discharge.select("patient_id", "admission_type", "is_elective")


def diag_type(spark, sf):
    return warehouse(spark, sf).fct_diagnosis.select(
        "patient_id", "diag_code", "diag_rank_num", "diag_type", "is_principal_diag"
    )


# -- reference layer ---------------------------------------------------------------


def code_map(spark, sf):
    return warehouse(spark, sf).code_map_base


def unknown_members(spark, sf):
    return warehouse(spark, sf).code_map


def dim_code(spark, sf):
    return warehouse(spark, sf).dim_code


def bridge(spark, sf):
    return warehouse(spark, sf).bridge


def dim_date(spark, sf):
    """The date dimension over the days that the typed patient rows span."""
    span = warehouse(spark, sf).core_patient.agg(F.min("birth_date").alias("first"), F.max("discharge_date").alias("last")).first()
    missing = facts.MISSING_DATE  # the default of absent dates always has its day
    first, last = min(span["first"] or missing, missing), max(span["last"] or missing, missing)
    return ref.dim_date(spark, first, last)


def code_identifiers(spark, sf):
    ci = warehouse(spark, sf).code_identifiers
    return ci.select("code_sk", "code_type", "reference_year", text_list(F.col("identifiers")).alias("identifiers"))


def numerator_codes(spark, sf):
    return ref.code_set(warehouse(spark, sf).bridge, "Diagnosis", YEAR, SPEC.numerator_identifiers)


# -- facts and joins -------------------------------------------------------------------


def fct_discharge(spark, sf):
    return warehouse(spark, sf).fct_discharge


def fct_diagnosis(spark, sf):
    return warehouse(spark, sf).fct_diagnosis


def fct_procedure(spark, sf):
    return warehouse(spark, sf).fct_procedure


def date_roles(spark, sf):
    w = warehouse(spark, sf)
    dd = w.dim_date
    role = lambda prefix, cols: bounded_broadcast(narrowed(dd, dd.select(
        F.col("full_date").alias(f"{prefix}_date"), *[F.col(c).alias(f"{prefix}_{c}") for c in cols]
    )))
    out = (
        w.fct_discharge.select("patient_id", "birth_date", "admission_date", "discharge_date")
        .join(role("birth", ["date_sk", "year"]), "birth_date", "left")
        .join(role("admission", ["date_sk", "year_month"]), "admission_date", "left")
        .join(role("discharge", ["date_sk", "month_start_date"]), "discharge_date", "left")
    )
    return out.select(
        "patient_id",
        F.coalesce(F.col("birth_date_sk"), F.lit(-1).cast("bigint")).alias("birth_date_sk"),
        "birth_year",
        F.coalesce(F.col("admission_date_sk"), F.lit(-1).cast("bigint")).alias("admission_date_sk"),
        "admission_year_month",
        F.coalesce(F.col("discharge_date_sk"), F.lit(-1).cast("bigint")).alias("discharge_date_sk"),
        "discharge_month_start_date",
    )


def code_lookup_left(spark, sf):
    w = warehouse(spark, sf)
    dims = narrowed(
        w.dim_code,
        w.dim_code.filter((F.col("code_type") == "Diagnosis") & (F.col("reference_year") == YEAR)).select(
            F.col("code").alias("diag_code"), "code_sk", "code_description"
        ),
    )
    return lookup(w.fct_diagnosis.select("patient_id", "diag_code", "diag_rank_num"), dims, ["diag_code"])


def orphan_children(spark, sf):
    w = warehouse(spark, sf)
    # Parent encounters minus every seventh one; read from the discharge fact
    # (one row per patient record, bucketed like the children: co-located).
    parents = w.fct_discharge.filter(F.col("patient_id") % 7 != 0).select("patient_id").distinct()
    children = w.fct_diagnosis.select("patient_id", "diag_code", "diag_rank_num")
    return children.join(parents.withColumn("has_parent", F.lit(1).cast("bigint")), "patient_id", "left").select(
        "patient_id", "diag_code", "diag_rank_num", F.coalesce(F.col("has_parent"), F.lit(0).cast("bigint")).alias("has_parent")
    )


def semi_surgical(spark, sf):
    w = warehouse(spark, sf)
    flags = w.flags(SPEC)
    keys = narrowed(flags, flags.filter(F.col("is_surgical_drg") == 1).select(F.col("code_sk").alias("drg_code_sk")))
    return w.fct_discharge.join(bounded_broadcast(keys), "drg_code_sk", "left_semi").select(
        "patient_id", "drg", "drg_code_sk"
    )


def semi_or_procedure(spark, sf):
    w = warehouse(spark, sf)
    return w.fct_discharge.join(ind.or_procedure_patients(w.fct_procedure, w.flags(SPEC)), "patient_id", "left_semi").select(
        "patient_id"
    )


def ungroupable_drg(spark, sf):
    p = warehouse(spark, sf).core_patient
    return p.filter(ind.ungroupable_drg(p, SPEC)).select("patient_id", "drg")


# -- cohorts and the indicator ---------------------------------------------------------


def denominator_inclusions(spark, sf):
    w = warehouse(spark, sf)
    return w.over_parts(lambda p: ind.inclusions(p.discharge, p.procedure, w.flags(SPEC), SPEC, ind.Period.year(YEAR)))


def denominator_exclusions(spark, sf):
    w = warehouse(spark, sf)
    return w.over_parts(lambda p: ind.exclusions(p.discharge, p.diagnosis, w.flags(SPEC), SPEC))


def eligible(spark, sf):
    return lacking(denominator_inclusions(spark, sf), denominator_exclusions(spark, sf), "patient_id")


def monthly_metrics(spark, sf):
    return warehouse(spark, sf).monthly(SPEC, ind.Period.year(YEAR))


def exclusion_reasons(spark, sf):
    return _exclusion_reasons(warehouse(spark, sf))


def _exclusion_reasons(w: Warehouse) -> DataFrame:
    counted = w.over_parts(
        lambda p: ind.exclusion_reasons(p.discharge, p.diagnosis, p.procedure, w.flags(SPEC), SPEC, ind.Period.year(YEAR), prefilter=w.prefilter)
    )
    return counted.groupBy("year_month", "reason").agg(F.sum("encounters").alias("encounters"))


_HOT_WAREHOUSES: dict[tuple, Warehouse] = {}


def hot_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse in which one encounter has a third of all diagnosis lines, one
    of all procedures and one of all discharges."""
    key = (spark, sf_dir)
    if key not in _HOT_WAREHOUSES:
        _HOT_WAREHOUSES[key] = Warehouse(spark, fx.hot_inputs(spark, sf_dir), YEAR)
    return _HOT_WAREHOUSES[key]


def hot_encounter_metrics(spark, sf):
    """The monthly indicator beside hot encounters."""
    return hot_warehouse(spark, sf).monthly(SPEC, ind.Period.year(YEAR))


def hot_encounter_reasons(spark, sf):
    return _exclusion_reasons(hot_warehouse(spark, sf))


def hot_encounter_arrays(spark, sf):
    """Principal line, and number and SHA-256 of the arrays' codes, of every discharge beside hot encounters."""
    flat = hot_warehouse(spark, sf).discharge_summary_flat
    return flat.select(
        "patient_id", "discharge_date", "principal_code", "principal_poa", "n_secondary", F.sha2("secondary_codes", 256).alias("secondary_sha256"),
        "n_procedures", F.sha2("procedure_codes", 256).alias("procedures_sha256"),
    )


# -- nested summary ------------------------------------------------------------------------


def _summary(w: Warehouse) -> DataFrame:
    return w.discharge_summary


def _diag_arrays(w: Warehouse) -> DataFrame:
    ci = w.code_identifiers
    return summ.diagnosis_arrays(summ.diagnosis_structs(w.fct_diagnosis, w.dim_code, ci, YEAR))


def discharge_summary_flat(spark, sf):
    return warehouse(spark, sf).discharge_summary_flat


def principal_diagnosis(spark, sf):
    a = _diag_arrays(warehouse(spark, sf))
    p = F.col("principal_diagnosis")
    return a.select(
        "patient_id",
        p["code_sk"].alias("code_sk"),
        p["code"].alias("code"),
        text_list(p["identifiers"]).alias("identifiers"),
        p["is_present_on_admission"].alias("is_present_on_admission"),
    )


def secondary_diagnoses(spark, sf):
    a = _diag_arrays(warehouse(spark, sf))
    e = summ.explode_positions(a, "secondary_diagnoses", ["code_sk", "code", "identifiers", "is_present_on_admission"])
    return e.withColumn("identifiers", text_list(F.col("identifiers")))


def procedures_array(spark, sf):
    w = warehouse(spark, sf)
    a = summ.procedure_arrays(w.fct_procedure, w.dim_code, w.code_identifiers, YEAR)
    e = summ.explode_positions(a, "procedures", ["code_sk", "code", "identifiers"])
    return e.withColumn("identifiers", text_list(F.col("identifiers")))


# -- incremental and audit -------------------------------------------------------------------


def _rolling(w: Warehouse, run_date: _dt.date, spine: bool) -> DataFrame:
    period = ind.Period.rolling(run_date)
    m = w.monthly(SPEC, period)
    return inc.with_month_spine(m, period) if spine else m


def rolling_12m(spark, sf):
    return _rolling(warehouse(spark, sf), ROLLING_RUN_DATE, spine=False)


def rolling_12m_spine(spark, sf):
    return _rolling(warehouse(spark, sf), ROLLING_RUN_DATE, spine=True)


def backfill_range(spark, sf):
    period = ind.Period.months(*BACKFILL)
    return inc.with_month_spine(warehouse(spark, sf).monthly(SPEC, period), period)


def lookback_extract(spark, sf):
    return inc.lookback_extract(fx.staged_patient(spark, sf), RUN_DATE)


def upsert_latest(spark, sf):
    current = fx.staged_patient(spark, sf, versions=(1,))
    changes = inc.lookback_extract(fx.staged_patient(spark, sf), RUN_DATE)
    return inc.upsert_latest(current, changes, ["patient_id"], "updated_at")


def upsert_touched(spark, sf):
    """The same upsert on a table in (year, bucket) folders: the touched ones are rewritten."""
    current = fx.staged_patient(spark, sf, versions=(1,))
    store = KeyedTable(spark, sinks.fresh_path(spark, "patient-store"), current.schema, "patient_id", "discharge_date", TOUCHED_BUCKETS)
    store.create(current)
    store.upsert(inc.lookback_extract(fx.staged_patient(spark, sf), RUN_DATE), "updated_at")
    return store.read()


def _corrected(spark: SparkSession, sf: str) -> DataFrame:
    """Encounters whose correction lies in the night's lookback."""
    changes = inc.lookback_extract(fx.staged_patient(spark, sf, versions=(2,)), RUN_DATE)
    return changes.select(strict_bigint(F.col("patient_id")).alias("patient_id"))


def upsert_fct_diagnosis(spark, sf):
    w = warehouse(spark, sf)
    staged = facts.fct_diagnosis(facts.core_diagnosis(fx.staged_lines(w.raw.diagnosis, "diagnosis")), w.dim_code, YEAR)
    return inc.replace_children(w.fct_diagnosis, staged, _corrected(spark, sf))


def upsert_fct_procedure(spark, sf):
    w = warehouse(spark, sf)
    staged = facts.fct_procedure(facts.core_procedure(fx.staged_lines(w.raw.procedure, "procedure")), w.dim_code, YEAR)
    return inc.replace_children(w.fct_procedure, staged, _corrected(spark, sf))


def _metrics_run(w: Warehouse, run_date: _dt.date) -> DataFrame:
    m = _rolling(w, run_date, spine=True)
    return m.select(
        F.col("month").alias("year_month"),
        "numerator",
        "denominator",
        "rate",
        F.lit(f"{SPEC.name}-{run_date.isoformat()}").alias("run_id"),
        inc.run_timestamp(run_date).alias("computed_at"),
        F.lit(f"{YEAR}-01-01").alias("ref_version"),
    )


def metrics_upsert(spark, sf):
    w = warehouse(spark, sf)
    current = _metrics_run(w, PREVIOUS_ROLLING_RUN_DATE)
    new = _metrics_run(w, ROLLING_RUN_DATE)
    return inc.metrics_upsert(current, new, ind.Period.rolling(ROLLING_RUN_DATE))


def _numerator_patients(w: Warehouse, run_id: str) -> DataFrame:
    return w.over_parts(
        lambda p: ind.numerator_patients(
            p.discharge, p.diagnosis, p.procedure, w.flags(SPEC), SPEC, ind.Period.year(YEAR),
            ref_version=f"{YEAR}-01-01", run_id=run_id, computed_at=inc.run_timestamp(RUN_DATE), prefilter=w.prefilter,
        )
    )


def numerator_patients(spark, sf):
    return _numerator_patients(warehouse(spark, sf), f"{SPEC.name}-{RUN_DATE.isoformat()}")


def numerator_diff(spark, sf):
    a = _numerator_patients(warehouse(spark, sf, 12), "run-a")
    b = _numerator_patients(warehouse(spark, sf, 14), "run-b")
    return inc.numerator_diff(a, b)


def run_log(spark, sf):
    w = warehouse(spark, sf)
    m = w.metrics_table(SPEC, ind.Period.year(YEAR))
    return inc.run_log(
        m,
        run_id=f"{SPEC.name}-{RUN_DATE.isoformat()}",
        execution_date=RUN_DATE,
        period=ind.Period.year(YEAR),
        ref_version=f"{YEAR}-01-01",
        dq=dq.metric_bounds(m),
    )


_VERSIONED: dict[tuple, tuple[DataFrame, RangeTable]] = {}


def _versioned(spark: SparkSession, sf: str) -> tuple[DataFrame, RangeTable]:
    """Per-version sepsis flags, written once, and the versions' ranges."""
    key = (spark, sf)
    if key not in _VERSIONED:
        vmap = fx.versioned_code_lists(spark, sf)
        flags = sinks.materialize(inc.versioned_code_flags(vmap, "Diagnosis", SPEC.numerator_identifiers), "ref-vflags")
        _VERSIONED[key] = (flags, RangeTable.of(inc.effective_versions(vmap)))
    return _VERSIONED[key]


def effective_dated_lookup(spark, sf):
    w = warehouse(spark, sf)
    flags, versions = _versioned(spark, sf)
    # Left: a diagnosis line without a discharge keeps its row, without a version.
    rows = w.fct_diagnosis.select("patient_id", "diag_code", "diag_rank_num").join(
        w.fct_discharge.select("patient_id", "discharge_date"), "patient_id", "left"
    )
    out = inc.effective_dated_lookup(rows, "discharge_date", "diag_code", flags, versions)
    return out.select("patient_id", "diag_code", "diag_rank_num", "ref_version", F.col("in_set").alias("is_sepsis_code"))


def _code_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return fx.code_ranges(spark, sf)


def interval_lookup(spark, sf):
    """The validity range of each diagnosis line's code on its discharge date;
    the ranges of a code overlap and leave gaps."""
    w = warehouse(spark, sf)
    rows = w.fct_diagnosis.select("patient_id", "diag_code", "diag_rank_num").join(
        w.fct_discharge.select("patient_id", "discharge_date"), "patient_id", "left"
    )
    arrays = sinks.materialize(resolved(_code_ranges(spark, sf), ["diag_code"], "range_name"), "ref-ranges")
    return lookup_intervals(rows, "discharge_date", ["diag_code"], arrays, "range_name")


def dq_range_overlap(spark, sf):
    """Ranges of a code that begin before an earlier one has ended."""
    return overlaps(_code_ranges(spark, sf), ["diag_code"])


_VERSIONED_DIMS: dict[tuple, tuple] = {}


def _versioned_facts(spark: SparkSession, sf: str) -> tuple:
    """The three facts under the code lists effective on each discharge, and the codes of all versions."""
    key, w = (spark, sf), warehouse(spark, sf)
    if key not in _VERSIONED_DIMS or _VERSIONED_DIMS[key][0] is not w:
        vmap = fx.versioned_code_lists(spark, sf)
        ranges = vmap.select("effective_start_date", "effective_end_date", "reference_year").distinct()
        versions = ver.encounter_versions(w.core_patient, _versioned(spark, sf)[1], RangeTable.of(ranges, "reference_year"))
        _VERSIONED_DIMS[key] = (w, sinks.materialize(ver.versioned_dim(vmap), "ref-vdim"), w._save_fact(versions, "encounter_versions"))
    _, dim, versions = _VERSIONED_DIMS[key]
    return (
        ver.rekeyed(w.fct_discharge, versions, dim, "DRG", "drg", "drg_code_sk"),
        ver.rekeyed(w.fct_diagnosis, versions, dim, "Diagnosis", "diag_code", "diag_code_sk"),
        ver.rekeyed(w.fct_procedure, versions, dim, "Procedure", "procedure_code", "procedure_code_sk"),
        dim,
    )


def fct_discharge_versioned(spark, sf):
    return _versioned_facts(spark, sf)[0]


def fct_diagnosis_versioned(spark, sf):
    return _versioned_facts(spark, sf)[1]


def fct_procedure_versioned(spark, sf):
    return _versioned_facts(spark, sf)[2]


def discharge_summary_versioned(spark, sf):
    """The nested summary with keys and identifiers of the version effective on each discharge."""
    d, dx, pr, dim = _versioned_facts(spark, sf)
    return summ.flatten_summary(summ.discharge_summary(d.drop("ref_version"), dx, pr, dim, None, None, ci=dim))


_REFERENCES: dict[tuple, VersionedReference] = {}


def _reference(spark: SparkSession, sf: str) -> VersionedReference:
    """The indicator's flags per version and the version table, written once."""
    key = (spark, sf)
    if key not in _REFERENCES:
        flags = ver.versioned_flags(fx.versioned_code_lists(spark, sf), SPEC)
        _REFERENCES[key] = VersionedReference(sinks.materialize(flags, "ref-indicator-vflags"), _versioned(spark, sf)[1])
    return _REFERENCES[key]


def _versioned_cohort(spark: SparkSession, sf: str) -> DataFrame:
    """The rolling window across January, each discharge by its own year's lists."""
    reference = _reference(spark, sf)
    return warehouse(spark, sf).over_parts(
        lambda p: ver.eligible(p.discharge, p.diagnosis, p.procedure, reference.flags, reference.versions, SPEC, ind.Period.rolling(ROLLING_RUN_DATE))
    )


def monthly_metrics_versioned(spark, sf):
    return ver.monthly(_versioned_cohort(spark, sf), SPEC)


def numerator_patients_versioned(spark, sf):
    run_id = f"{SPEC.name}-{ROLLING_RUN_DATE.isoformat()}"
    return ver.numerator_patients(_versioned_cohort(spark, sf), run_id=run_id, computed_at=inc.run_timestamp(ROLLING_RUN_DATE))


def stream_staged_upsert(spark, sf):
    """Two staged extracts (all version-1 rows, then the version-2
    corrections) applied by the Structured Streaming loader, one file per
    micro-batch; the result is the newest row per encounter."""
    from indicata.streaming.ingest import apply_staged_extracts

    staging = sinks.fresh_path(spark, "staging")
    fx.staged_patient(spark, sf, versions=(1,)).write.parquet(staging)
    fx.staged_patient(spark, sf, versions=(2,)).write.mode("append").parquet(staging)
    schema = fx.staged_patient(spark, sf).schema
    return apply_staged_extracts(
        spark, staging, schema, sinks.fresh_path(spark, "patient-state"), ["patient_id"], "updated_at",
        max_files_per_trigger=1,
    )


_NIGHTS: dict[tuple, tuple] = {}


def _two_nights(spark, sf):
    """Run the nightly plan for two consecutive month-ends into a fresh folder
    (once per warehouse; both nightly keys read the same published folder)."""
    w = warehouse(spark, sf)
    key = (spark, sf)
    hit = _NIGHTS.get(key)
    if hit is None or hit[0] is not w:
        out = sinks.fresh_path(spark, "nightly")
        reference = _reference(spark, sf)
        nightly_run(w, PREVIOUS_ROLLING_RUN_DATE, out, spec=SPEC, reference=reference)
        hit = _NIGHTS[key] = (w, nightly_run(w, ROLLING_RUN_DATE, out, spec=SPEC, reference=reference))
    return hit[1]


def nightly_metrics(spark, sf):
    return _two_nights(spark, sf).metrics


def nightly_run_log(spark, sf):
    """The log of both nights (without its times, see ``run_log_observed``)."""
    return _two_nights(spark, sf).run_log.drop("started_at", "ended_at")


def run_log_observed(spark, sf):
    """Totals of both nights as the writes counted them, and whether their times are there and in order."""
    log = _two_nights(spark, sf).run_log
    return log.select("run_id", "numerator", "denominator", "months", "dq_status", (F.col("started_at") < F.col("ended_at")).alias("timed"))


def nightly_checks(spark, sf):
    """The checks of both nights, freshness of the reference data among them."""
    return _two_nights(spark, sf).checks


def nightly_compacted(spark, sf):
    """A night on facts into whose touched years the corrections were written."""
    w = fixture_warehouse(spark, sf, YEAR)
    compact_corrections(w, staged_extract(spark, sf), ROLLING_RUN_DATE, built_on=PREVIOUS_ROLLING_RUN_DATE)
    out = sinks.fresh_path(spark, "nightly-compacted-run")
    return nightly_run(w, ROLLING_RUN_DATE, out, spec=SPEC, reference=_reference(spark, sf)).metrics


def nightly_numerator_audit(spark, sf):
    return _two_nights(spark, sf).numerator_patients


_BACKFILLS: dict[tuple, tuple[Warehouse, RunOutputs]] = {}


def _night_and_backfill(spark: SparkSession, sf: str) -> RunOutputs:
    """A night, then a backfill of an earlier quarter on the same run date (run once per warehouse)."""
    w, key = warehouse(spark, sf), (spark, sf)
    if key not in _BACKFILLS or _BACKFILLS[key][0] is not w:
        out, reference = sinks.fresh_path(spark, "nightly-backfill"), _reference(spark, sf)
        nightly_run(w, ROLLING_RUN_DATE, out, spec=SPEC, reference=reference)
        quarter = ind.Period.months("1996-01", "1996-03")
        _BACKFILLS[key] = (w, nightly_run(w, ROLLING_RUN_DATE, out, spec=SPEC, reference=reference, period=quarter))
    return _BACKFILLS[key][1]


def nightly_current(spark, sf):
    """The current table after the night and the backfill: still the night's months."""
    return _night_and_backfill(spark, sf).current


def staged_extract(spark: SparkSession, sf: str) -> StagedExtract:
    raw = warehouse(spark, sf).raw
    return StagedExtract(fx.staged_patient(spark, sf, versions=(2,)), fx.staged_lines(raw.diagnosis, "diagnosis"), fx.staged_lines(raw.procedure, "procedure"))


def nightly_from_extract(spark, sf):
    """A night that first applies the corrections since the night before."""
    run = nightly_run(
        warehouse(spark, sf), ROLLING_RUN_DATE, sinks.fresh_path(spark, "nightly-extract-run"), spec=SPEC,
        reference=_reference(spark, sf), staged=staged_extract(spark, sf), built_on=PREVIOUS_ROLLING_RUN_DATE,
    )
    return run.metrics


def nightly_backfill(spark, sf):
    """The audit rows of the night and of the backfill both stay, counted per run and month."""
    run = _night_and_backfill(spark, sf)
    return run.numerator_patients.groupBy("run_id", "year_month").agg(F.count(F.lit(1)).alias("encounters"))


# -- data quality ---------------------------------------------------------------------------------


def dq_row_counts(spark, sf):
    w = warehouse(spark, sf)
    return dq.row_counts(
        {
            "raw_patient": w.raw.patient,
            "raw_diagnosis": w.raw.diagnosis,
            "raw_procedure": w.raw.procedure,
            "code_map": w.code_map,
            "dim_code": w.dim_code,
            "bridge": w.bridge,
            "fct_discharge": w.fct_discharge,
            "fct_diagnosis": w.fct_diagnosis,
            "fct_procedure": w.fct_procedure,
        }
    )


def dq_pk_unique(spark, sf):
    w = warehouse(spark, sf)
    return dq.pk_unique(
        {
            "fct_discharge": (w.fct_discharge, ["patient_id"]),
            "fct_diagnosis": (w.fct_diagnosis, ["patient_id", "diag_code_sk"]),
            "fct_procedure": (w.fct_procedure, ["patient_id", "procedure_code"]),
            "core_diagnosis": (w.core_diagnosis, ["patient_id", "diag_code"]),
            "code_map": (w.code_map, ["code_identifier_sk"]),
            "dim_code": (w.dim_code, ["code_sk"]),
            "bridge": (w.bridge, ["code_sk", "identifier_sk", "reference_year"]),
        }
    )


def dq_fk_orphans(spark, sf):
    w = warehouse(spark, sf)
    return dq.fk_orphans(
        {
            "fct_discharge.drg_code_sk": (w.fct_discharge, "drg_code_sk", w.dim_code, "code_sk", True),
            "fct_diagnosis.diag_code_sk": (w.fct_diagnosis, "diag_code_sk", w.dim_code, "code_sk", True),
            "fct_procedure.procedure_code_sk": (w.fct_procedure, "procedure_code_sk", w.dim_code, "code_sk", True),
            "fct_discharge.birth_date_sk": (w.fct_discharge, "birth_date_sk", w.dim_date, "date_sk", True),
            "fct_discharge.admission_date_sk": (w.fct_discharge, "admission_date_sk", w.dim_date, "date_sk", True),
            "fct_discharge.discharge_date_sk": (w.fct_discharge, "discharge_date_sk", w.dim_date, "date_sk", True),
            "fct_diagnosis.patient_id": (w.fct_diagnosis, "patient_id", w.fct_discharge, "patient_id", False),
            "fct_procedure.patient_id": (w.fct_procedure, "patient_id", w.fct_discharge, "patient_id", False),
        }
    )


def dq_unknown_share(spark, sf):
    w = warehouse(spark, sf)
    discharge = w.fct_discharge  # one frame for both columns: one scan
    return dq.unknown_share(
        {
            "fct_discharge.drg": (discharge, F.col("drg") == "UNKNOWN"),
            "fct_discharge.admission_type": (discharge, F.col("admission_type") == "UNKNOWN"),
            "fct_diagnosis.diag_code": (w.fct_diagnosis, F.col("diag_code") == "UNKNOWN"),
            "fct_procedure.procedure_code": (w.fct_procedure, F.col("procedure_code") == "UNKNOWN"),
        }
    )


def dq_principal(spark, sf):
    w = warehouse(spark, sf)
    return dq.principal_rule(w.fct_discharge, w.fct_diagnosis)


def dq_dates(spark, sf):
    return dq.date_order(warehouse(spark, sf).core_patient)


def dq_parse(spark, sf):
    """Raw text that does not parse: dates of patients, ids of all three tables."""
    raw = warehouse(spark, sf).raw
    return dq.parses(
        {
            "raw_patient": (raw.patient, {"birth_date": "date", "admission_date": "date", "discharge_date": "date", "patient_id": "bigint"}),
            "raw_diagnosis": (raw.diagnosis, {"patient_id": "bigint"}),
            "raw_procedure": (raw.procedure, {"patient_id": "bigint"}),
        }
    )


def dq_nulls(spark, sf):
    w = warehouse(spark, sf)
    return dq.not_null(
        {
            "core_patient": (w.core_patient, ["birth_date", "admission_date", "discharge_date", "drg", "admission_type"]),
            "fct_discharge": (w.fct_discharge, ["age_at_admission"]),
            "fct_diagnosis": (w.fct_diagnosis, ["diag_rank_num"]),
        }
    )


def dq_metric_bounds(spark, sf):
    return dq.metric_bounds(warehouse(spark, sf).metrics_table(SPEC, ind.Period.year(YEAR)))


def dq_mom_change(spark, sf):
    return dq.mom_change(warehouse(spark, sf).metrics_table(SPEC, ind.Period.year(YEAR)), max_abs_change=0.1)


def dq_freshness(spark, sf):
    vmap = fx.versioned_code_lists(spark, sf, last_year=FRESHNESS_RUN_DATE.year - 1)
    versions = vmap.select("ref_version", "effective_start_date", "effective_end_date").distinct()
    latest = versions.agg(F.max("effective_start_date").alias("_latest"))
    active = versions.join(latest, F.col("effective_start_date") == F.col("_latest"), "left").select(
        "ref_version", "effective_start_date", "effective_end_date", F.col("_latest").isNotNull().alias("is_active")
    )
    return dq.freshness(active, FRESHNESS_RUN_DATE)


def dq_reconcile(spark, sf):
    w = warehouse(spark, sf)
    return dq.reconcile(_summary(w), w.fct_discharge, w.fct_diagnosis, w.fct_procedure)


def dq_reconcile_contents(spark, sf):
    """The summary's arrays against the facts, by content."""
    w = warehouse(spark, sf)
    return fp.reconcile_contents(_summary(w), w.fct_diagnosis, w.fct_procedure)


def dq_rerun(spark, sf):
    """The model built a second time, from its inputs in other partitions: every table has the same rows."""
    w = warehouse(spark, sf)
    parts = RERUN_PARTITIONS * (w.fact_buckets // LEAST_BUCKETS)
    dealt = lambda df: df.repartition(parts)
    raw = fx.RawInputs(dealt(w.raw.patient), dealt(w.raw.diagnosis), dealt(w.raw.procedure), dealt(w.raw.code_lists))
    again = Warehouse(spark, raw, YEAR, buckets=w.fact_buckets)
    tables = ("code_map", "dim_code", "bridge", "fct_discharge", "fct_diagnosis", "fct_procedure", "discharge_summary")
    pairs = {n: (getattr(w, n), getattr(again, n)) for n in tables}
    return fp.same_tables("rerun", {**pairs, "monthly_metrics": (w.metrics_table(SPEC), again.monthly(SPEC))})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "src_patient": src_patient,
    "src_procedure": src_procedure,
    "src_diagnosis": src_diagnosis,
    "src_codes": src_codes,
    "src_quarantine": src_quarantine,
    "sink_month_roundtrip": sink_month_roundtrip,
    "sink_year_roundtrip": sink_year_roundtrip,
    "sink_clustered_roundtrip": sink_clustered_roundtrip,
    "sink_rerun_idempotent": sink_rerun_idempotent,
    "sink_csv_roundtrip": sink_csv_roundtrip,
    "core_patient": core_patient,
    "core_procedure": core_procedure,
    "core_diagnosis": core_diagnosis,
    "safe_date_parse": safe_date_parse,
    "age_at_admission": age_at_admission,
    "adult_flag": adult_flag,
    "elective_flag": elective_flag,
    "diag_type": diag_type,
    "code_map": code_map,
    "unknown_members": unknown_members,
    "dim_code": dim_code,
    "bridge": bridge,
    "dim_date": dim_date,
    "code_identifiers": code_identifiers,
    "numerator_codes": numerator_codes,
    "fct_discharge": fct_discharge,
    "fct_diagnosis": fct_diagnosis,
    "fct_procedure": fct_procedure,
    "date_roles": date_roles,
    "code_lookup_left": code_lookup_left,
    "orphan_children": orphan_children,
    "semi_surgical": semi_surgical,
    "semi_or_procedure": semi_or_procedure,
    "ungroupable_drg": ungroupable_drg,
    "denominator_inclusions": denominator_inclusions,
    "denominator_exclusions": denominator_exclusions,
    "eligible": eligible,
    "monthly_metrics": monthly_metrics,
    "exclusion_reasons": exclusion_reasons,
    "hot_encounter_metrics": hot_encounter_metrics,
    "hot_encounter_reasons": hot_encounter_reasons,
    "hot_encounter_arrays": hot_encounter_arrays,
    "discharge_summary_flat": discharge_summary_flat,
    "principal_diagnosis": principal_diagnosis,
    "secondary_diagnoses": secondary_diagnoses,
    "procedures_array": procedures_array,
    "rolling_12m": rolling_12m,
    "rolling_12m_spine": rolling_12m_spine,
    "backfill_range": backfill_range,
    "lookback_extract": lookback_extract,
    "upsert_latest": upsert_latest,
    "upsert_touched": upsert_touched,
    "stream_staged_upsert": stream_staged_upsert,
    "upsert_fct_diagnosis": upsert_fct_diagnosis,
    "upsert_fct_procedure": upsert_fct_procedure,
    "metrics_upsert": metrics_upsert,
    "nightly_metrics": nightly_metrics,
    "nightly_numerator_audit": nightly_numerator_audit,
    "nightly_backfill": nightly_backfill,
    "nightly_current": nightly_current,
    "nightly_from_extract": nightly_from_extract,
    "nightly_run_log": nightly_run_log,
    "run_log_observed": run_log_observed,
    "nightly_checks": nightly_checks,
    "nightly_compacted": nightly_compacted,
    "dq_parse": dq_parse,
    "numerator_patients": numerator_patients,
    "numerator_diff": numerator_diff,
    "run_log": run_log,
    "effective_dated_lookup": effective_dated_lookup,
    "interval_lookup": interval_lookup,
    "dq_range_overlap": dq_range_overlap,
    "fct_discharge_versioned": fct_discharge_versioned,
    "fct_diagnosis_versioned": fct_diagnosis_versioned,
    "fct_procedure_versioned": fct_procedure_versioned,
    "discharge_summary_versioned": discharge_summary_versioned,
    "monthly_metrics_versioned": monthly_metrics_versioned,
    "numerator_patients_versioned": numerator_patients_versioned,
    "dq_row_counts": dq_row_counts,
    "dq_pk_unique": dq_pk_unique,
    "dq_fk_orphans": dq_fk_orphans,
    "dq_unknown_share": dq_unknown_share,
    "dq_principal": dq_principal,
    "dq_dates": dq_dates,
    "dq_nulls": dq_nulls,
    "dq_metric_bounds": dq_metric_bounds,
    "dq_mom_change": dq_mom_change,
    "dq_freshness": dq_freshness,
    "dq_reconcile": dq_reconcile,
    "dq_reconcile_contents": dq_reconcile_contents,
    "dq_rerun": dq_rerun,
}
