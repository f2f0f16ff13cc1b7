"""Plan-shape guards for the scale design: with encounter-bucketed facts the
encounter-level work must not shuffle fact rows."""

import contextlib
import io
import re

import pytest

from indicata.plans import catalog
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize(
    "key", ["monthly_metrics", "discharge_summary_flat", "denominator_exclusions", "numerator_patients", "dq_reconcile", "monthly_metrics_versioned"]
)
def test_no_encounter_shuffle_when_colocated(spark, key):
    assert len(catalog.warehouse(spark, SF_SMALL).parts) == 1
    plan = _plan(catalog.QUERIES[key](spark, SF_SMALL))
    assert not re.search(r"Exchange hashpartitioning\(patient_id", plan), plan


@pytest.mark.parametrize("key,scans", [("dq_dates", 1), ("dq_nulls", 3), ("dq_unknown_share", 3), ("dq_parse", 3)])
def test_checks_scan_each_table_once(spark, key, scans):
    plan = _plan(catalog.QUERIES[key](spark, SF_SMALL))
    assert len(re.findall(r"FileScan", plan)) == scans, plan


def test_a_broadcast_needs_proven_bytes(spark):
    from indicata.operators.joins import bounded_broadcast, declare_bytes

    ids = spark.range(10)
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert not hinted(bounded_broadcast(ids))
    assert hinted(bounded_broadcast(declare_bytes(spark.range(10), 80)))
    assert not hinted(bounded_broadcast(declare_bytes(spark.range(10), 1 << 40)))


def test_flagship_reads_pruned_columns_and_pushes_filters(spark):
    plan = _plan(catalog.monthly_metrics(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(discharge_date)" in plan
    assert "Bucketed: true" in plan


@pytest.mark.parametrize("key", ["monthly_metrics", "rolling_12m_spine", "numerator_patients", "exclusion_reasons", "denominator_inclusions", "monthly_metrics_versioned", "numerator_patients_versioned"])
def test_a_period_reads_its_years_only(spark, key):
    plan = _plan(catalog.QUERIES[key](spark, SF_SMALL))
    facts = [s for s in plan.splitlines() if "FileScan" in s and "discharge_year" in s]
    assert len(facts) >= 2 and all(re.search(r"PartitionFilters: \[\(isnull\(discharge_year", s) for s in facts), plan


def test_an_encounter_of_two_years_is_never_parted(spark):
    """Discharge rows of one encounter in two years: the ungroupable one of the
    other year still excludes it, with written facts and without."""
    from dataclasses import replace

    from pyspark.sql import functions as F

    from indicata.operators.indicator import Period
    from indicata.plans.warehouse import Warehouse

    w = catalog.warehouse(spark, SF_SMALL)
    months = w.monthly()
    counted = [r.patient_id for r in catalog.eligible(spark, SF_SMALL).select("patient_id").collect()]
    twin = w.raw.patient.filter(F.col("patient_id").isin([str(i) for i in counted])).withColumn("drg", F.lit("999")).withColumn("discharge_date", F.lit("1995-02-01"))
    raw = replace(w.raw, patient=w.raw.patient.unionByName(twin))
    assert counted and months.agg(F.sum("denominator")).first()[0] == len(counted)
    for written in (True, False):
        other = Warehouse(spark, raw, w.year, materialize_core=written)
        assert other.monthly(period=Period.year(w.year)).count() == 0
