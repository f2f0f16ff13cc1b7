"""Months of a period: rows of other months of the same years are skipped by column statistics."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from indicata.operators.indicator import ENCOUNTER_MONTH, YEAR_COL, IndicatorSpec, Period, of_period
from indicata.plans.warehouse import Warehouse, fixture_warehouse
from tests.conftest import SF_MEDIUM, SF_SMALL

ROLLING = Period.rolling(dt.date(1997, 6, 30))


def rows_read(df) -> int:
    """Rows that the scans of ``df`` hand on after skipping files, row groups and pages."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture(scope="module")
def w(spark):
    base = fixture_warehouse(spark, SF_MEDIUM)
    return Warehouse(spark, base.raw, base.year, buckets=1, page_rows=100)


@pytest.mark.parametrize("fact", ["fct_discharge_by_month", "fct_diagnosis_by_year", "fct_procedure_by_year"])
def test_twelve_months_over_two_years_read_at_most_fourteen(w, fact):
    table = getattr(w, fact)
    months = {(r[YEAR_COL], r[ENCOUNTER_MONTH]): r["count"] for r in table.groupBy(YEAR_COL, ENCOUNTER_MONTH).count().collect()}
    undated = sum(n for (_, m), n in months.items() if m is None)
    inside = {m: n for (_, m), n in months.items() if m and ROLLING.start <= m <= ROLLING.end}
    two_years = sum(n for (y, _), n in months.items() if y in (1996, 1997))
    assert len(inside) == 12
    read = rows_read(of_period(table, ROLLING).select("patient_id"))
    assert sum(inside.values()) <= read <= sum(inside.values()) * 14 / 12 + undated
    assert read < 0.65 * two_years


def test_an_encounter_of_two_months_is_never_parted(spark):
    """The ungroupable discharge row of another month of the same year still excludes its encounter."""
    from dataclasses import replace

    base = fixture_warehouse(spark, SF_SMALL)
    counted = base.eligible(IndicatorSpec(), Period.year(1997)).select("patient_id", F.col("year_month")).collect()
    one = counted[0]
    other_month = "1997-01-15" if not one.year_month.startswith("1997-01") else "1997-02-15"
    twin = base.raw.patient.filter(F.col("patient_id") == str(one.patient_id)).withColumn("drg", F.lit("999")).withColumn("discharge_date", F.lit(other_month))
    other = Warehouse(spark, replace(base.raw, patient=base.raw.patient.unionByName(twin)), 1997)
    spans = other.fct_diagnosis_by_year.filter(F.col("patient_id") == one.patient_id).select(YEAR_COL, ENCOUNTER_MONTH).distinct().collect()
    assert [tuple(r) for r in spans] == [(1997, None)]
    month = Period.months(one.year_month[:7], one.year_month[:7])
    left = {r.patient_id for r in other.eligible(IndicatorSpec(), month).collect()}
    assert left == {r.patient_id for r in counted if r.year_month == one.year_month} - {one.patient_id}
