"""Corrections written into the stored facts: touched years only, same rows as merging, still co-located."""

import datetime as dt
import glob
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from indicata.plans import catalog
from indicata.plans.nightly import StagedExtract, compact_corrections, corrected_facts
from indicata.plans.warehouse import Warehouse
from indicata.sources.fixtures import hot_inputs, raw_inputs
from tests.conftest import SF_SMALL

BUILT, NOW = dt.date(1997, 5, 31), dt.date(1997, 6, 30)
FACTS = {"fct_discharge": "fct_discharge_by_month", "fct_diagnosis": "fct_diagnosis_by_year", "fct_procedure": "fct_procedure_by_year"}


def _rows(df, *leave_out):
    return sorted((tuple(r) for r in df.drop("discharge_year", *leave_out).collect()), key=repr)


def _files(spark, table):
    root = {os.path.dirname(f.removeprefix("file:")) for f in spark.table(table).inputFiles()}
    return {f: os.stat(f).st_mtime_ns for d in root for f in glob.glob(d + "/*.parquet")}


def _extract(w, patient):
    return StagedExtract(patient.withColumn("updated_at", F.lit("1997-06-15").cast("timestamp")), w.raw.diagnosis.filter("diag_rank_num <= 2"), w.raw.procedure.filter("procedure_code <> 'P003'"))


@pytest.mark.parametrize("hot", [False, True])
def test_same_rows_as_merging_and_untouched_years_keep_their_files(spark, hot):
    raw = hot_inputs(spark, SF_SMALL) if hot else raw_inputs(spark, SF_SMALL)
    w = Warehouse(spark, raw, 1997, least_hot_rows=200, built_on=BUILT)
    one = raw.patient.filter("discharge_date LIKE '1996-%'" + (" OR patient_id = '4'" if hot else "")).dropDuplicates(["patient_id"])
    moved = one.filter("patient_id % 5 < 2 OR patient_id = '4'").withColumn("discharge_date", F.when(F.col("patient_id") % 2 == 0, "1997-02-03").otherwise(F.col("discharge_date")))
    extract = _extract(w, moved)
    merged = [_rows(t) for t in corrected_facts(w, extract)]
    before = {n: _files(spark, w._tables[n]) for n in FACTS}
    monthly = w.monthly().collect()

    touched = compact_corrections(w, extract, NOW)
    assert w.built_on == NOW and {1996, 1997} <= set(touched)
    assert [_rows(getattr(w, f)) for f in FACTS.values()] == merged
    after = {n: _files(spark, w._tables[n]) for n in FACTS}
    for n in FACTS:
        kept = {f for f in before[n] if not any(f"discharge_year={'__HIVE_DEFAULT_PARTITION__' if y is None else y}/" in f for y in touched)}
        assert kept and all(after[n].get(f) == before[n][f] for f in kept)
        assert not (set(before[n]) - kept) & set(after[n])
    assert w.monthly().collect() != monthly or hot
    # Compacting once more changes nothing.
    compact_corrections(w, extract, NOW, built_on=BUILT)
    assert [_rows(getattr(w, f)) for f in FACTS.values()] == merged


def test_facts_stay_colocated(spark, capsys):
    w = Warehouse(spark, raw_inputs(spark, SF_SMALL), 1997, built_on=BUILT)
    w.monthly().collect()
    compact_corrections(w, _extract(w, w.raw.patient.filter("patient_id % 50 = 7")), NOW)
    w.monthly().explain()
    plan = capsys.readouterr().out
    assert "Exchange hashpartitioning(patient_id" not in plan and "Bucketed: true" in plan


def test_years_that_empty_are_dropped(spark):
    """All encounters of one year, and those without a year, move to another."""
    raw = raw_inputs(spark, SF_SMALL)
    undated = raw.patient.filter("patient_id % 40 = 1").withColumn("discharge_date", F.lit("unknown"))
    raw = replace(raw, patient=undated.unionByName(raw.patient.filter("patient_id % 40 <> 1")))
    w = Warehouse(spark, raw, 1997, built_on=BUILT)
    assert not w.fct_discharge_by_month.filter("discharge_year IS NULL").isEmpty()
    moved = raw.patient.filter("discharge_date LIKE '1996-%' OR discharge_date = 'unknown'").withColumn("discharge_date", F.lit("1998-01-01"))
    touched = compact_corrections(w, _extract(w, moved), NOW)
    assert touched == [None, 1996, 1998]
    years = {r.discharge_year for r in w.fct_diagnosis_by_year.select("discharge_year").distinct().collect()}
    assert not years & {None, 1996} and 1998 in years
    assert w.fct_discharge.count() == raw.patient.count()
