"""Nightly run: rerun safety (Q13) and audit retention across nights."""

import datetime as dt

import pytest

from indicata.operators.indicator import Period
from indicata.plans import catalog
from indicata.plans.nightly import nightly_run, run_name
from indicata.sources.sinks import fresh_path
from tests.conftest import SF_MEDIUM, SF_SMALL

MAY, JUNE = dt.date(1997, 5, 31), dt.date(1997, 6, 30)


def _name(run_date, period=None):
    return run_name(catalog.SPEC, run_date, period or Period.rolling(run_date))


def test_rerun_replaces_only_its_own_night(spark):
    w = catalog.warehouse(spark, SF_SMALL)
    out = fresh_path(spark, "nightly-test")
    first = nightly_run(w, MAY, out)
    n_first = first.numerator_patients.count()
    published_first = sorted(map(tuple, first.metrics.collect()))
    second = nightly_run(w, JUNE, out)
    m = sorted(map(tuple, second.metrics.collect()))
    n_second = second.numerator_patients.filter(f"run_id = '{_name(JUNE)}'").count()
    again = nightly_run(w, JUNE, out)
    assert sorted(map(tuple, again.metrics.collect())) == m
    assert len(m) == 12 and [r[0] for r in m][0] == "1996-07"
    assert again.run_log.count() == 2
    per_run = {r.run_id: r.n for r in again.numerator_patients.groupBy("run_id").count().withColumnRenamed("count", "n").collect()}
    assert per_run.get(_name(MAY), 0) == n_first
    assert sum(per_run.values()) == n_first + n_second
    # An older night run again publishes its own rows, none of a newer night.
    older = nightly_run(w, MAY, out)
    assert sorted(map(tuple, older.metrics.collect())) == published_first
    # The current table stays the newer night's.
    assert sorted(map(tuple, older.current.collect())) == m


def test_a_backfill_on_a_nights_date_keeps_the_night(spark):
    w = catalog.warehouse(spark, SF_MEDIUM)
    out = fresh_path(spark, "nightly-backfill-test")
    night = nightly_run(w, JUNE, out)
    n_night, n_checks = night.numerator_patients.count(), night.checks.count()
    assert n_night > 0
    quarter = Period.months("1996-01", "1996-03")
    both = nightly_run(w, JUNE, out, period=quarter)
    per_run = {r["run_id"]: r["count"] for r in both.numerator_patients.groupBy("run_id").count().collect()}
    assert per_run[_name(JUNE)] == n_night
    assert both.run_log.count() == 2 and both.checks.count() == 2 * n_checks
    assert len(both.metrics.collect()) == 3


def test_unreadable_history_fails_the_run(spark):
    w = catalog.warehouse(spark, SF_SMALL)
    out = fresh_path(spark, "nightly-broken")
    nightly_run(w, MAY, out)
    path = f"{out}/metrics_snapshots/run_id={_name(MAY)}"
    import glob

    files = glob.glob(path.removeprefix("file:") + "/*.parquet")
    assert files
    for f in files:
        with open(f, "wb") as h:
            h.write(b"broken")
    with pytest.raises(Exception):
        nightly_run(w, JUNE, out)


@pytest.mark.parametrize("versioned", [True, False])
def test_an_extract_gives_what_rebuilt_facts_give(spark, versioned):
    """Merging the corrections as the facts are read equals a warehouse of corrected raw tables."""
    from dataclasses import replace

    from pyspark.sql import functions as F

    from indicata.operators import incremental as inc
    from indicata.plans.warehouse import Warehouse

    w = catalog.warehouse(spark, SF_MEDIUM)
    reference = catalog._reference(spark, SF_MEDIUM) if versioned else None
    extract = catalog.staged_extract(spark, SF_MEDIUM)
    # Corrections that keep the DRG, so that the changed lines decide, and move some discharges to another year.
    moved = F.when(F.col("patient_id").cast("long") % 3 == 0, "1996-12-30").otherwise(F.col("discharge_date"))
    patient = extract.patient.drop("drg").join(w.raw.patient.select("patient_id", "drg"), "patient_id").withColumn("discharge_date", moved)
    extract = replace(extract, patient=patient.select("patient_id", "drg", "birth_date", "admission_date", "discharge_date", "admission_type", "updated_at"))
    built = dt.date(1996, 12, 1)
    merged = nightly_run(w, JUNE, fresh_path(spark, "nightly-merged"), reference=reference, staged=extract, built_on=built)

    changed = inc.lookback_extract(extract.patient, built).drop("updated_at")
    raw = replace(
        w.raw,
        patient=inc.replace_children(w.raw.patient, changed, changed),
        diagnosis=inc.replace_children(w.raw.diagnosis, extract.diagnosis, changed),
        procedure=inc.replace_children(w.raw.procedure, extract.procedure, changed),
    )
    rebuilt = nightly_run(Warehouse(spark, raw, w.year), JUNE, fresh_path(spark, "nightly-rebuilt"), reference=reference)
    assert sorted(map(tuple, merged.metrics.collect())) == sorted(map(tuple, rebuilt.metrics.collect()))
    assert sorted(map(tuple, merged.numerator_patients.collect())) == sorted(map(tuple, rebuilt.numerator_patients.collect()))
    plain = nightly_run(w, JUNE, fresh_path(spark, "nightly-plain"), reference=reference)
    assert sorted(map(tuple, merged.metrics.collect())) != sorted(map(tuple, plain.metrics.collect()))


def test_of_two_runs_on_one_date_the_later_one_is_current(spark):
    """A backfill of overlapping months on the night's date lowers counts: its rows are the current ones."""
    w, reference = catalog.warehouse(spark, SF_MEDIUM), catalog._reference(spark, SF_MEDIUM)
    out = fresh_path(spark, "nightly-same-day")
    night = {r.year_month: r for r in nightly_run(w, JUNE, out, reference=reference).current.collect()}
    months = Period.months("1997-03", "1997-06")
    extract = catalog.staged_extract(spark, SF_MEDIUM)
    fill = nightly_run(w, JUNE, out, reference=reference, period=months, staged=extract, built_on=dt.date(1997, 1, 1))
    filled = {r.year_month: r for r in fill.metrics.collect()}
    current = {r.year_month: r for r in fill.current.collect()}
    assert len(filled) == 4 and any(filled[m].denominator < night[m].denominator for m in filled)
    assert current == {**night, **filled}
    # The night again: it is still the earlier run of the two.
    again = nightly_run(w, JUNE, out, reference=reference)
    assert {r.year_month: r for r in again.metrics.collect()} == night
    assert {r.year_month: r for r in again.current.collect()} == {**night, **filled}


def test_stale_reference_is_reported_and_does_not_fail_the_run(spark):
    from dataclasses import replace

    from indicata.operators.intervals import RangeTable

    w, reference = catalog.warehouse(spark, SF_SMALL), catalog._reference(spark, SF_SMALL)
    old = replace(reference, versions=RangeTable((dt.date(1995, 1, 1),), ("1995-01-01",)))
    status = {}
    for name, ref in (("fresh", reference), ("old", old), ("none", None)):
        run = nightly_run(w, JUNE, fresh_path(spark, f"nightly-{name}"), reference=ref)
        check = run.checks.filter("check = 'reference_freshness'").first()
        others = run.checks.filter("check <> 'reference_freshness' AND NOT passed").count()
        log = run.run_log.first()
        status[name] = check.passed
        assert log.dq_status == ("FAILED" if others else "PASSED")
        assert log.started_at < log.ended_at
    assert status == {"fresh": True, "old": False, "none": True}


def test_corrections_need_the_day_of_the_stored_facts(spark):
    w = catalog.warehouse(spark, SF_SMALL)
    with pytest.raises(ValueError):
        nightly_run(w, JUNE, fresh_path(spark, "nightly-undated"), staged=catalog.staged_extract(spark, SF_SMALL))


def test_the_log_reads_no_table(spark):
    """Its totals are those of the published rows, taken while they were written."""
    run = nightly_run(catalog.warehouse(spark, SF_MEDIUM), JUNE, fresh_path(spark, "nightly-log"))
    log, rows = run.run_log.first(), run.metrics.collect()
    assert (log.numerator, log.denominator, log.months) == (sum(r.numerator for r in rows), sum(r.denominator for r in rows), sum(r.denominator > 0 for r in rows))
