
from pyspark.sql import functions as F

from indicata.operators import incremental as inc
from indicata.operators import indicator as ind
from indicata.plans import catalog
from indicata.sources import fixtures as fx

from tests.conftest import SF_MEDIUM, SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_medium_fixture_anchors(spark):
    """Monthly results at sf0.01 (FIXTURES.md expected anchors)."""
    m = {r.month: (r.numerator, r.denominator, r.rate) for r in catalog.monthly_metrics(spark, SF_MEDIUM).collect()}
    assert len(m) == 12
    assert sum(v[0] for v in m.values()) == 29 and sum(v[1] for v in m.values()) == 151
    assert m["1997-02"] == (5, 18, 0.278) and m["1997-09"] == (1, 14, 0.071)


def test_rerun_and_partitioning_do_not_change_results(spark):
    a = _rows(catalog.monthly_metrics(spark, SF_SMALL))
    catalog._WAREHOUSES.clear()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = _rows(catalog.monthly_metrics(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


def test_numerator_is_subset_of_eligible(spark):
    el = catalog.eligible(spark, SF_MEDIUM)
    num = catalog.numerator_patients(spark, SF_MEDIUM).select("patient_id", "year_month")
    assert num.join(el, ["patient_id", "year_month"], "left_anti").count() == 0
    assert num.count() == 29


def test_upsert_is_idempotent(spark):
    current = fx.staged_patient(spark, SF_SMALL, versions=(1,))
    changes = inc.lookback_extract(fx.staged_patient(spark, SF_SMALL), fx.FIXTURE_RUN_DATE)
    once = inc.upsert_latest(current, changes, ["patient_id"], "updated_at")
    twice = inc.upsert_latest(once, changes, ["patient_id"], "updated_at")
    assert _rows(once) == _rows(twice)
    assert once.count() == current.count()


def test_identical_runs_diff_to_kept_only(spark):
    a = catalog.numerator_patients(spark, SF_MEDIUM)
    d = inc.numerator_diff(a, a)
    assert {r.change for r in d.collect()} == {"kept"}


def test_removed_numerator_members_are_newly_excluded(spark):
    """Widening the sepsis list also widens the exclusions (it is one of the
    excluding identifiers), so a member can only leave the numerator by
    becoming excluded under the wider list."""
    diff = catalog.numerator_diff(spark, SF_MEDIUM)
    assert {r.change for r in diff.collect()} <= {"added", "removed", "kept"}
    w = catalog.warehouse(spark, SF_MEDIUM, 14)
    excl_b = ind.exclusions(w.fct_discharge, w.fct_diagnosis, w.flags(catalog.SPEC), catalog.SPEC)
    removed = diff.filter(F.col("change") == "removed").select("patient_id")
    assert removed.join(excl_b, "patient_id", "left_anti").count() == 0


def test_month_spine_fills_empty_months(spark):
    rows = catalog.rolling_12m_spine(spark, SF_SMALL).collect()
    assert [r.month for r in rows] == [f"{y}-{m:02d}" for y, m in [(1996, m) for m in range(7, 13)] + [(1997, m) for m in range(1, 7)]]
    assert all((r.rate is None) == (r.denominator == 0) for r in rows)


def test_period_helpers():
    import datetime as dt

    p = ind.Period.rolling(dt.date(1997, 6, 30))
    assert (p.start, p.end) == (dt.date(1996, 7, 1), dt.date(1997, 6, 30))
    q = ind.Period.months("1996-11", "1997-02")
    assert (q.start, q.end) == (dt.date(1996, 11, 1), dt.date(1997, 2, 28))


def test_summary_arrays_never_null(spark):
    s = catalog._summary(catalog.warehouse(spark, SF_SMALL))
    bad = s.filter(F.col("secondary_diagnoses").isNull() | F.col("procedures").isNull() | F.col("drg_identifiers").isNull())
    assert bad.count() == 0


def test_prefilter_does_not_change_eligibility(spark):
    w = catalog.warehouse(spark, SF_MEDIUM)
    d, dx, pr, fl = w.fct_discharge_by_month, w.fct_diagnosis_by_year, w.fct_procedure_by_year, w.flags(catalog.SPEC)
    p = ind.Period.year(1997)
    a = _rows(ind.eligible(d, dx, pr, fl, catalog.SPEC, p, prefilter=True))
    b = _rows(ind.eligible(d, dx, pr, fl, catalog.SPEC, p, prefilter=False))
    assert a == b and len(a) == 151


def test_lazy_core_layer_gives_the_same_indicator(spark):
    from indicata.plans.warehouse import fixture_warehouse

    lazy = fixture_warehouse(spark, SF_SMALL)
    lazy.materialize_core = False
    assert lazy.prefilter
    assert _rows(lazy.monthly()) == _rows(catalog.monthly_metrics(spark, SF_SMALL))


def test_sql_views_answer_like_the_dataframes(spark):
    from indicata.plans.views import register_views

    w = catalog.warehouse(spark, SF_SMALL)
    names = register_views(w, prefix="t_")
    assert "t_fct_discharge" in names and "t_psi13_monthly_metrics" in names
    via_sql = spark.sql(
        "SELECT month, numerator, denominator FROM t_psi13_monthly_metrics ORDER BY month"
    ).collect()
    assert [tuple(r) for r in via_sql] == [(r.month, r.numerator, r.denominator) for r in catalog.monthly_metrics(spark, SF_SMALL).collect()]
    n = spark.sql(
        "SELECT count(*) FROM t_fct_diagnosis d JOIN t_fct_discharge f ON d.patient_id = f.patient_id"
    ).first()[0]
    assert n == w.fct_diagnosis.count()


def test_the_parse_check_counts_what_the_loader_makes_null(spark):
    from indicata.functions import safe_date
    from indicata.operators import quality as dq

    texts = ["1997", "1997-01-05 10:00", "1997-1-5", "1997-13-45", " 1997-01-05", "", "1997-01-05", None]
    df = spark.createDataFrame([(t,) for t in texts], "day string")
    nulled = df.filter(F.col("day").isNotNull() & safe_date(F.col("day")).isNull()).count()
    check = dq.parses({"raw": (df, {"day": "date"})}).first()
    assert check.violations == nulled == 6


def test_key_checks_scan_each_child_once_and_count_nulls(spark, capsys):
    from indicata.operators import quality as dq

    child = spark.createDataFrame([(1, 5), (1, None), (9, 6), (None, 7)], "a long, b long")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    got = dq.fk_orphans({"a": (child, "a", parent, "k", True), "b": (child, "b", parent.filter("k = 0"), "k", False)})
    assert {r.subject: r.violations for r in got.collect()} == {"a": 2, "b": 4}
    catalog.dq_fk_orphans(spark, SF_SMALL).explain()
    plan = capsys.readouterr().out
    assert sum("FileScan" in line and "drg_code_sk" in line for line in plan.splitlines()) == 1
    assert sum("FileScan" in line and "diag_code_sk" in line for line in plan.splitlines()) == 1
