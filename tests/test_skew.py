"""Hot encounters: found exactly, kept out of the buckets, and without effect on any result."""

from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from indicata.operators import indicator as ind
from indicata.operators import skew
from indicata.operators.summary import flatten_summary
from indicata.plans import catalog
from indicata.plans.warehouse import Warehouse
from indicata.sources.fixtures import hot_inputs, raw_inputs
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_hot_keys_are_exact(spark):
    ids = [7] * 500 + [None] * 300 + [k for k in range(100) for _ in range(k)] + [8] * 130
    counts = Counter(ids)
    table = spark.createDataFrame([(i,) for i in ids], "patient_id long").repartition(5)
    other = spark.range(400).selectExpr("id AS patient_id").unionByName(spark.range(300).selectExpr("-5L AS patient_id"))
    for shares, least in ((20, 10), (60, 10), (60, 400), (2_000, 0)):
        limit = max(least, len(ids) // shares)
        want = {k for k, n in counts.items() if n > limit} | ({-5} if 300 > max(least, 700 // shares) else set())
        want |= {k for k in range(400) if 1 > max(least, 700 // shares)}
        got = skew.hot_keys({"a": table, "b": other}, "patient_id", shares, least)
        assert {r.patient_id for r in got.collect()} == want if want else got is None


def test_split_treats_null_as_a_key(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (None, "d")], "patient_id long, v string")
    cold, hot = skew.split(rows, spark.createDataFrame([(None,), (2,)], "patient_id long"), "patient_id")
    assert _rows(cold) == [(1, "a")] and sorted(r.v for r in hot.collect()) == ["b", "c", "d"]


def test_salted_arrays_equal_plain_ones(spark):
    rows = spark.range(3_000).selectExpr("id % 2 AS k", "id % 7 AS v", "IF(id % 5 = 0, NULL, 'x' || id % 50) AS w").repartition(6)
    arrays, least = {"a": F.struct("v", "w"), "b": F.col("w")}, {"m": F.struct("w", "v")}
    plain = rows.groupBy("k").agg(*[F.sort_array(F.collect_list(c)).alias(n) for n, c in arrays.items()], F.min(least["m"]).alias("m"))
    assert _rows(skew.salted_arrays(rows, "k", arrays, least, skew.salt("v", salts=9))) == _rows(plain)


def test_collapsed_lines_keep_the_lowest_rank(spark):
    lines = [(1, "a", 3, "Secondary", 0), (1, "a", 2, "Secondary", 0), (1, "a", 1, "Principal", 1), (1, "b", None, "UNKNOWN", 0), (1, "b", 0, "UNKNOWN", 0), (2, "a", 2, "Secondary", 0)]
    df = spark.createDataFrame(lines, "patient_id long, diag_code string, diag_rank_num long, diag_type string, is_principal_diag long")
    assert _rows(skew.collapse_diagnoses(df)) == sorted([lines[1], lines[2], lines[3], lines[5]], key=repr)


@pytest.fixture(scope="module")
def counted(spark):
    """An encounter of the cohort, so that its rows matter."""
    return str(min(r.patient_id for r in catalog.eligible(spark, SF_SMALL).collect()))


@pytest.mark.parametrize("fact", ["diagnosis", "procedure", "patient"])
def test_a_hot_encounter_in_each_fact(spark, counted, fact):
    raw = raw_inputs(spark, SF_SMALL)
    many = spark.range(4_000)
    more = {
        "diagnosis": many.selectExpr(f"'{counted}' AS patient_id", "concat('D', lpad(int(40 + id % 50), 3, '0')) AS diag_code", "2 + id % 9 AS diag_rank_num", "'N' AS present_on_admission_ind"),
        "procedure": many.selectExpr(f"'{counted}' AS patient_id", "concat('P', lpad(int(id % 10), 3, '0')) AS procedure_code"),
        "patient": many.join(raw.patient.filter(F.col("patient_id") == counted)).drop("id"),
    }[fact]
    hot_raw = replace(raw, **{fact: getattr(raw, fact).unionByName(more)})
    hot = Warehouse(spark, hot_raw, 1997)
    assert [r.patient_id for r in hot.hot_encounters.collect()] == [int(counted)]
    assert len(hot.parts) == 2
    bucketed = [getattr(hot.parts[0], n) for n in ("discharge", "diagnosis", "procedure")]
    assert all(t.filter(F.col("patient_id") == int(counted)).isEmpty() for t in bucketed)
    assert hot.parts[1].diagnosis.count() < 300

    lazy = Warehouse(spark, hot_raw, 1997, materialize_core=False)
    assert _rows(hot.monthly()) == _rows(lazy.monthly())
    assert _rows(catalog._exclusion_reasons(hot)) == _rows(catalog._exclusion_reasons(lazy))
    assert _rows(catalog._numerator_patients(hot, "r")) == _rows(catalog._numerator_patients(lazy, "r"))
    assert hot.fct_diagnosis.count() == hot_raw.diagnosis.count() and hot.fct_discharge.count() == hot_raw.patient.count()
    if fact != "patient":
        assert _rows(flatten_summary(hot.discharge_summary)) == _rows(flatten_summary(lazy.discharge_summary))
    counts = {r.month: r.denominator for r in catalog.monthly_metrics(spark, SF_SMALL).collect()}
    if fact == "procedure":  # more operating-room procedures change nothing
        assert counts == {r.month: r.denominator for r in hot.monthly().collect()}


def test_the_bucketed_part_stays_colocated_beside_hot_encounters(spark):
    import contextlib
    import io

    w = Warehouse(spark, hot_inputs(spark, SF_SMALL), 1997, least_hot_rows=200)
    assert {r.patient_id for r in w.hot_encounters.collect()} == {3, 4, 5}
    cold = w.parts[0]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        ind.eligible(cold.discharge, cold.diagnosis, cold.procedure, w.flags(catalog.SPEC), catalog.SPEC, ind.Period.year(1997), w.prefilter).explain()
    assert "Exchange hashpartitioning(patient_id" not in buf.getvalue()
    sizes = [r["count"] for r in cold.diagnosis.groupBy(F.pmod(F.hash("patient_id"), F.lit(w.fact_buckets))).count().collect()]
    assert max(sizes) < 2 * sum(sizes) / len(sizes)
