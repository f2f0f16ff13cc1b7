"""Effective ranges: binary search against plain search, overlaps, gaps, open ends."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from indicata.operators import incremental as inc
from indicata.operators.intervals import RangeTable, lookup_intervals, overlaps, resolved, search
from indicata.plans import catalog
from tests.conftest import SF_SMALL

DAY0 = dt.date(2000, 1, 1)
SCHEMA = "k string, effective_start_date date, effective_end_date date, name string"


def day(n):
    return DAY0 + dt.timedelta(days=n)


def held(ranges, d):
    on = [(s, v) for s, e, v in ranges if d is not None and s is not None and s <= d and (e is None or d <= e)]
    return max(on)[1] if on else None


def some_ranges(r, n):
    out = []
    for i in range(n):
        s = r.randrange(300)
        out.append((day(s), None if r.random() < 0.1 else day(s + r.randrange(-2, 60)), f"v{i}"))
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 31, 40])
def test_search(spark, n):
    starts = [day(3 * i) for i in range(n)]
    df = spark.createDataFrame([(day(i),) for i in range(-2, 3 * n + 3)] + [(None,)], "d date")
    got = df.select("d", search(F.array(*[F.lit(s) for s in starts]).cast("array<date>"), F.col("d"), max(n, 1)).alias("at")).collect()
    assert [r.at for r in got] == [sum(s <= r.d for s in starts) - 1 if r.d else -1 for r in got]


@pytest.mark.parametrize("seed", range(3))
def test_overlapping_versions_with_gaps(spark, seed):
    ranges = some_ranges(random.Random(seed), 25)
    df = spark.createDataFrame([(s, e, v) for s, e, v in ranges], "effective_start_date date, effective_end_date date, ref_version string")
    table = RangeTable.of(df)
    days = [day(i) for i in range(-3, 380)]
    want = [held(ranges, d) for d in days]
    assert [table.on(d) for d in days] == want and None in want
    rows = spark.createDataFrame([(d,) for d in days], "d date").coalesce(1)
    assert [r.ref_version for r in inc.with_version(rows, "d", table).collect()] == want


def test_ranges_per_key(spark):
    r = random.Random(9)
    ranges = {k: some_ranges(r, n) for k, n in (("a", 1), ("b", 12), ("c", 30))}
    rows = [(k, *x) for k, v in ranges.items() for x in v + v[:1]] + [("d", None, day(3), "no start"), ("e", day(5), day(4), "empty")]
    arrays = resolved(spark.createDataFrame(rows, SCHEMA), ["k"], "name")
    asked = [(i, k, day(r.randrange(-5, 380)) if i % 9 else None) for i, k in enumerate("abcdef" * 60)]
    got = lookup_intervals(spark.createDataFrame(asked, "i int, k string, d date"), "d", ["k"], arrays, "name").collect()
    assert {x.i: x.name for x in got} == {i: held(ranges.get(k, []), d) for i, k, d in asked}
    assert len(got) == len(asked)


def test_overlaps_are_detected(spark):
    rows = [("a", day(0), day(9), "1"), ("a", day(10), day(19), "2"), ("b", day(0), day(50), "1"), ("b", day(5), day(6), "2"), ("b", day(40), None, "3"), ("c", day(1), None, "1"), ("c", day(9), day(9), "2")]
    got = overlaps(spark.createDataFrame(rows, SCHEMA), ["k"]).first()
    assert (got.violations, got.passed) == (3, False)
    assert overlaps(spark.createDataFrame(rows[:2], SCHEMA), ["k"]).first().passed


def test_versions_are_bounded(spark):
    df = spark.range(5).selectExpr("date_add(DATE '2000-01-01', int(id)) AS effective_start_date", "NULL::date AS effective_end_date", "string(id) AS ref_version")
    assert RangeTable.of(df, most=5).on(day(9)) == "4"
    with pytest.raises(ValueError):
        RangeTable.of(df, most=4)


def test_no_versions(spark):
    empty = RangeTable.of(spark.createDataFrame([], "ref_version string, effective_start_date date, effective_end_date date"))
    assert empty.on(DAY0) is None
    assert inc.with_version(spark.createDataFrame([(DAY0,)], "d date"), "d", empty).first().ref_version is None


def test_the_lookup_of_versions_needs_no_join_and_facts_do_not_move(spark, capsys):
    catalog.fct_diagnosis_versioned(spark, SF_SMALL).explain()
    assert "Exchange hashpartitioning(patient_id" not in capsys.readouterr().out
    rows = spark.createDataFrame([(DAY0,)], "d date")
    inc.with_version(rows, "d", RangeTable((DAY0,), ("v",))).explain()
    assert "Join" not in capsys.readouterr().out


def test_keys_follow_the_discharge_across_january(spark):
    """Lines of one code before and after a change of version get the keys of their own versions."""
    rows = catalog.fct_diagnosis_versioned(spark, SF_SMALL).filter("diag_code = 'D005'").select("diag_code_sk", "ref_version").distinct().collect()
    assert len(rows) > 2 and len({r.diag_code_sk for r in rows}) == len({r.ref_version for r in rows})
