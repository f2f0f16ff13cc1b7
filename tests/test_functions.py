"""Literal edge rows for the column functions (FIXTURES.md section 3)."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from indicata.functions import (
    adult_flag,
    age_at_admission,
    date_key,
    diag_type,
    elective_flag,
    present_flag,
    principal_flag,
    safe_date,
    safe_rate,
    strict_bigint,
    surrogate_key,
)
from indicata.operators.facts import unknown_fallback_key
from indicata.operators.reference import DATE_DIM_END, DATE_DIM_START


def test_safe_date_is_strict(spark):
    rows = ["2025-13-01", "2025-1-5", " 2025-01-05", "2025-01-05 10:00", "", None, "2025-01-05"]
    df = spark.createDataFrame([(r,) for r in rows], "x string")
    got = [r[0] for r in df.select(safe_date(F.col("x"))).collect()]
    assert got == [None] * 6 + [dt.date(2025, 1, 5)]


def test_age_and_adult_flag_disagree_as_in_source(spark):
    df = spark.createDataFrame(
        [(dt.date(2007, 12, 31), dt.date(2025, 1, 1)), (dt.date(2004, 2, 29), dt.date(2022, 2, 28)), (None, dt.date(2022, 1, 1))],
        "b date, a date",
    )
    got = df.select(
        age_at_admission(F.col("b"), F.col("a")).alias("age"),
        adult_flag(F.col("b"), F.col("a")).alias("adult"),
        adult_flag(F.col("b"), F.col("a"), strict_age=True).alias("strict"),
    ).collect()
    assert [tuple(r) for r in got] == [(17, 1, 0), (17, 1, 0), (None, 0, 0)]


def test_date_keys(spark):
    df = spark.createDataFrame(
        [(None,), (dt.date(1849, 12, 31),), (dt.date(1800, 1, 1),), (dt.date(1900, 1, 1),), (dt.date(2030, 12, 31),)],
        "d date",
    )
    got = [r[0] for r in df.select(date_key(F.coalesce("d", F.lit(dt.date(1900, 1, 1))), DATE_DIM_START, DATE_DIM_END)).collect()]
    assert got == [19000101, -1, -1, 19000101, 20301231]


def test_rank_and_present_flags(spark):
    df = spark.createDataFrame([(None, "Y"), (0, "y"), (1, "N"), (2, None)], "r bigint, p string")
    got = df.select(diag_type(F.col("r")), principal_flag(F.col("r")), present_flag(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("UNKNOWN", 0, 1), ("UNKNOWN", 0, 0), ("Principal", 1, 0), ("Secondary", 0, 0)]


def test_elective_is_case_insensitive(spark):
    df = spark.createDataFrame([("Elective",), ("ELECTIVE",), ("Urgent",), (None,)], "t string")
    assert [r[0] for r in df.select(elective_flag(F.col("t"))).collect()] == [1, 1, 0, 0]


def test_unknown_keys_differ_between_fallback_and_member(spark):
    df = spark.range(1).select(
        unknown_fallback_key("DRG", 2025).alias("fallback"),
        unknown_fallback_key("DRG", 2025, resolve_unknown=True).alias("member"),
        surrogate_key(F.lit(None).cast("string"), "x").alias("null_part"),
    )
    r = df.first()
    assert r.fallback == hashlib.sha256(b"DRG|UNKNOWN|2025").hexdigest()
    assert r.fallback.startswith("eaa1e566")
    assert r.member == hashlib.sha256(b"UNKNOWN|DRG|2025").hexdigest()
    assert r.member.startswith("45868a53")
    assert r.null_part is None  # concat semantics: a NULL part nulls the key


def test_strict_bigint_fails_on_bad_text(spark):
    import pytest

    ok = spark.createDataFrame([("12",), (None,)], "x string").select(strict_bigint(F.col("x"))).collect()
    assert [r[0] for r in ok] == [12, None]
    with pytest.raises(Exception):
        spark.createDataFrame([("12a",)], "x string").select(strict_bigint(F.col("x"))).collect()


def test_published_rates(spark):
    # The 12 published (numerator, denominator, rate) rows.
    published = [
        (0, 70, 0.0), (1, 86, 0.012), (2, 88, 0.023), (1, 69, 0.014), (0, 98, 0.0), (0, 91, 0.0),
        (1, 88, 0.011), (0, 82, 0.0), (0, 74, 0.0), (0, 92, 0.0), (1, 81, 0.012), (0, 72, 0.0),
    ]
    df = spark.createDataFrame([(n, d) for n, d, _ in published] + [(0, 0)], "n bigint, d bigint")
    got = [r[0] for r in df.select(safe_rate(F.col("n"), F.col("d"))).collect()]
    assert got == [r for _, _, r in published] + [None]
    assert sum(n for n, _, _ in published) == 6 and sum(d for _, d, _ in published) == 991
