"""Order-free fingerprints: equal multisets agree, planted differences are found."""

from pyspark.sql import functions as F

from indicata.operators import fingerprint as fp
from indicata.plans import catalog
from tests.conftest import SF_SMALL


def _same(a, b):
    return fp.same_tables("t", {"x": (a, b)}).first().passed


def test_order_and_partitions_do_not_matter_but_repeats_do(spark):
    rows = [(i % 50, f"x{i % 7}" if i % 3 else None) for i in range(500)]
    a = spark.createDataFrame(rows, "k long, v string")
    assert _same(a, spark.createDataFrame(rows[::-1], "k long, v string").repartition(7).select("v", "k"))
    assert not _same(a, a.limit(499))
    assert not _same(a, spark.createDataFrame(rows[1:] + [rows[2]], "k long, v string"))
    assert not _same(a.unionByName(a), a)


def test_nulls_have_places(spark):
    schema = "a string, b string"
    assert not _same(spark.createDataFrame([("x", None)], schema), spark.createDataFrame([(None, "x")], schema))
    assert not _same(spark.createDataFrame([(None, "x")], schema), spark.createDataFrame([("", "x")], schema))
    nested = "a array<struct<p:string,q:string>>"
    assert not _same(spark.createDataFrame([([("x", None)],)], nested), spark.createDataFrame([([(None, "x")],)], nested))
    assert _same(spark.createDataFrame([], schema), spark.createDataFrame([], schema))


def test_values_swapped_between_rows_are_found(spark):
    schema = "k long, v string"
    assert not _same(spark.createDataFrame([(1, "a"), (2, "b")], schema), spark.createDataFrame([(1, "b"), (2, "a")], schema))


def test_sums_of_large_hashes_do_not_overflow(spark):
    top = spark.range(100_000).select(F.lit("9223372036854775807").cast("decimal(20, 0)").alias("h"))
    assert str(top.agg(fp.total(F.col("h"))).first()[0]) == str(100_000 * 9223372036854775807)


def _violations(summary, w):
    return {r.subject: r.violations for r in fp.reconcile_contents(summary, w.fct_diagnosis, w.fct_procedure).collect()}


def test_planted_swap_of_codes_is_found(spark):
    """Two encounters trade a code: every size agrees, the contents do not."""
    w = catalog.warehouse(spark, SF_SMALL)
    summary = w.discharge_summary
    assert set(_violations(summary, w).values()) == {0}
    two = [r.patient_id for r in summary.filter("size(procedures) > 0 AND size(secondary_diagnoses) > 0").orderBy("patient_id").limit(2).collect()]
    here = F.col("patient_id").isin(two)
    swapped = summary.withColumn("procedures", F.when(here, F.transform("procedures", lambda e: e.withField("code", F.concat(e["code"], F.lit("x"))))).otherwise(F.col("procedures")))
    assert _violations(swapped, w) == {"principal_diagnosis": 0, "procedures": 2, "secondary_diagnoses": 0}
    flipped = summary.withColumn("secondary_diagnoses", F.when(here, F.transform("secondary_diagnoses", lambda e: e.withField("is_present_on_admission", 1 - e["is_present_on_admission"]))).otherwise(F.col("secondary_diagnoses")))
    assert _violations(flipped, w)["secondary_diagnoses"] >= 1
    first = summary.withColumn("principal_diagnosis", F.when(here, F.lit(None)).otherwise(F.col("principal_diagnosis")))
    assert _violations(first, w)["principal_diagnosis"] == summary.filter(here & F.col("principal_diagnosis").isNotNull()).count()


def test_the_comparison_moves_no_rows(spark, capsys):
    w = catalog.warehouse(spark, SF_SMALL)
    fp.reconcile_contents(w.discharge_summary, w.fct_diagnosis, w.fct_procedure).explain()
    assert "hashpartitioning(patient_id" not in capsys.readouterr().out
