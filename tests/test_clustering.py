"""Clustering by several columns: all rows kept, files skipped for a filter on any column."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from indicata.sources import sinks


def ranges(path, column):
    """(least, greatest) of ``column`` in every file."""
    import glob

    out = []
    for f in glob.glob(f"{path}/*.parquet"):
        m = pq.ParquetFile(f).metadata
        at = m.schema.names.index(column)
        stats = [m.row_group(i).column(at).statistics for i in range(m.num_row_groups)]
        out.append((min(x.min for x in stats), max(x.max for x in stats)))
    return out


def files_read(path, column, value):
    return sum(a <= value <= b for a, b in ranges(path, column))


@pytest.fixture(scope="module")
def codes(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("codes") / "t")
    n = F.col("id")
    spark.range(0, 40_000, 1, 4).select(
        F.format_string("C%05d", F.pmod(F.xxhash64(n, F.lit(1)), F.lit(3_000))).alias("code"),
        F.format_string("ID_%03d", F.pmod(F.xxhash64(n, F.lit(2)), F.lit(400))).alias("identifier"),
        n.alias("number"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_a_filter_on_either_column_skips_files(codes, tmp_path):
    one, both = str(tmp_path / "sorted"), str(tmp_path / "clustered")
    codes.repartitionByRange(16, "code", "identifier").sortWithinPartitions("code", "identifier").write.parquet(one)
    sinks.write_clustered(codes, both, ("code", "identifier"), num_partitions=16)
    assert len(ranges(both, "code")) >= 12
    for column, values in (("code", ["C00010", "C01500", "C02900"]), ("identifier", ["ID_005", "ID_200", "ID_390"])):
        for v in values:
            assert files_read(both, column, v) <= 8  # a grid of 4 x 4 files, and neighbours
    assert files_read(one, "identifier", "ID_200") == 16  # a plain sort serves its first column only


def test_all_rows_are_kept(codes, spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_clustered(codes, path, ("code", "identifier"))
    back = spark.read.schema(codes.schema).parquet(path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, codes.collect()))


def test_nulls_hot_values_repeats_and_empty_tables(spark, tmp_path):
    rows = [("a", None, i % 3) for i in range(3_000)] + [(None, "x", 1), (None, None, 2), (None, None, 2), ("b", "y", 3)]
    df = spark.createDataFrame(rows, "a string, b string, n int")
    path = str(tmp_path / "t")
    sinks.write_clustered(df, path, ("a", "b"), num_partitions=8)
    back = spark.read.schema(df.schema).parquet(path)
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, rows))
    sinks.write_clustered(df.filter("n > 9"), str(tmp_path / "e"), ("a", "b"))
    assert spark.read.schema(df.schema).parquet(str(tmp_path / "e")).collect() == []


def test_the_key_interleaves_bits(spark):
    df = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int")
    got = {(r.a, r.b): r.z for r in df.select("a", "b", sinks.interleaved([F.col("a"), F.col("b")], 2).alias("z")).collect()}
    assert got == {(a, b): (a >> 1 & 1) << 3 | (b >> 1 & 1) << 2 | (a & 1) << 1 | (b & 1) for a, b in got}
