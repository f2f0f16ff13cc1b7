"""Writers: month- and year-partitioned parquet, full refresh, small CSV export.

Layout rules:

* facts are bucketed by the encounter key (``save_bucketed``);
* ``write_by_month`` (plain month partitions) sorts by the cluster key inside
  a month after ``repartitionByRange(month, cluster key)``, which splits a
  large month across many tasks and yields non-overlapping files;
* intermediate tables go to a fresh directory under the shared checkpoint
  folder (``fresh_path`` / ``materialize``), so a job never reads and
  overwrites the same path in one plan.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's checkpoint dir.

    On a cluster ``spark.checkpoint.dir`` names shared storage. Without one
    there is no folder that all executors see, so this raises; only a local
    master (one machine) gets a fresh folder of its own.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        sc.setCheckpointDir(tempfile.mkdtemp(prefix="indicata-ckpt-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def _hadoop_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder on any file system Spark reaches; empty if the folder
    does not exist. Every other failure is raised."""
    fs, p = _hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    fs, p = _hadoop_path(spark, path)
    return fs.getContentSummary(p).getLength()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on any file system Spark reaches."""
    fs, p = _hadoop_path(spark, path)
    fs.delete(p, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(
    df: DataFrame, name: str, *, cluster_by: Sequence[str] = ()
) -> DataFrame:
    """Write ``df`` to a fresh directory in the shared scratch folder and read
    it back: lineage is cut at the written table (a lost executor recomputes
    from it). The bytes of its files are recorded as the bound for later
    broadcast checks; ``cluster_by`` sorts rows inside each file so parquet
    statistics skip row groups on those columns."""
    from indicata.operators.joins import EXPANSION, declare_bytes

    spark = df.sparkSession
    path = fresh_path(spark, name)
    (df.sortWithinPartitions(*cluster_by) if cluster_by else df).write.mode("overwrite").parquet(path)
    return declare_bytes(spark.read.schema(df.schema).parquet(path), EXPANSION * stored_bytes(spark, path))


def save_bucketed(
    df: DataFrame,
    table: str,
    path: str,
    key: str,
    buckets: int,
    *,
    partition_by: str | None = None,
    placed: bool = False,
    sort_by: Sequence[str] = (),
    page_rows: int | None = None,
) -> DataFrame:
    """Write ``df`` as a bucketed parquet table at ``path`` and return it.

    Rows are hash-partitioned into ``buckets`` by ``key`` (one shuffle, at
    write time) and sorted by ``sort_by`` (default ``key``) inside each bucket;
    ``page_rows`` bounds the rows of a parquet page, the least that a filter on
    the leading sort column can skip. Tables bucketed the
    same way are co-located: later joins and aggregations on ``key`` read
    bucket i of every table in task i and need no exchange. ``partition_by``
    adds a directory partition (e.g. the discharge year) for pruning. With
    ``placed`` the rows are already partitioned so and are not shuffled again.
    """
    writer = (
        (df if placed else df.repartition(buckets, key))
        .write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(*(sort_by or [key]))
    )
    if page_rows:
        writer = writer.option("parquet.page.row.count.limit", page_rows)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def overwrite_partitions(df: DataFrame, table: str, key: str, buckets: int, partition_by: str, values: Sequence) -> None:
    """Replace the given partitions of a bucketed table by ``df`` (rows of those
    partitions only, not read from the table itself); others keep their files."""
    spark = df.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    left = {r[0] for r in df.select(partition_by).distinct().collect()}
    spark.conf.set(mode, "dynamic")
    try:
        df.select(spark.table(table).columns).repartition(buckets, key).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)
    for value in values:
        if value not in left:
            spec = "'__HIVE_DEFAULT_PARTITION__'" if value is None else f"{value}"
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition_by} = {spec})")
    spark.catalog.refreshTable(table)


def write_by_month(
    df: DataFrame,
    path: str,
    date_col: str,
    *,
    month_col: str = "discharge_month",
    cluster_by: Sequence[str] = ("patient_id",),
    num_partitions: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Month-partitioned parquet (``month_col`` = first day of the month).

    Rows are range-partitioned by month and cluster key first (into
    ``num_partitions``, by default the session's shuffle partitions), so a
    month has as many files as it fills tasks, not one per input task, and a
    large month is split.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = df.withColumn(month_col, F.trunc(F.col(date_col), "MM"))
    out = out.repartitionByRange(n, month_col, *cluster_by).sortWithinPartitions(month_col, *cluster_by)
    (
        out.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(month_col)
        .parquet(path)
    )


def read_by_month(spark: SparkSession, path: str, schema: T.StructType, month_col: str = "discharge_month") -> DataFrame:
    """Read back with the partition column typed as DATE (no inference)."""
    full = T.StructType([*schema.fields, T.StructField(month_col, T.DateType())])
    return spark.read.schema(full).parquet(path)


def write_by_year(df: DataFrame, path: str, year_col: str = "reference_year", cluster_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    out = df.sortWithinPartitions(year_col, *cluster_by) if cluster_by else df
    out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(year_col).parquet(path)


def read_by_year(spark: SparkSession, path: str, schema: T.StructType, year_col: str = "reference_year") -> DataFrame:
    fields = [f for f in schema.fields if f.name != year_col]
    full = T.StructType([*fields, T.StructField(year_col, T.LongType())])
    return spark.read.schema(full).parquet(path)


def value_ranks(df: DataFrame, column: str, bits: int) -> DataFrame:
    """(column, rank): every distinct value with its place among 2^``bits`` ranges
    of the sorted distinct values, nulls first; equal values share a rank."""
    values = df.select(column).distinct().repartitionByRange(1 << bits, F.col(column).asc_nulls_first())
    return materialize(values.withColumn("rank", F.spark_partition_id()), f"ranks-{column}")


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """One key of the bits of all ranks in turn, highest first, so that rows near
    in the key are near in every rank."""
    n = len(ranks)
    parts = [F.shiftleft(F.shiftright(r.cast("long"), i).bitwiseAND(F.lit(1)), i * n + n - 1 - j) for i in range(bits) for j, r in enumerate(ranks)]
    return sum(parts[1:], parts[0])


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], *, bits: int = 5, num_partitions: int | None = None) -> None:
    """Parquet clustered by several columns at once: a filter on any of them
    skips files by their statistics, where a plain sort serves its first only.

    Rows are range-partitioned and sorted by the interleaved key; a hash of the
    row comes last in the key, so a combination that very many rows share
    fills several files. The ranks are small tables of distinct values, joined
    as the planner sees fit.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, names = df, df.columns
    for k, c in enumerate(columns):
        side = value_ranks(df, c, bits).select(F.col(c).alias(f"_value_{k}"), F.col("rank").alias(f"_rank_{k}"))
        rows = rows.join(side, F.col(c).eqNullSafe(F.col(f"_value_{k}")), "left")
    key = interleaved([F.col(f"_rank_{k}") for k in range(len(columns))], bits)
    placed = rows.select(*names, key.alias("_cell"), F.xxhash64(*names).alias("_row"))
    order = ["_cell", *columns, "_row"]
    placed.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("_cell", "_row").write.parquet(path)


def full_refresh(df: DataFrame, path: str) -> None:
    """TRUNCATE + INSERT: replace the table's contents. The old files go before
    the new ones are committed, so readers need the job to have ended; see
    ``publish`` for tables that are read meanwhile."""
    df.write.mode("overwrite").parquet(path)


VERSION = "version="


def _versions(spark: SparkSession, root: str) -> list[str]:
    """Complete versions under ``root``, oldest first: those with the marker that
    Spark writes when a job has committed all its files."""
    names = [n for n in child_names(spark, root) if n.startswith(VERSION)]
    return [n for n in names if "_SUCCESS" in child_names(spark, f"{root}/{n}")]


def publish(df: DataFrame, root: str, *, keep: int = 2) -> str:
    """Replace a table's contents without a moment in which it is empty: the rows
    are written as a new version under ``root``, which readers see once its
    files are all committed. A failed job leaves the old version; ``keep``
    versions stay for readers that still have an older one open."""
    spark = df.sparkSession
    names = child_names(spark, root)
    last = max([int(n[len(VERSION):]) for n in names if n.startswith(VERSION)], default=0)
    path = f"{root}/{VERSION}{last + 1:010d}"
    df.write.parquet(path)
    for old in _versions(spark, root)[:-keep]:
        remove(spark, f"{root}/{old}")
    return path


def read_published(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The newest complete version of a published table; it stays readable while newer ones come."""
    found = _versions(spark, root)
    if not found:
        raise FileNotFoundError(f"nothing is published under {root}")
    return spark.read.schema(schema).parquet(f"{root}/{found[-1]}")


def point_table(spark: SparkSession, table: str, path: str, schema: T.StructType) -> DataFrame:
    """Point a catalog table at a published version: one change of its location."""
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=path, source="parquet", schema=schema)
    return spark.table(table)


def export_csv(df: DataFrame, path: str, order_by: str | None = None) -> None:
    """The monthly metrics table (at most a row per month) as one headered CSV
    file. ``repartition`` keeps the work before it parallel."""
    out = df.repartition(1)
    if order_by:
        out = out.sortWithinPartitions(order_by)
    out.write.mode("overwrite").option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Headered CSV in the source contract's dialect (quoted as needed)."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)
