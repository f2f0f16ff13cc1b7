"""A keyed table in (year, bucket) folders whose upserts rewrite only the
folders that they touch.

A row lies in the year of one of its dates and in a bucket of its key. An
upsert finds the folders of the changed keys' old and new rows, merges those
folders into a staged copy, and publishes the copy by dynamic partition
overwrite; all other files stay as they are. Folders that lost their last row
are removed after that. An upsert that was cut off while publishing is mended
by running it again: a key that then has rows in two folders has both of them
among the touched ones, and the newest stays.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.functions import safe_date
from indicata.operators.incremental import upsert_latest
from indicata.operators.joins import having
from indicata.sources.sinks import fresh_path, remove

YEAR, BUCKET = "_year", "_bucket"
PLACE = [YEAR, BUCKET]


@dataclass(frozen=True)
class Rewritten:
    """(year, bucket) of the folders that an upsert wrote and removed."""

    written: list[tuple[int | None, int]]
    removed: list[tuple[int | None, int]]


@dataclass(frozen=True)
class KeyedTable:
    """One row per ``key`` (not null) under ``path``; ``date_col`` (a date or its text) gives the year, null without one."""

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    date_col: str
    buckets: int

    def _placed(self, df: DataFrame) -> DataFrame:
        date = F.col(self.date_col)
        year = F.year(date if isinstance(self.schema[self.date_col].dataType, T.DateType) else safe_date(date))
        return df.select(*self.schema.names, year.alias(YEAR), F.pmod(F.hash(self.key), F.lit(self.buckets)).alias(BUCKET))

    def _write(self, df: DataFrame, path: str) -> None:
        """Placed rows, a file for each folder, sorted by key."""
        (
            df.repartition(self.buckets, *PLACE)
            .sortWithinPartitions(*PLACE, self.key)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*PLACE)
            .parquet(path)
        )

    def _read(self, path: str) -> DataFrame:
        place = [T.StructField(YEAR, T.IntegerType()), T.StructField(BUCKET, T.IntegerType())]
        return self.spark.read.schema(T.StructType([*self.schema.fields, *place])).parquet(path)

    def create(self, rows: DataFrame) -> None:
        self._write(self._placed(rows), self.path)

    def read(self) -> DataFrame:
        return self._read(self.path).drop(*PLACE)

    @staticmethod
    def _folder() -> Column:
        """A folder's name, of partition columns only: a filter on it is a partition filter."""
        return F.concat_ws("/", F.coalesce(F.col(YEAR).cast("string"), F.lit("")), F.col(BUCKET).cast("string"))

    def _in(self, places: list[tuple[int | None, int]]) -> Column:
        return self._folder().isin([f"{'' if y is None else y}/{b}" for y, b in places])

    @staticmethod
    def _places(df: DataFrame) -> list[tuple[int | None, int]]:
        """The folders of rows; as many as the table has at most."""
        found = {(r[YEAR], r[BUCKET]) for r in df.select(*PLACE).distinct().collect()}
        return sorted(found, key=lambda p: (p[0] is not None, p[0] or 0, p[1]))

    def upsert(self, changes: DataFrame, order_col: str) -> Rewritten:
        """Newest row per key over the table and ``changes``, by rewriting the touched folders."""
        staging, merged = fresh_path(self.spark, "upsert-changes"), fresh_path(self.spark, "upsert-merged")
        self._placed(changes).write.parquet(staging)
        changed = self._read(staging)
        buckets = sorted({b for _, b in self._places(changed)})
        current = self._read(self.path)
        # Keys of the changed buckets only; their older rows may lie in any year.
        old = having(current.filter(F.col(BUCKET).isin(buckets)).select(self.key, *PLACE), changed.select(self.key).distinct(), self.key)
        touched = self._places(old.unionByName(changed.select(self.key, *PLACE)))
        if not touched:
            return Rewritten([], [])
        rows = current.filter(self._in(touched)).drop(*PLACE)
        self._write(self._placed(upsert_latest(rows, changed.drop(*PLACE), [self.key], order_col)), merged)
        result = self._read(merged)
        written = self._places(result)
        # The staged copy is written whole before a published file is replaced.
        self._write(result, self.path)
        removed = [p for p in touched if p not in written]
        for year, bucket in removed:
            name = "__HIVE_DEFAULT_PARTITION__" if year is None else year
            remove(self.spark, f"{self.path}/{YEAR}={name}/{BUCKET}={bucket}")
        return Rewritten(written, removed)
