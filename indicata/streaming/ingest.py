"""Incremental load of staged extracts as a Structured Streaming query.

The nightly design extracts changed rows (with a lookback buffer) into a
staging area and MERGEs them into the keyed core table. On Spark that is a
file-source stream over the staging folder:

* the file source's checkpoint records which extract files were applied,
  so every file is applied exactly once, across restarts and lost executors;
* ``trigger(availableNow=True)`` processes everything staged so far and
  stops, which is how a nightly batch job runs a stream;
* each micro-batch writes its own rows only, to ``epoch=<id>`` in a folder of
  changes beside the state folder; a retried epoch rewrites only its own
  directory (idempotent);
* when the stream has stopped, all changes that no snapshot holds yet are
  upserted into the newest one (newest row per key, ``upsert_latest``) and the
  result is a *new* snapshot directory ``epoch=<last id>``, so the table is
  rewritten once a run, however many files it had. Nothing is read and
  overwritten in the same plan. Changes are removed once a snapshot holds them;
  those of a run that was cut off are merged by the next one.

Snapshots are found by listing the state folder through Hadoop's FileSystem;
a folder that does not exist means "no snapshot yet", and a snapshot that
exists but cannot be read fails the job instead of counting as empty.

Re-applying an already applied row is harmless: the upsert keeps the newest
version per key, so the lookback overlap of consecutive extracts is safe.
"""

from __future__ import annotations

from typing import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.operators.incremental import latest_by_key, upsert_latest
from indicata.sources.sinks import child_names, fresh_path, remove

_DONE = "_SUCCESS"


def epochs(spark: SparkSession, state_dir: str) -> list[int]:
    """Ids of the completely written snapshots, ascending (directory names only)."""
    found = [int(n.removeprefix("epoch=")) for n in child_names(spark, state_dir) if n.startswith("epoch=")]
    return sorted(e for e in found if _DONE in child_names(spark, f"{state_dir}/epoch={e}"))


def read_snapshot(
    spark: SparkSession, state_dir: str, schema: T.StructType, before_epoch: int | None = None
) -> DataFrame | None:
    """Newest snapshot (optionally strictly before ``before_epoch``), or None if none was written."""
    known = [e for e in epochs(spark, state_dir) if before_epoch is None or e < before_epoch]
    return spark.read.schema(schema).parquet(f"{state_dir}/epoch={known[-1]}") if known else None


def changes_dir(state_dir: str) -> str:
    """Where micro-batches leave their rows until a snapshot holds them."""
    return f"{state_dir.rstrip('/')}-changes"


def _without_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def apply_staged_extracts(
    spark: SparkSession,
    staging_dir: str,
    schema: T.StructType,
    state_dir: str,
    keys: Sequence[str],
    order_col: str,
    *,
    initial: DataFrame | None = None,
    checkpoint_dir: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Run the staged-extract stream to completion and return the newest snapshot.

    ``initial`` seeds the table when no snapshot exists yet. The stream's
    checkpoint lives under the session's shared checkpoint folder unless
    ``checkpoint_dir`` is given.
    """
    ckpt = checkpoint_dir or fresh_path(spark, "stream-ckpt")
    changes, names, applied = changes_dir(state_dir), schema.fieldNames(), set()

    def keep_batch(batch: DataFrame, epoch_id: int) -> None:
        rows = batch.select(names)
        # A batch's rows without a key count as versions of one row.
        unkeyed = latest_by_key(rows.filter(_without_key(keys)), keys, order_col)
        rows.filter(~_without_key(keys)).unionByName(unkeyed).write.mode("overwrite").parquet(f"{changes}/epoch={epoch_id}")
        applied.add(epoch_id)

    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    query = (
        reader.parquet(staging_dir)
        .writeStream.foreachBatch(keep_batch)
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    known = epochs(spark, state_dir)
    kept = epochs(spark, changes)
    pending = [e for e in kept if e in applied or not known or e > known[-1]]
    if pending:
        current = read_snapshot(spark, state_dir, schema, before_epoch=pending[0])
        if current is None:
            current = initial if initial is not None else spark.createDataFrame([], schema)
        rows = spark.read.schema(schema).parquet(*[f"{changes}/epoch={e}" for e in pending])
        merged = upsert_latest(current.select(names), rows.filter(~_without_key(keys)), keys, order_col)
        merged.unionByName(rows.filter(_without_key(keys))).write.mode("overwrite").parquet(f"{state_dir}/epoch={pending[-1]}")
    for e in kept:
        remove(spark, f"{changes}/epoch={e}")
    out = read_snapshot(spark, state_dir, schema)
    if out is None:
        return initial if initial is not None else spark.createDataFrame([], schema)
    return out
