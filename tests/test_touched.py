"""Upserts of a table in (year, bucket) folders: touched files only, moved keys, emptied folders, mended runs."""

import glob
import os

from pyspark.sql import functions as F

from indicata.sources.touched import KeyedTable
from indicata.sources.sinks import fresh_path

SCHEMA = "patient_id string, day string, v long, updated_at long"


def _store(spark, rows, buckets=8):
    df = spark.createDataFrame(rows, SCHEMA)
    store = KeyedTable(spark, fresh_path(spark, "store"), df.schema, "patient_id", "day", buckets)
    store.create(df)
    return store


def _files(store):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{store.path.removeprefix('file:')}/*/*/*.parquet")}


def _rows(store):
    return sorted(map(tuple, store.read().collect()))


def test_only_touched_folders_are_rewritten(spark):
    rows = [(str(i), f"{1990 + i % 5}-03-0{1 + i % 9}", i, 0) for i in range(400)]
    store = _store(spark, rows)
    before = _files(store)
    assert len(before) == 40
    change = [("7", rows[7][1], -1, 1), ("new", "1992-01-01", -2, 1)]
    done = store.upsert(spark.createDataFrame(change, SCHEMA), "updated_at")
    after = _files(store)
    assert len(done.written) == 2 and not done.removed
    assert len(set(after) - set(before)) == 2 and all(after[f] == before[f] for f in set(after) & set(before))
    assert len(set(before) & set(after)) == 38
    assert _rows(store) == sorted([r for r in rows if r[0] != "7"] + change)


def test_keys_that_move_and_folders_that_empty(spark):
    store = _store(spark, [("a", "1995-01-01", 1, 1), ("b", "1996-01-01", 2, 1), ("c", "no day", 3, 1)], buckets=1)
    moved = [("a", "1996-05-05", 10, 2), ("c", "1996-06-06", 30, 2), ("b", "1997-07-07", 0, 0)]
    done = store.upsert(spark.createDataFrame(moved, SCHEMA), "updated_at")
    assert _rows(store) == [("a", "1996-05-05", 10, 2), ("b", "1996-01-01", 2, 1), ("c", "1996-06-06", 30, 2)]
    assert set(done.removed) == {(1995, 0), (None, 0), (1997, 0)}
    assert len(_files(store)) == 1


def test_rerun_and_run_cut_off_while_publishing(spark):
    rows = [("a", "1995-01-01", 1, 1), ("b", "1995-02-01", 2, 1)]
    change = spark.createDataFrame([("a", "1996-01-01", 9, 2)], SCHEMA)
    store = _store(spark, rows, buckets=1)
    # The new folder is there, the old one was not yet rewritten.
    store._write(store._placed(change), store.path)
    assert store.read().count() == 3
    store.upsert(change, "updated_at")
    want = [("a", "1996-01-01", 9, 2), ("b", "1995-02-01", 2, 1)]
    assert _rows(store) == want
    store.upsert(change, "updated_at")
    assert _rows(store) == want


def test_no_changes(spark):
    store = _store(spark, [("a", "1995-01-01", 1, 1)])
    before = _files(store)
    assert store.upsert(spark.createDataFrame([], SCHEMA), "updated_at").written == []
    assert _files(store) == before


def test_the_old_rows_are_read_by_partition_filters(spark, capsys):
    store = _store(spark, [(str(i), f"{1990 + i % 5}-03-01", i, 0) for i in range(50)])
    store._read(store.path).filter(store._in([(1991, 2), (None, 3)])).explain()
    assert "PartitionFilters: [concat_ws(/" in capsys.readouterr().out
