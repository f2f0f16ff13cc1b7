"""CSV contract reader: quoting, short rows, header check, empty fields."""

import os
import tempfile

import pytest

from indicata.sources.contract import PATIENT_SCHEMA, PROCEDURE_SCHEMA, read_contract


def _write(text: str) -> str:
    d = tempfile.mkdtemp(prefix="indicata-csv-")
    p = os.path.join(d, "f.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_quoted_newline_kept_and_empty_is_null(spark):
    p = _write('patient_id,procedure_code\n1,"P0\n01"\n2,\n3,""\n')
    rows = [tuple(r) for r in read_contract(spark, p, PROCEDURE_SCHEMA).collect()]
    assert rows == [("1", "P0\n01"), ("2", None), ("3", None)]


def test_short_row_fails(spark):
    p = _write("patient_id,drg,birth_date,admission_date,discharge_date,admission_type\n1,001,2000-01-01\n")
    with pytest.raises(Exception):
        read_contract(spark, p, PATIENT_SCHEMA).collect()


def test_wrong_header_fails(spark):
    p = _write("id,code\n1,P001\n")
    with pytest.raises(Exception):
        read_contract(spark, p, PROCEDURE_SCHEMA).collect()


def test_quarantine_keeps_bad_records_with_file_and_reason(spark):
    from indicata.sources.contract import DIAGNOSIS_SCHEMA, read_quarantined

    head = ",".join(DIAGNOSIS_SCHEMA.names) + "\n"
    sound = _write(head + '1,D001,1,Y\n2,"D,2",,\n3,D003,x7,N\n4,D004\n5,D005,2,Y,more\n6,D006,99999999999999999999,Y\n')
    other = _write("id,code,rank,ind\n7,D007,1,Y\n")
    good, bad = read_quarantined(spark, [sound, other], DIAGNOSIS_SCHEMA)
    assert good.schema.simpleString() == DIAGNOSIS_SCHEMA.simpleString()
    assert sorted(map(tuple, good.collect())) == [("1", "D001", 1, "Y"), ("2", "D,2", None, None)]
    rows = {(r.reason, r.detail, r.record, r.file.endswith(other.rsplit("/", 1)[0] + "/f.csv")) for r in bad.collect()}
    assert rows == {
        ("cast", "diag_rank_num", "3,D003,x7,N", False), ("cast", "diag_rank_num", "6,D006,99999999999999999999,Y", False),
        ("tokens", None, "4,D004", False), ("tokens", None, "5,D005,2,Y,more", False),
        ("header", None, "id,code,rank,ind", True), ("header", None, "7,D007,1,Y", True),
    }


def test_readers_never_find_a_published_table_empty(spark):
    import threading

    from indicata.sources.sinks import child_names, fresh_path, point_table, publish, read_published

    root, rows = fresh_path(spark, "published"), [(i, f"v{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "k long, v string")
    with pytest.raises(FileNotFoundError):
        read_published(spark, root, df.schema)
    publish(df, root)
    held = read_published(spark, root, df.schema)
    counts, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            counts.append(read_published(spark, root, df.schema).count())

    reader = threading.Thread(target=read)
    reader.start()
    for n in (60, 70, 80):
        publish(spark.range(n).selectExpr("id AS k", "string(id) AS v"), root, keep=4)
    stop.set()
    reader.join()
    assert counts and set(counts) <= {50, 60, 70, 80} and counts == sorted(counts)
    assert held.count() == 50  # a reader of an older version still has it
    # A job that fails leaves the old version, and its files are never read.
    with pytest.raises(Exception):
        publish(df.selectExpr("k", "raise_error('no') AS v"), root)
    assert read_published(spark, root, df.schema).count() == 80
    path = publish(df, root, keep=1)
    assert read_published(spark, root, df.schema).count() == 50
    assert [n for n in child_names(spark, root) if "_SUCCESS" in child_names(spark, f"{root}/{n}")] == [path.rsplit("/", 1)[1]]
    table = "published_" + root[-8:]
    assert point_table(spark, table, path, df.schema).count() == 50
    assert point_table(spark, table, publish(df.limit(7), root), df.schema).count() == 7 == spark.table(table).count()
