"""WARC: records, round trips of archives, revisits and assembly."""

import glob
import gzip
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from indicata.llm import warc

SCHEMA = "page_id long, url string, html string"


@given(st.lists(st.binary(max_size=40).map(lambda b: b.replace(b"x", b"\r\n\r\n").replace(b"y", b"\r\n")), max_size=8))
@settings(max_examples=200, deadline=None)
def test_records_are_cut_by_their_length(blocks):
    stream = b"".join(b"WARC/1.1\r\nContent-Length: %d\r\nN: %d\r\n\r\n%b\r\n\r\n" % (len(b), i, b) for i, b in enumerate(blocks))
    pieces = stream.split(b"\r\n\r\n")
    assert [b for _, b in warc.records(iter(pieces[:-1]))] == blocks


def test_damaged_archives_are_refused():
    with pytest.raises(ValueError):
        list(warc.records(iter([b"not a record", b""])))
    with pytest.raises(ValueError):
        list(warc.records(iter([b"WARC/1.1\r\nContent-Length: 99", b"short"])))


def brute(rows, least=1000):
    first = {}
    for n, (i, _, h) in enumerate(rows):
        b = (h or "").encode()
        if len(b) >= least:
            first[b] = max(first.get(b, (False, 0, 0)), (i is not None, i or 0, n))
    out = []
    for n, (i, _, h) in enumerate(rows):
        b = (h or "").encode()
        keep = first.get(b)
        again = keep is not None and keep[1] != (i or 0)
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", keep[1] if again else None))
    return sorted(out, key=repr)


def run(spark, frame, path, **options):
    warc.write_archives(frame, path, **options)
    return warc.assemble(warc.read_records(spark, path))


def test_round_trip(spark, stored, tmp_path):
    big = "<p>ü</p>" * 300
    rows = [(1, "http://a/1", big), (9, "http://a/9", big), (4, None, big), (2, "http://b/\r\n x", None), (3, "http://c", ""), (5, "http://d", "small"), (6, "http://e", "small"), (7, "http://f", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (8, "http://g", "z" * 300_000 + "\r\n\r\n")]
    path = str(tmp_path / "w")
    captures = run(spark, stored(spark.createDataFrame(rows, SCHEMA).repartition(3)), path)
    found = {r.metadata.block.split(": ")[1].strip(): r for r in captures.collect()}
    assert len(found) == len(rows)
    for i, url, html in rows:
        r = found[str(i)]
        assert r.revisit == (i in (1, 4))
        assert r.uri == (None if url is None else url.replace("\r\n ", ""))
        assert r.request.block.startswith("GET ")
        if not r.revisit:
            assert bytes(r.response.payload) == (html or "").encode()
        else:
            assert r.refers_to == found["9"].record_id
    out = warc.resolve_revisits(captures)
    assert all(r.ok for r in out.collect())
    assert sorted(map(tuple, out.drop("ok").collect()), key=repr) == brute(rows)


def test_files_are_plain_warc(spark, stored, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(stored(spark.createDataFrame([(1, "http://a", "hello")], SCHEMA)), path)
    text = b"".join(gzip.open(f).read() for f in glob.glob(path + "/*.gz"))
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == 3 and text.endswith(b"page_id: 1\r\n\r\n\r\n")
    kinds = [k for k in (b"request", b"response", b"metadata") if b"WARC-Type: " + k in text]
    assert len(kinds) == 3 and text.count(b"WARC-Concurrent-To: <urn:uuid:") >= 2


def test_null_ids_and_repeated_rows(spark, stored, tmp_path):
    big = "q" * 2_000
    rows = [(None, "u", big), (None, "v", "w"), (3, "u", big), (3, "u", big), (3, "u", "w")]
    out = [tuple(r) for r in warc.resolve_revisits(run(spark, stored(spark.createDataFrame(rows, SCHEMA).coalesce(1)), str(tmp_path / "w"))).drop("ok").collect()]
    assert len(out) == 5
    big_rows = [r for r in out if r[1] == 2_000]
    assert sorted(r[3] for r in big_rows) == ["response", "revisit", "revisit"]
    assert {r[4] for r in big_rows if r[3] == "revisit"} == {3}


def test_foreign_captures_without_partners(spark, tmp_path):
    (tmp_path / "w").mkdir()
    record = lambda kind, rid, extra, block: f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {rid}\r\n{extra}Content-Length: {len(block)}\r\n\r\n{block}\r\n\r\n"
    text = record("warcinfo", "<i>", "", "software: x\r\n") + record("response", "<r>", "", "no http head") + record("metadata", "<m2>", "WARC-Concurrent-To: <r>\r\n", "b") + record("metadata", "<m1>", "warc-concurrent-to: <r>\r\n", "a") + record("request", "<q>", "", "alone")
    with gzip.open(tmp_path / "w" / "x.warc.gz", "wb") as f:
        f.write(text.encode())
    (row,) = warc.assemble(warc.read_records(spark, str(tmp_path / "w"))).collect()
    assert (row.record_id, row.request, row.metadata.record_id, row.metadata.block) == ("<r>", None, "<m1>", "a")
    assert row.response.declared_bytes is None


def test_empty_table(spark, stored, tmp_path):
    empty = stored(spark.createDataFrame([], SCHEMA))
    assert warc.resolve_revisits(run(spark, empty, str(tmp_path / "w"))).collect() == []
