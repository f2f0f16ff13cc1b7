"""WARC archives: writing with revisits, reading, and assembly of transactions.

``write_archives`` writes three records for each page: a request, a response
(or a revisit, where another page holds the same payload) and a metadata
record. Request and metadata name their response in ``WARC-Concurrent-To``.
Files are plain WARC 1.1, gzip-compressed, written by Spark's text writer: a
record ends with two line ends, which are the writer's separator.

``read_records`` splits at that separator and joins the pieces again by
``Content-Length``, so payloads may hold the separator themselves. Gzip keeps
one file in one task. ``assemble`` joins request, response and metadata
records through the concurrent-to identifiers and gives one nested row per
capture; ``resolve_revisits`` follows ``WARC-Refers-To``.

Which record is the response: of equal payloads of at least ``least`` bytes
the row with the largest id, shorter payloads always. Rows are numbered in a
first pass, so ``pages`` must be a repeatable read (a table).

Defined results: a null payload is empty; a null url has no target URI; a null
id is written and read back as null, and counts as smaller than any id. Of
rows that repeat id and payload, one is the response and the others revisit
it. An empty table gives an empty archive. Extra columns are not stored. A
capture without request or metadata has null there; of several, the one with
the smallest record id is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.llm.common import stage

LEAST_REVISIT = 1000
END = "\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"


def _record_id(kind: str) -> Column:
    h = F.md5(F.concat_ws("/", F.lit(kind), F.col("seq").cast("string")).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _record(kind: Column, record_id: Column, headers: list[Column], block: Column, date: str) -> Column:
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", record_id),
        _line("WARC-Date", F.lit(date)),
        *headers,
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


def decide(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(digest, first): the row number of the response for every payload that several rows share."""
    light = pages.filter(F.col("size") >= least).groupBy("digest").agg(F.max(F.struct(F.col("page_id"), F.col("seq"))).alias("first"), F.count(F.lit(1)).alias("n"))
    return light.filter("n > 1").select("digest", F.col("first.seq").alias("first"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST_REVISIT, date: str = DATE) -> None:
    """Write one request, response or revisit, and metadata record per row as ``.gz`` files in ``path``."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(
        F.monotonically_increasing_id().alias("seq"),
        F.col(id_col).alias("page_id"),
        F.regexp_replace(F.col(url_col), "[\\x00-\\x20\\x7f]", "").alias("url"),
        payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("digest"),
        F.octet_length(payload).alias("size"),
    )
    # Written: its real size decides whether the next join broadcasts it.
    first = stage(decide(rows.select("seq", "page_id", "digest", "size"), least), "warc-first")
    rows = rows.join(first, "digest", "left")
    again = (F.col("size") >= least) & F.col("first").isNotNull() & (F.col("first") != F.col("seq"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    uri = _line("WARC-Target-URI", F.col("url"))
    concurrent = _line("WARC-Concurrent-To", _record_id("response"))
    target = F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.md5(F.concat_ws("/", F.lit("response"), F.col("first").cast("string")).cast("binary")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))
    main = _record(
        F.when(again, "revisit").otherwise("response"),
        _record_id("response"),
        [
            uri,
            _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            F.when(again, F.concat(_line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), _line("WARC-Refers-To", target))).otherwise(""),
            _line("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.when(again, http).otherwise(F.concat(http, F.col("payload"))),
        date,
    )
    request = _record(F.lit("request"), _record_id("request"), [uri, concurrent, _line("Content-Type", F.lit("application/http; msgtype=request"))], F.concat(F.lit("GET "), F.coalesce(F.col("url"), F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n")), date)
    metadata = _record(F.lit("metadata"), _record_id("metadata"), [uri, concurrent, _line("Content-Type", F.lit("application/warc-fields"))], _line("page_id", F.col("page_id").cast("string")), date)
    rows.select(F.explode(F.array(request, main, metadata)).alias("record")).write.option("lineSep", END).option("compression", "gzip").text(path)


def parse_head(head: bytes) -> dict[str, str]:
    """Header fields of a record, names in lower case; the first of a name counts."""
    out: dict[str, str] = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out.setdefault(name.strip().lower().decode("utf-8", "replace"), value.strip().decode("utf-8", "replace"))
    return out


def records(pieces: Iterator[bytes], end: bytes = END.encode()) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, block) of the records whose text was split at ``end``, in order.

    Only the lengths count: the pieces are read as the stream they were cut from.
    """
    held = b""

    def fill(n: int) -> bool:
        """Hold n bytes or more; false at the end of the stream."""
        nonlocal held
        parts, have = [held], len(held)
        for piece in pieces:
            parts += [piece, end]
            have += len(piece) + len(end)
            if have >= n:
                break
        held = b"".join(parts)
        return have >= n

    while True:
        held = held.lstrip(b"\r\n")
        if not held:
            if not fill(1):
                return
            continue
        at = held.find(end)
        while at < 0:
            if not fill(len(held) + 1):
                raise ValueError("a WARC header has no end")
            at = held.find(end)
        if not held.startswith(b"WARC/"):
            raise ValueError("not at the start of a WARC record")
        fields = parse_head(held[:at])
        start = at + len(end)
        size = int(fields["content-length"])
        if len(held) < start + size and not fill(start + size):
            raise ValueError("a WARC record is cut off")
        yield fields, held[start : start + size]
        held = held[start + size :]


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: type, record_id, concurrent_to, refers_to, uri, headers, block."""
    lines = spark.read.option("lineSep", END).text(path).select(F.col("value").cast("binary").alias("value"))
    names = ["warc-type", "warc-record-id", "warc-concurrent-to", "warc-refers-to", "warc-target-uri"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (v.as_py() for b in batches for v in b.column("value"))
        rows: list[tuple] = []
        held = 0

        def batch() -> pa.RecordBatch:
            heads = [h for h, _ in rows]
            fields = [pa.array([h.get(n) for h in heads], pa.string()) for n in names]
            all_fields = pa.array([list(h.items()) for h in heads], pa.map_(pa.string(), pa.string()))
            return pa.RecordBatch.from_arrays([*fields, all_fields, pa.array([b for _, b in rows], pa.binary())], ["type", "record_id", "concurrent_to", "refers_to", "uri", "headers", "block"])

        for record in records(pieces):
            rows.append(record)
            held += len(record[1])
            if len(rows) >= 2000 or held > 16 << 20:
                yield batch()
                rows, held = [], 0
        if rows:
            yield batch()

    return lines.mapInArrow(run, "type string, record_id string, concurrent_to string, refers_to string, uri string, headers map<string,string>, block binary")


def _http(block: Column, headers: Column) -> tuple[Column, Column]:
    """(head, payload) of an HTTP message."""
    at = F.position(F.lit(END), block.cast("string"))  # in characters; the head is ASCII
    return F.when(at > 0, F.substring(block, F.lit(1), at - 1)).otherwise(block), F.when(at > 0, F.substring(block, at + 4, F.octet_length(block))).otherwise(F.lit(b""))


def assemble(found: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, uri, revisit, refers_to, response, request, metadata."""
    head, payload = _http(F.col("block"), F.col("headers"))
    length = F.regexp_extract(head.cast("string"), "(?i)(?:^|\\n)Content-Length: *([0-9]+)", 1)
    main = found.filter(F.col("type").isin("response", "revisit")).select(
        "record_id",
        "uri",
        (F.col("type") == "revisit").alias("revisit"),
        "refers_to",
        F.struct(
            F.col("headers")["warc-payload-digest"].alias("declared_digest"),
            F.when(length != "", length.cast("long")).alias("declared_bytes"),
            F.sha1(payload).alias("payload_digest"),
            F.octet_length(payload).cast("long").alias("payload_bytes"),
            payload.alias("payload"),
        ).alias("response"),
    )

    def linked(kind: str) -> DataFrame:
        side = found.filter(F.col("type") == kind).filter("concurrent_to IS NOT NULL")
        return side.groupBy(F.col("concurrent_to").alias("record_id")).agg(F.min(F.struct(F.col("record_id").alias("record_id"), F.col("block").cast("string").alias("block"))).alias(kind))

    return main.join(linked("request"), "record_id", "left").join(linked("metadata"), "record_id", "left")


def resolve_revisits(captures: DataFrame, id_col: str = "page_id") -> DataFrame:
    """One row per capture: id, payload_bytes, payload_digest, record_type, refers_to (an id), ok.

    A response is measured by its stored payload, a revisit by the response
    it refers to; ``ok`` tells that the declared digest agrees.
    """
    page = F.regexp_extract(F.col("metadata.block"), "page_id: *(-?[0-9]+)", 1)
    light = stage(
        captures.select("record_id", "revisit", "refers_to", F.when(page != "", page.cast("long")).alias("id"), F.col("response.declared_digest").alias("declared"), F.col("response.payload_digest").alias("digest"), F.col("response.payload_bytes").alias("bytes")),
        "warc-captures",
    )
    one = light.filter("NOT revisit").select(F.col("id").alias(id_col), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), (F.col("declared") == F.concat(F.lit("sha1:"), F.col("digest"))).alias("ok"))
    # Only responses that something refers to are joined.
    target = light.filter("NOT revisit").select(F.col("record_id").alias("refers_to"), F.col("id").alias("to_id"), F.col("digest").alias("to_digest"), F.col("bytes").alias("to_bytes"))
    two = light.filter("revisit").join(target, "refers_to", "left")
    two = two.select(F.col("id").alias(id_col), F.col("to_bytes").alias("payload_bytes"), F.col("to_digest").alias("payload_digest"), F.lit("revisit").alias("record_type"), F.col("to_id").alias("refers_to"), (F.col("declared") == F.concat(F.lit("sha1:"), F.col("to_digest"))).alias("ok"))
    return one.unionByName(two)

