"""WARC archives: records written in segments, and reassembled from them.

Writing. Every row is a response whose block is an HTTP head and a body in chunked
transfer framing; of rows with equal payloads one is written and the others become
revisit records that refer to it. A long block is cut to segments: a first record with
segment number 1, then continuation records that name the first as their origin, the
last of which states the total length. Spark's text writer puts the records to
gzip-compressed files: its line separator is the blank line that ends a record.

Reading. Files are parsed to records next to the scan. Records without a segment number
are whole. The others are grouped by their origin, ordered by segment number, and joined
if the numbers run from 1 without gap or repeat and the lengths add up to the total
stated. The chunked framing of the whole block is then decoded and the payload's digest
compared. A record that fails one of these is returned with a status that says so.

A group is the segments of one record, so its size is bounded by that of one document.
Payloads are compared by SHA-1 and length, as archives do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairgrid.llm.common import query, table
from pairgrid.session import scratch_path

_END = "\r\n\r\n"
_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; a field whose value is null is left out."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")) for name, value in fields]
    return F.concat_ws("", F.lit("WARC/1.1\r\n"), *lines, F.lit("\r\n"))


def _pieces(data: Column, size: int) -> Column:
    """``data`` cut to pieces of ``size`` bytes; none of empty data."""
    n = F.ceil(F.octet_length(data) / size).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda k: F.substring(data, (k - 1) * size + 1, F.lit(size)))).otherwise(
        F.array().cast("array<binary>")
    )


def chunked(payload: Column, size: int) -> Column:
    """Chunked transfer framing of a binary payload, as text of the same bytes."""
    framed = F.transform(
        _pieces(payload, size),
        lambda x: F.concat(F.lower(F.hex(F.octet_length(x))), F.lit("\r\n"), x.cast("string"), F.lit("\r\n")),
    )
    return F.concat(F.array_join(framed, ""), F.lit("0\r\n\r\n"))


def archive_records(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    body: str = "html",
    revisit_bytes: int = 1000,
    segment_bytes: int = 1 << 20,
    chunk_bytes: int = 8192,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """One column, record: every WARC record without the blank line that ends it.

    Of rows with equal payloads of at least ``revisit_bytes``, that with the largest id
    (among equal ids, one) is the response. Rows are told apart by their place in the
    input, so repeated and null ids give records of their own; the input must come in the
    same order each time it is read, as a table scan does. A null body is an empty
    payload. Other columns are ignored.
    """
    payload = F.coalesce(F.col(body).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"), F.monotonically_increasing_id().alias("place")
    ).withColumns({"sha1": F.sha1("payload"), "size": F.octet_length("payload")})
    own = F.struct("page_id", "place")
    firsts = (
        rows.where(F.col("size") >= revisit_bytes)
        .groupBy("sha1", "size")
        .agg(F.max(own).alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    rows = rows.join(firsts, ["sha1", "size"], "left").withColumn("is_copy", F.coalesce(F.col("first") != own, F.lit(False)))
    name = lambda who: F.concat(F.lit("<urn:page:"), F.coalesce(who["page_id"].cast("string"), F.lit("")), F.lit(":"), who["place"].cast("string"), F.lit(">"))
    uri = F.coalesce(F.regexp_replace("url", r"[\x00-\x20]", "%20"), F.lit("about:blank"))
    block = F.concat(F.lit(_HEAD), F.when(F.col("is_copy"), F.lit("")).otherwise(chunked(F.col("payload"), chunk_bytes))).cast("binary")
    cut = rows.select("*", name(own).alias("name"), uri.alias("uri"), _pieces(block, segment_bytes).alias("segments"), F.octet_length(block).alias("total"))
    each = cut.select("name", "uri", "sha1", "is_copy", "first", "total", F.size("segments").alias("n"), F.posexplode("segments").alias("k", "segment"))
    begins, parted = F.col("k") == 0, F.col("n") > 1
    kind = F.when(~begins, F.lit("continuation")).when(F.col("is_copy"), F.lit("revisit")).otherwise(F.lit("response"))
    where = lambda condition, value: F.when(condition, value)
    head = _lines(
        ("WARC-Type", kind),
        ("WARC-Record-ID", F.when(begins, F.col("name")).otherwise(F.concat(F.rtrim(F.col("name"), F.lit(">")), F.lit(":"), (F.col("k") + 1).cast("string"), F.lit(">")))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", F.col("uri")),
        ("WARC-Payload-Digest", where(begins, F.concat(F.lit("sha1:"), F.col("sha1")))),
        ("WARC-Refers-To", where(begins & F.col("is_copy"), name(F.col("first")))),
        ("WARC-Profile", where(begins & F.col("is_copy"), F.lit(_SAME_PAYLOAD))),
        ("WARC-Segment-Number", where(parted, (F.col("k") + 1).cast("string"))),
        ("WARC-Segment-Origin-ID", where(~begins, F.col("name"))),
        ("WARC-Segment-Total-Length", where(parted & (F.col("k") == F.col("n") - 1), F.col("total").cast("string"))),
        ("Content-Type", where(begins, F.lit("application/http; msgtype=response"))),
        ("Content-Length", F.octet_length("segment").cast("string")),
    )
    return each.select(F.concat(head, F.col("segment").cast("string")).alias("record"))


def write_archive(records: DataFrame, path: str, records_per_file: int = 50_000) -> None:
    """Write records to .gz files below ``path``."""
    records.write.option("lineSep", _END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


_RECORD = pa.schema(
    [("kind", pa.string()), ("name", pa.string()), ("digest", pa.string()), ("refers_to", pa.string()), ("origin", pa.string())]
    + [("segment", pa.int64()), ("total", pa.int64()), ("block", pa.binary()), ("sound", pa.bool_())]
)
_FIELDS = ("warc-type", "warc-record-id", "warc-payload-digest", "warc-refers-to", "warc-segment-origin-id", "warc-segment-number", "warc-segment-total-length")


def unpacked(data: bytes) -> bytes:
    """Plain bytes of a file; gzip members follow one another, and a plain file stays as it is."""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(wbits=31)
        out.append(member.decompress(data) + member.flush())
        data = member.unused_data
    return b"".join([*out, data])


def parse_records(data: bytes) -> Iterator[tuple]:
    """Records of a file in order. What isn't a whole record ends the file with one row that is not sound."""
    at = 0
    while at < len(data):
        if data.startswith(b"\r\n", at):
            at += 2
            continue
        stop = data.find(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n") if stop >= 0 else [""]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        size = fields.get("content-length", "")
        if not lines[0].startswith("WARC/") or not size.isdigit() or stop + 4 + int(size) > len(data):
            yield (*[None] * 7, data[at : at + 200], False)
            return
        kind, name, digest, refers, origin, segment, total = (fields.get(k) for k in _FIELDS)
        number = [int(x) if x and x.isdigit() else None for x in (segment, total)]
        at = stop + 4 + int(size)
        yield kind, name, digest, refers, origin, *number, data[stop + 4 : at], True


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """kind, name, digest, refers_to, origin, segment, total, block, sound of each record below ``path``."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for row in parse_records(unpacked(content.as_py())):
                    rows.append(row)
                    held += len(row[7])
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORD)], schema=_RECORD)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORD)], schema=_RECORD)

    files = spark.read.format("binaryFile").load(path).select("content")
    schema = "kind string, name string, digest string, refers_to string, origin string, segment long, total long, block binary, sound boolean"
    return files.mapInArrow(parsed, schema)


def reassemble(records: DataFrame) -> DataFrame:
    """kind, name, digest, refers_to, block and status of each whole record.

    status is ok, missing_segment (numbers are not 1, 2, .. n, or the first record or
    the total is lacking), length_mismatch, or unreadable.
    """
    columns = ["kind", "name", "digest", "refers_to", "block", "status"]
    whole = records.where(F.col("segment").isNull()).withColumn("status", F.when(F.col("sound"), F.lit("ok")).otherwise(F.lit("unreadable")))
    first = F.col("segment") == 1
    parted = records.where(F.col("segment").isNotNull()).withColumn("origin", F.coalesce(F.when(~first, F.col("origin")), F.col("name")))
    groups = parted.groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
        F.max("total").alias("total"),
        *[F.max(F.when(first, F.col(c))).alias(c) for c in ("kind", "name", "digest", "refers_to")],
    )
    numbers = F.transform("parts", lambda p: p["segment"])
    length = F.aggregate("parts", F.lit(0).cast("long"), lambda s, p: s + F.octet_length(p["block"]))
    run = (numbers == F.sequence(F.lit(1).cast("long"), F.size("parts").cast("long"))) & F.col("name").isNotNull() & F.col("total").isNotNull()
    status = F.when(~run, F.lit("missing_segment")).when(length != F.col("total"), F.lit("length_mismatch")).otherwise(F.lit("ok"))
    block = F.array_join(F.transform("parts", lambda p: p["block"].cast("string")), "").cast("binary")
    joined = groups.withColumns({"status": status, "block": block, "name": F.coalesce("name", "origin")})
    return whole.select(*columns).unionByName(joined.select(*columns))


def decode_http(block: bytes) -> tuple[bytes | None, bool]:
    """Payload of an HTTP message and whether its framing is sound; (None, True) without a body."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None, False
    if b"transfer-encoding: chunked" not in head.lower():
        return body, True
    if not body:
        return None, True
    at, out = 0, []
    while True:
        stop = body.find(b"\r\n", at)
        try:
            size = int(body[at:stop].split(b";")[0], 16) if stop > at else -1
        except ValueError:
            size = -1
        if size < 0:
            return None, False
        if not size:
            return b"".join(out), body.startswith(b"\r\n", stop + 2) or body.endswith(b"\r\n\r\n")
        at = stop + 2 + size
        if body[at : at + 2] != b"\r\n":
            return None, False
        out.append(body[stop + 2 : at])
        at += 2


def payloads(whole: DataFrame) -> DataFrame:
    """name, kind, refers_to, payload_bytes, payload_digest and status of responses and revisits.

    A revisit has the length and digest of the record it refers to, if that is sound and
    has the digest it states. More statuses: bad_framing, digest_mismatch, no_referent.
    """

    @F.pandas_udf("payload binary, sound boolean")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for blocks in batches:
            yield pd.DataFrame([decode_http(b) for b in blocks], columns=["payload", "sound"])

    some = F.coalesce("block", F.lit("").cast("binary"))
    read = whole.withColumn("http", decoded(some)).select(
        "name",
        "kind",
        "refers_to",
        F.octet_length("http.payload").cast("long").alias("size"),
        F.sha1("http.payload").alias("sha1"),
        F.regexp_replace("digest", "^sha1:", "").alias("stated"),
        F.when(F.col("status") != "ok", F.col("status")).when(~F.col("http.sound"), F.lit("bad_framing")).otherwise(F.lit("ok")).alias("status"),
    )
    own = read.where(F.coalesce(F.col("kind") != "revisit", F.lit(True)))
    wrong = (F.col("status") == "ok") & F.coalesce(F.col("stated") != F.col("sha1"), F.lit(False))
    own = own.withColumn("status", F.when(wrong, F.lit("digest_mismatch")).otherwise(F.col("status")))
    there = own.where("status = 'ok'").select(F.col("name").alias("to"), F.col("size").alias("to_size"), F.col("sha1").alias("to_sha1"))
    back = read.where("kind = 'revisit'").join(there, F.col("refers_to") == F.col("to"), "left")
    status = (
        F.when(F.col("status") != "ok", F.col("status"))
        .when(F.col("to").isNull(), F.lit("no_referent"))
        .when(F.coalesce(F.col("stated") != F.col("to_sha1"), F.lit(False)), F.lit("digest_mismatch"))
        .otherwise(F.lit("ok"))
    )
    revisits = back.select("name", "kind", "refers_to", F.col("to_size").alias("size"), F.col("to_sha1").alias("sha1"), status.alias("status"))
    out = own.select("name", "kind", "refers_to", "size", "sha1", "status").unionByName(revisits)
    return out.withColumnsRenamed({"size": "payload_bytes", "sha1": "payload_digest"})


def page_of(name: Column) -> Column:
    return F.regexp_extract(name, "^<urn:page:(-?[0-9]+):", 1).try_cast("long")


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT *, octet_length(encode(html)) AS n FROM p),
w AS (SELECT *, max(page_id) OVER (PARTITION BY digest, n) AS first FROM f)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> first THEN first END AS refers_to
FROM w
"""


@query("op2_warc_reassembly", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every page, read from the archive."""
    path = scratch_path(spark, "archive")
    write_archive(archive_records(table(spark, sf_dir, "pages"), segment_bytes=16_384), path)
    found = payloads(reassemble(read_records(spark, path)))
    return found.select(
        page_of(F.col("name")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("kind").alias("record_type"),
        page_of(F.col("refers_to")).alias("refers_to"),
    )
