"""Document fingerprints from content-defined chunks.

A gear hash rolls over the bytes of a text. A chunk ends where the hash has certain
bits clear: many bits before the normal size, few after it, so that sizes stay near
it; a chunk is never shorter than the least size nor longer than the largest. As a
boundary depends on the last 32 bytes only, an edit moves the boundaries around it and
leaves the others. A fingerprint is the set of 64-bit chunk digests, each with the chunk's
length; the likeness of two fingerprints is the length of what they share as a part of
the shorter one (containment).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairgrid.llm.common import free_buffers, query, short_batches, table, whole_text


@dataclass(frozen=True)
class Chunking:
    """Sizes in bytes, 255 at most; ``strict`` and ``loose`` are the clear bits asked for before and after ``normal``."""

    least: int = 16
    normal: int = 32
    largest: int = 128
    strict: int = 6
    loose: int = 3
    seed: int = 1


def _gear(seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling(data: bytes, gear: np.ndarray) -> np.ndarray:
    """Gear hash at every byte: the sum of gear[b] << age over the last 32 bytes, modulo 2**32."""
    h = gear[np.frombuffer(data, dtype=np.uint8)]
    for span in (1, 2, 4, 8, 16):
        later = h[span:] + (h[:-span] << np.uint32(span))
        h = np.concatenate([h[:span], later]) if len(h) > span else h
    return h


def boundaries(data: bytes, gear: np.ndarray, how: Chunking) -> list[int]:
    """Ends of the chunks of ``data``."""
    if not data:
        return []
    h = rolling(data, gear)
    loose = np.flatnonzero((h >> np.uint32(32 - how.loose)) == 0) + 1
    strict = loose[(h[loose - 1] >> np.uint32(32 - how.strict)) == 0].tolist() + [len(data) + how.largest]
    loose = loose.tolist() + [len(data) + how.largest]
    ends, at, s, w = [], 0, 0, 0
    while at < len(data):
        while strict[s] < at + how.least:
            s += 1
        if strict[s] <= at + how.normal:
            end = strict[s]
        else:
            while loose[w] <= at + how.normal:
                w += 1
            end = min(loose[w], at + how.largest)
        at = min(end, len(data))
        ends.append(at)
    return ends


def chunk_set(text: str, gear: np.ndarray, how: Chunking) -> dict[int, int]:
    """Digest of each different chunk and its length in bytes."""
    import xxhash

    data = text.encode()
    ends = boundaries(data, gear, how)
    return {xxhash.xxh64_intdigest(data[a:b]): b - a for a, b in zip([0, *ends], ends)}


def shown(chunks: dict[int, int]) -> str:
    """Chunks in order of their digests, eighteen hex digits each: sixteen of digest, two of length."""
    packed = np.zeros(len(chunks), dtype=[("digest", ">u8"), ("length", "u1")])
    packed["digest"], packed["length"] = np.array(list(chunks), dtype=np.uint64), list(chunks.values())
    return packed[np.argsort(packed["digest"])].tobytes().hex()


def likeness(a: dict[int, int], b: dict[int, int]) -> float:
    """Shared length over the shorter total; 1 where both are empty, 0 where one is."""
    if not a or not b:
        return float(a == b)
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    return min(1.0, sum(n for d, n in small.items() if d in large) / min(sum(a.values()), sum(b.values())))


def spliced(text: str, following: str) -> str:
    """The last third of ``text`` replaced by as many first characters of ``following``, or all it has."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


_OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string())]
    + [("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def _compared(how: Chunking):
    gear = _gear(how.seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows: list[tuple] = []
            ids, extra = batch.column("doc_id").to_pylist(), batch.column("extra").to_pylist()
            for name, is_extra, body in zip(ids, extra, batch.column("text")):
                text = body.as_py()
                chunks = chunk_set(text, gear, how)
                if held is not None:
                    doc, own, found = held
                    edited = spliced(own, text)
                    changed = chunk_set(edited, gear, how)
                    sha = hashlib.sha256(edited.encode()).hexdigest()
                    rows.append((doc, len(own), sha, shown(found), shown(changed), likeness(found, changed), likeness(found, chunks)))
                held = None if is_extra else (name, text, chunks)
            columns = list(zip(*rows)) if rows else [[] for _ in _OUT]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _OUT)], schema=_OUT)
        free_buffers()

    return run


_KEY = "array<struct<known: boolean, doc_id: bigint, tie: bigint>>"


def _heads(keys: DataFrame, ranges: int) -> str:
    """First key of each range of the falling order, as JSON: at most ``ranges`` keys, whatever the table's size."""
    dealt = keys.repartitionByRange(ranges, F.col("key").desc()).select(F.spark_partition_id().alias("range"), "key")
    heads = dealt.groupBy("range").agg(F.max("key").alias("key"))
    listed = heads.agg(F.to_json(F.sort_array(F.collect_list("key"), asc=False)).alias("heads"))
    return listed.first()["heads"]


def compare_with_next(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", how: Chunking = Chunking(), ranges: int | None = None
) -> DataFrame:
    """Fingerprints of each text and of its edit, and how near it is to the edit and to the next text.

    Next is the following row by falling id (null ids last, equal ids by a hash of the
    text); after the last row comes the first. A null text is an empty one. Spark deals
    the keys to ``ranges`` ranges of that order (as many as the session's shuffle
    partitions, if not given); what the driver learns is the first key of each. A
    range is read in order as a stream, and ends with a copy of the row that begins the
    next range, so texts are shuffled once and one text is held at a time. Only rows
    equal in both id and text are sure to share a range. Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Other
    columns are ignored; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    short_batches(spark)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    key = F.struct(F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.xxhash64("text").alias("tie"))
    keyed = texts.withColumn("key", key)
    listed = _heads(keyed.select("key"), ranges)
    found = listed.count('"tie"')
    heads = F.from_json(F.lit(listed), _KEY)
    # Two steps of about sqrt(ranges) each: whole blocks of heads at or above the key, then single ones.
    width = max(1, math.isqrt(found))
    reached = lambda part: F.size(F.filter(part, lambda h: h >= F.col("key")))
    lasts = F.filter(heads, lambda h, i: i % width == width - 1)
    placed = keyed.withColumn("block", reached(lasts)).withColumn(
        "range", F.col("block") * width + reached(F.slice(heads, F.col("block") * width + 1, F.lit(width))) - 1
    )
    into = F.pmod(F.col("range") - 1, F.lit(max(1, found)))
    begins = placed.where(F.col("key") == F.get(heads, F.col("range")))
    copies = begins.select(into.alias("range"), F.lit(True).alias("extra"), "key", "doc_id", "text").dropDuplicates(["range"])
    dealt = placed.select("range", F.lit(False).alias("extra"), "key", "doc_id", "text").unionByName(copies)
    read = dealt.repartitionById(max(1, found), F.col("range")).sortWithinPartitions("range", "extra", F.col("key").desc())
    return read.select("doc_id", "extra", "text").mapInArrow(_compared(how), ", ".join(f"{f.name} {_SQL[f.type]}" for f in _OUT))


_SQL = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}


@query("op10_content_chunks")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document, of its edit, and the likeness to the edit and the next document."""
    return compare_with_next(table(spark, sf_dir, "documents"))
