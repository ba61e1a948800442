"""SimHash fingerprints, and groups of fingerprints within a few bits of each other.

Candidates come from the generalised pigeonhole principle: when the 64 bits are dealt
to m partitions and the partitions' thresholds sum to tau - m + 1, two fingerprints
within tau bits agree within its threshold in at least one partition (a threshold of
-1 leaves a partition out). Correlated bits go to one partition, so that the others
tell documents apart, and dynamic programming over estimated candidate counts picks
the thresholds. Buckets up to a fixed size are probed and verified pair by pair.

A larger bucket would give all pairs of a group of near copies. Its members are linked
through common neighbours instead: fingerprints at most two bits apart share a value
one bit or less from both, and no value has more than 65 such fingerprints. This finds
every link of the bucket's members in rows that grow with their number, so nothing is
capped. It needs tau = 2; for other tau all buckets are probed pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairgrid.llm.common import free_buffers, query, short_batches, table, whole_text
from pairgrid.session import staged

BITS = 64
_BLOCK = 1 << 15


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def simhash(text: str, width: int = 3, seed: int = 42) -> int:
    """Fingerprint of one text as a signed 64-bit number; 0 where it has no word."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words)] if len(words) < width else list(map(b" ".join, zip(*(words[k:] for k in range(width)))))
    digest = partial(xxhash.xxh64_intdigest, seed=seed)
    return majority(np.fromiter(map(digest, runs[k : k + _BLOCK]), dtype="<u8") for k in range(0, len(runs), _BLOCK))


def majority(blocks: Iterable[np.ndarray]) -> int:
    """Signed 64-bit number of the bits that are set in over half of all hashes of the blocks."""
    ones, n = np.zeros(BITS, dtype=np.int64), 0
    for hashes in blocks:
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, sha (a hash of the text) and fp of each row. ASCII capitals count as small letters; null texts have no words."""

    @F.pandas_udf("long")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([simhash(x, width, seed) for x in texts], dtype="int64")
        free_buffers()

    short_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(whole_text(text)).alias("sha"), hashed(whole_text(text)).alias("fp"))


# --- thresholds -----------------------------------------------------------------------


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have bits i and j set, over all rows."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS), dtype=np.int64), 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += np.rint(bits.T @ bits).astype(np.int64)
            n += len(values)
        if n:
            rows = np.arange(BITS, dtype=np.int32)
            columns = [pa.array(rows), pa.array(list(both), pa.list_(pa.int64())), pa.array(np.full(BITS, n))]
            yield pa.RecordBatch.from_arrays(columns, names=["bit", "both", "n"])

    parts = fps.select("fp").mapInArrow(local, "bit int, both array<long>, n long")
    pairs = parts.select("bit", "n", F.posexplode("both").alias("other", "both"))
    # 64 x 64 rows, whatever the input.
    rows = pairs.groupBy("bit", "other").agg(F.sum("both").alias("both"), F.sum("n").alias("n")).collect()
    matrix = np.zeros((BITS, BITS), dtype=np.int64)
    for r in rows:
        matrix[r["bit"], r["other"]] = r["both"]
    return (rows[0]["n"] if rows else 0), matrix


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Deal the bits to partitions of equal width, correlated ones together.

    A partition starts with the free bit of the largest total correlation and takes
    the free bit that is most correlated with its members until it is full.
    """
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        group: list[int] = []
        while len(group) < size:
            among = group or sorted(free)
            best = min(free, key=lambda b: (-float(related[b, among].sum()), b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def allocate(costs: list[list[float]], total: int) -> list[int]:
    """Thresholds of least cost with the given sum. costs[i][t + 1] is partition i's cost at t >= -1."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for s, (c, chosen) in best.items():
            for t in range(-1, len(cost) - 1):
                option = (c + cost[t + 1], [*chosen, t])
                if s + t not in step or option < step[s + t]:
                    step[s + t] = option
        best = step
    return best[total][1]


def _mask(bits: list[int]) -> int:
    return _signed(sum(1 << b for b in bits))


def thresholds(fps: DataFrame, tau: int, parts: int) -> list[tuple[list[int], int]]:
    """Bits and threshold of each partition, from statistics over all fingerprints.

    Pairs that agree in a partition are counted exactly. Pairs that differ in t of its
    bits are estimated by the bits' odds of differing. A row that is sent to a bucket
    costs as much as two candidate pairs.
    """
    n, both = bit_counts(fps)
    groups = group_bits(n, both, parts)
    keys = fps.select(F.posexplode(F.array([F.col("fp").bitwiseAND(F.lit(_mask(g))) for g in groups])).alias("part", "key"))
    sizes = keys.groupBy("part", "key").count().groupBy("part").agg(F.sum(F.col("count") * (F.col("count") - 1) / 2).alias("pairs"))
    same = {r["part"]: float(r["pairs"]) for r in sizes.collect()}  # one row a partition
    p = np.diag(both) / max(n, 1)
    differ = 2 * p * (1 - p)
    odds = differ / (1 - differ)
    costs = []
    for k, group in enumerate(groups):
        ways, sums = [1.0], [1.0] + [0.0] * tau
        for b in group:
            for t in range(tau, 0, -1):
                sums[t] += sums[t - 1] * odds[b]
        for t in range(1, tau + 1):
            ways.append(ways[-1] * (len(group) - t + 1) / t)
        pairs = np.cumsum([(same.get(k, 0.0) + 1) * x for x in sums])
        rows = n * np.cumsum(ways)
        costs.append([0.0] + [float(pairs[t] + 2 * rows[t]) for t in range(tau + 1)])
    return list(zip(groups, allocate(costs, tau - parts + 1)))


# --- links ----------------------------------------------------------------------------


def _within(bits: list[int], threshold: int) -> list[int]:
    """Masks of all sets of at most ``threshold`` of the bits."""
    from itertools import combinations

    return [_mask(list(c)) for t in range(threshold + 1) for c in combinations(bits, t)]


def _flips(value: Column, masks: list[int]) -> Column:
    return F.transform(F.array([F.lit(m) for m in masks]), lambda m: value.bitwiseXOR(m))


def links(fps: DataFrame, tau: int = 2, parts: int = 3, bucket: int = 48) -> DataFrame:
    """Pairs (a, b), a < b, whose closure joins all distinct fingerprints within ``tau`` bits.

    ``fps`` has a column fp without repeats. ``bucket`` is the size up to which a
    bucket's pairs are compared one by one; larger buckets go through common neighbours
    and lose no link.
    """
    chosen = [(bits, t) for bits, t in thresholds(fps, tau, parts) if t >= 0]
    fp = F.col("fp")
    probes = [
        F.transform(_flips(fp.bitwiseAND(F.lit(_mask(bits))), _within(bits, t)), lambda key, k=k: F.struct(F.lit(k).alias("part"), key.alias("key")))
        for k, (bits, t) in enumerate(chosen)
    ]
    rows = fps.select("fp", F.explode(F.concat(*probes)).alias("at")).select("fp", "at.part", "at.key")
    sizes = rows.groupBy("part", "key").agg(F.count("*").alias("size")).where("size > 1")
    members = rows.join(sizes, ["part", "key"])
    limit = bucket if tau == 2 else (1 << 62)
    small = members.where(F.col("size") <= limit).groupBy("part", "key").agg(F.collect_set("fp").alias("fps"))
    pairs = (
        small.select("fps", F.explode("fps").alias("a"))
        .select("a", F.explode(F.filter("fps", lambda b: (b > F.col("a")) & (F.bit_count(b.bitwiseXOR(F.col("a"))) <= tau))).alias("b"))
    )
    if tau != 2:
        return pairs.distinct()
    crowded = members.where(F.col("size") > limit).select("fp").distinct()
    around = crowded.select("fp", F.explode(_flips(fp, _within(list(range(BITS)), 1))).alias("value"))
    shared = around.groupBy("value").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    starred = shared.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a < b")
    return pairs.unionByName(starred).distinct()


def roots(pairs: DataFrame) -> DataFrame:
    """node and the smallest node that can be reached, for every node of a pair.

    Alternates two steps until nothing changes: each node hands its larger neighbours
    to its smallest one, then its smaller neighbours too. Rounds grow with the logarithm
    of the longest chain; each is written, so lineage stays short.
    """

    def state(edges: DataFrame):
        total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        return tuple(edges.agg(F.count("*"), total).first())

    edges = staged(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        edges = staged(small, "edges")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _rooted(fps: DataFrame, tau: int, parts: int, bucket: int) -> DataFrame:
    """fp, root, first_id and keeper of every different fingerprint.

    keeper is the smallest (id is null, id, sha) of the rows with that fingerprint.
    """
    keeper = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sha")).alias("keeper")
    distinct = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"), keeper), "distinct")
    found = roots(links(distinct.select("fp"), tau, parts, bucket))
    return distinct.join(found, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tau: int = 2, parts: int = 3, bucket: int = 48, width: int = 3
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    component_id is the smallest doc_id that links of at most ``tau`` differing bits
    reach, the row itself included; null ids count only where a component has no other.
    Rows without words (null, empty or blank texts) have fingerprint zero and link like
    others. Repeated rows come back as often as they come in; other columns are ignored.
    An empty table gives an empty table.
    """
    fps = staged(fingerprints(docs, doc_id, text, width), "fingerprints")
    rooted = _rooted(fps, tau, parts, bucket)
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = rooted.join(named, "root").select("fp", "component_id")
    shown = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return fps.join(labels, "fp").select("doc_id", shown.alias("fingerprint"), "component_id")


def one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tau: int = 2, parts: int = 3, bucket: int = 48, width: int = 3
) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component stays.

    That is the one with the smallest doc_id; null ids come last, and equal ids go by a
    hash of the text. Of rows with the same id and text one stays. All columns stay.
    """
    fps = staged(fingerprints(docs, doc_id, text, width), "fingerprints")
    best = _rooted(fps, tau, parts, bucket).groupBy("root").agg(F.min("keeper").alias("k")).select("k.doc_id", "k.sha")
    key = lambda who: F.xxhash64(who, F.col("__sha"))
    wanted = best.select("doc_id", F.col("sha").alias("__sha")).withColumn("__key", key(F.col("doc_id"))).select("__sha", "__key")
    keyed = docs.withColumn("__sha", F.xxhash64(whole_text(text))).withColumn("__key", key(F.col(doc_id)))
    kept = keyed.join(wanted, ["__sha", "__key"], "left_semi").dropDuplicates(["__sha", "__key"])
    return kept.drop("__sha", "__key")


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint and component_id of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
