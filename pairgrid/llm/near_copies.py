"""Groups of texts whose word shingles are at least 0.8 alike, verified by exact Jaccard similarity.

Each text is a set of hashed five-word runs. Its SimHash fingerprint goes through op4's
steps (correlated bits grouped, thresholds by dynamic programming, probe and verify), and
texts whose fingerprints are joined by links of at most two bits are one bucket. Sets that are
0.8 alike differ in ten bits or so, for which a probe of 64 bits would read most rows. Texts
that share a band of minimum hashes are therefore a bucket too: 20 bands of 4 leave out a pair
of similarity s with odds (1 - s^4)^20, which is 3 in 100,000 at 0.8. Members of a bucket are
compared by their whole sets; estimates decide nothing.

A bucket over ``crowd`` members is dealt to chunks by a hash. First each chunk is
compared within itself; other bands deal the same texts to other chunks, so a tight group
soon has one root and its buckets are closed. In a bucket that still has several roots,
members outside the most frequent one are then compared with all others, chunk by chunk,
so every pair of different roots is met and no task holds more than two chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairgrid.llm.common import free_buffers, short_batches, whole_text
from pairgrid.llm.simhash import links, majority, roots
from pairgrid.session import staged

WIDTH, LEAST = 5, 0.8
BANDS, ROWS = 20, 4
#: Shingles of a long text that are sketched at a time.
_BLOCK = 1 << 12


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted different hashes of the runs of ``width`` words; one of the whole text where it is shorter."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    runs = [b" ".join(words)] if len(words) < width else map(b" ".join, zip(*(words[k:] for k in range(width))))
    return np.unique(np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=42), runs), dtype=np.uint64))


def band_keys(hashes: np.ndarray) -> list[int]:
    """One signed key for each band of minimum hashes; none for an empty set."""
    import xxhash

    if not len(hashes):
        return []
    rng = np.random.default_rng(7)
    factor = rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)[:, None] << np.uint64(1) | np.uint64(1)
    shift = rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)[:, None]
    least = np.full(BANDS * ROWS, 1 << 32, dtype=np.uint64)
    for k in range(0, len(hashes), _BLOCK):
        least = np.minimum(least, ((hashes[None, k : k + _BLOCK] * factor + shift) >> np.uint64(32)).min(axis=1))
    keys = [xxhash.xxh64_intdigest(row.tobytes(), seed=k) for k, row in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, dtype=np.uint64).view(np.int64).tolist()


def sketches(docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """doc_id, sha (a hash of the text), node (a hash of the shingle set), bands and fp of each row; an empty set has no fp."""

    @F.pandas_udf("node long, bands array<long>, fp long")
    def sketched(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import xxhash

        for texts in batches:
            rows = []
            for x in texts:
                hashes = shingles(x, width)
                node = np.uint64(xxhash.xxh64_intdigest(hashes.tobytes())).astype(np.int64)
                rows.append((node, band_keys(hashes), majority(hashes[k : k + _BLOCK] for k in range(0, len(hashes), _BLOCK))))
            yield pd.DataFrame(rows, columns=["node", "bands", "fp"])
        free_buffers()

    short_batches(docs.sparkSession)
    both = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(whole_text(text)).alias("sha"), sketched(whole_text(text)).alias("s"))
    return both.select("doc_id", "sha", "s.node", "s.bands", F.when(F.size("s.bands") > 0, F.col("s.fp")).alias("fp"))


def _linking(width: int, least: float) -> Callable[[pa.Table], pa.Table]:
    """Links (a, b) that join the members of a unit that are alike and have different roots."""

    def linked(unit: pa.Table) -> pa.Table:
        unit = unit.sort_by([("first", "ascending"), ("node", "ascending")])
        sets = [shingles(x, width) for x in unit.column("text").to_pylist()]
        nodes = unit.column("node").to_numpy()
        root = np.unique(unit.column("root").to_numpy(), return_inverse=True)[1]
        size = np.array([len(x) for x in sets])
        start = np.concatenate([[0], np.cumsum(size)])
        values, ids = np.unique(np.concatenate(sets), return_inverse=True)
        mark, out = np.zeros(len(values), dtype=np.int32), []
        for a in range(len(sets) - 1):
            other = root[a + 1 :] != root[a]
            if not other.any():
                continue
            own = ids[start[a] : start[a + 1]]
            mark[own] = 1
            shared = np.add.reduceat(mark[ids[start[a + 1] :]], start[a + 1 : -1] - start[a + 1])
            mark[own] = 0
            alike = other & (shared >= least * (size[a] + size[a + 1 :] - shared) - 1e-9)
            for b in np.flatnonzero(alike) + a + 1:
                if root[b] != root[a]:
                    root[root == root[b]] = root[a]
                    out.append((nodes[a], nodes[b]))
        pairs = np.array(out, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return linked


def _chunk(count: Column, crowd: int) -> Column:
    return F.pmod(F.xxhash64("node", "key"), F.ceil(count / crowd)).cast("int")


def _compared(units: DataFrame, texts: DataFrame, width: int, least: float) -> DataFrame:
    """Links of units (unit, node, root, first)."""
    rows = units.join(texts, "node").select("unit", "node", "root", "first", "text")
    return rows.groupBy("unit").applyInArrow(_linking(width, least), "a long, b long")


def _texts(docs: DataFrame, reps: DataFrame, doc_id: str, text: str) -> DataFrame:
    """node and text of each of ``reps`` (node, doc_id, sha)."""
    key = F.xxhash64("doc_id", "sha").alias("id_sha")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(whole_text(text)).alias("sha"), whole_text(text).alias("text"))
    found = rows.select("sha", key, "text").join(reps.select("node", "sha", key), ["sha", "id_sha"])
    return found.select("node", "text").dropDuplicates(["node"])


def _probed(distinct: DataFrame) -> DataFrame:
    """node and the key of its bucket, which is a group of fingerprints within op4's two bits."""
    nodes = distinct.where("fp IS NOT NULL").select("node", "fp")
    prints = staged(nodes.select("fp").distinct(), "prints")
    groups = roots(links(prints)).withColumnRenamed("node", "print")
    grouped = nodes.join(groups, F.col("fp") == F.col("print"), "left")
    return grouped.select("node", F.xxhash64(F.lit("prints"), F.coalesce("root", "fp")).alias("key"))


def components(docs: DataFrame, distinct: DataFrame, doc_id: str, text: str, width: int, least: float, crowd: int) -> DataFrame:
    """node and root of all nodes that are linked. ``distinct`` has node, keeper, bands and fp."""
    rows = distinct.select("node", F.explode("bands").alias("key")).unionByName(_probed(distinct))
    marks = (F.count("*").alias("size"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum"), F.min("node").alias("low"), F.max("node").alias("high"))
    buckets = rows.groupBy("key").agg(*marks).where("size > 1")
    # Buckets of the same members stand for one.
    once = buckets.groupBy("size", "sum", "low", "high").agg(F.min("key").alias("key")).select("key", "size")
    members = staged(rows.join(once, "key"), "members")
    reps = distinct.join(members.select("node").distinct(), "node", "left_semi").select("node", "keeper.doc_id", "keeper.sha")
    texts = staged(_texts(docs, reps, doc_id, text), "texts")

    unit = F.xxhash64("key", _chunk(F.col("size"), crowd)).alias("unit")
    within = staged(_compared(members.select(unit, "node", F.col("node").alias("root"), F.lit(0).alias("first")), texts, width, least), "links")
    found = roots(within)

    crowded = members.where(F.col("size") > crowd)
    named = staged(crowded.join(found, "node", "left").withColumn("root", F.coalesce("root", "node")), "crowded")
    parts = named.groupBy("key", "root").agg(F.count("*").alias("n"))
    open_ = parts.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("all"), F.count("*").alias("roots"))
    rest = named.join(open_.where("roots > 1"), "key")
    is_main = F.col("root") == F.col("main")
    outside, inside = F.ceil((F.col("all") - F.col("most")) / crowd), F.ceil(F.col("most") / crowd)
    c = _chunk(F.when(is_main, F.col("most")).otherwise(F.col("all") - F.col("most")), crowd)
    upto = lambda n: F.sequence(F.lit(0), (n - 1).cast("int"))
    with_main = lambda i, j: F.xxhash64("key", F.lit("main"), i, j)
    among = F.transform(F.filter(upto(outside), lambda k: k != F.col("c")), lambda k: F.xxhash64("key", F.lit("rest"), F.least(k, "c"), F.greatest(k, "c")))
    met = F.when(is_main, F.transform(upto(outside), lambda k: with_main(k, F.col("c")))).otherwise(
        F.concat(F.transform(upto(inside), lambda k: with_main(F.col("c"), k)), among)
    )
    units = rest.withColumn("c", c).select(F.explode(met).alias("unit"), "node", "root", F.when(is_main, 1).otherwise(0).alias("first"))
    across = staged(_compared(units, texts, width, least), "links")
    return roots(within.unionByName(across))


def one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, least: float = LEAST, crowd: int = 256
) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each group of near copies stays.

    Documents are linked where their sets of ``width``-word runs have a Jaccard similarity
    of ``least`` or more; ASCII capitals count as small letters. The document with the
    smallest doc_id stays; null ids come last, and equal ids go by a hash of the text. Of
    rows with the same id and text one stays. Texts without words are one group. All
    columns stay.
    """
    seen = staged(sketches(docs, doc_id, text, width), "sketches")
    keeper = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sha")).alias("keeper")
    distinct = staged(seen.groupBy("node").agg(keeper, F.first("bands").alias("bands"), F.first("fp").alias("fp")), "distinct")
    found = components(docs, distinct, doc_id, text, width, least, crowd).withColumnRenamed("node", "linked")
    rooted = distinct.join(found, F.col("node") == F.col("linked"), "left").withColumn("root", F.coalesce("root", "node"))
    best = rooted.groupBy("root").agg(F.min("keeper").alias("k")).select("k.doc_id", "k.sha")
    key = lambda who: F.xxhash64(who, F.col("__sha"))
    wanted = best.select("doc_id", F.col("sha").alias("__sha")).withColumn("__key", key(F.col("doc_id"))).select("__sha", "__key")
    keyed = docs.withColumn("__sha", F.xxhash64(whole_text(text))).withColumn("__key", key(F.col(doc_id)))
    kept = keyed.join(wanted, ["__sha", "__key"], "left_semi").dropDuplicates(["__sha", "__key"])
    return kept.drop("__sha", "__key")
