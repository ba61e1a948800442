"""Quality by perplexity under an n-gram model of trusted text.

The model is an interpolated modified Kneser-Ney model of characters, order four. Text
is counted next to the scan and summed by n-gram; lower orders count the different
characters to the left. Probabilities and back-off weights come from joins of the
sharded count tables, order by order.

Scoring. Documents are dealt to blocks of bounded size. A block asks for each different
n-gram that its texts hold, once; the different n-grams of all blocks are joined to the
tables of all orders, and each block gets the log probabilities it asked for. So the
joins move a block's different n-grams, not each document's, no n-gram is hot, and text
is shuffled once (both uses of a block share one exchange).

Thresholds are quantiles of each language over trusted documents that were kept from
training; a document above the quantile of its language is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairgrid.llm.common import CodeCounts, free_buffers, query, short_batches, table, whole_text
from pairgrid.session import staged

ORDER = 4
_BEGIN, _END = 2, 3
_STRETCH = 1 << 18
_MANY = 1 << 21
_MASKS = {4: -1, 3: (1 << 48) - 1, 2: (1 << 32) - 1, 1: (1 << 16) - 1}
#: Kinds of looked-up values: probability of order k is k, back-off weight of order k is 10 + k.
_BACK = 10


def grams(text: str) -> Iterator[np.ndarray]:
    """Codes of the four-grams that end at each character and at the end of a text, in stretches.

    A character is its code point's 16 bits; rarer planes fold into the private-use area.
    """
    tail = np.full(ORDER - 1, _BEGIN, dtype=np.uint64)
    for k in range(0, len(text) + 1, _STRETCH):
        points = np.frombuffer(text[k : k + _STRETCH].encode("utf-32-le"), dtype="<u4").astype(np.uint64)
        points = np.where(points < 0xFF00, points, 0xE000 + points % np.uint64(0x1000))
        last = k + _STRETCH > len(text)
        s = np.concatenate([tail, points, np.full(int(last), _END, dtype=np.uint64)])
        tail = s[len(s) - ORDER + 1 :]
        code = s[:-3] << np.uint64(48) | s[1:-2] << np.uint64(32) | s[2:-1] << np.uint64(16) | s[3:]
        yield code.view(np.int64)


def _home(codes: np.ndarray, bits: int) -> np.ndarray:
    """A place in a table of 2**bits for each code."""
    return ((codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


class Seen:
    """Different codes met so far. A table of recent codes spares most of the sorting."""

    def __init__(self, bits: int = 18):
        self.bits, self.table, self.parts = bits, np.full(1 << bits, -1, dtype=np.int64), []

    def add(self, codes: np.ndarray) -> None:
        at = _home(codes, self.bits)
        fresh = self.table[at] != codes
        if fresh.any():
            self.table[at[fresh]] = codes[fresh]
            self.parts.append(np.unique(codes[fresh]))

    def codes(self) -> np.ndarray:
        return np.unique(np.concatenate(self.parts)) if self.parts else np.empty(0, dtype=np.int64)


class Values:
    """A value for each known code; codes that collide in the table are searched."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        order = np.argsort(codes)
        self.codes, self.values = codes[order], values[order]
        self.bits = max(10, int(2 * max(len(codes), 1)).bit_length())
        self.keys, self.held = np.full(1 << self.bits, -1, dtype=np.int64), np.zeros(1 << self.bits)
        at = _home(self.codes, self.bits)
        self.keys[at], self.held[at] = self.codes, self.values

    def of(self, codes: np.ndarray) -> np.ndarray:
        at = _home(codes, self.bits)
        out = self.held[at]
        rest = np.flatnonzero(self.keys[at] != codes)
        if len(rest):
            out[rest] = self.values[np.searchsorted(self.codes, codes[rest])]
        return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts; they are handed on early where there are very many different codes."""
    counts = CodeCounts()
    for batch in batches:
        for text in batch.column(0):
            for codes in grams(text.as_py()):
                counts.add(codes)
        if len(counts.codes) > _MANY:
            yield _handed_on(counts)
            counts = CodeCounts()
    yield _handed_on(counts)
    free_buffers()


def _handed_on(counts: CodeCounts) -> pa.RecordBatch:
    counts.sum_up()
    return pa.RecordBatch.from_arrays([pa.array(counts.codes), pa.array(counts.n)], names=["code", "n"])


def count_grams(texts: DataFrame, text: str = "text") -> DataFrame:
    """code and n of every four-gram of all texts; null texts have none."""
    some = texts.where(F.col(text).isNotNull()).select(text)
    return some.mapInArrow(_count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _discounts(adjusted: DataFrame) -> list[float]:
    """Discounts for counts 1, 2 and 3 or more, from how many n-grams have counts 1 to 4.

    Where a table is too small for the estimate they are 0.5, 1 and 1.5.
    """
    n1, n2, n3, n4 = (x or 0 for x in adjusted.agg(*[F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]).first())
    if not (n1 and n2 and n3):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.05), k - 0.05) for d, k in zip(raw, (1, 2, 3))]


def _context(code: Column) -> Column:
    return F.shiftrightunsigned(code, 16)


def model_tables(counts: DataFrame) -> tuple[DataFrame, int]:
    """kind, key and value of all orders, and the number of symbols with one for the unknown.

    ``counts`` has code and n of the highest order. Order k's probability is
    (n - D) / total + backoff * (order k - 1), in which n of lower orders counts the
    different characters to the left.
    """
    levels = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        suffix = F.col("code").bitwiseAND(F.lit(_MASKS[k]))
        levels[k] = staged(levels[k + 1].groupBy(suffix.alias("code")).agg(F.count("*").alias("n")), f"order-{k}")
    symbols = levels[1].count() + 1
    below, out = None, []
    for k in range(1, ORDER + 1):
        d = _discounts(levels[k])
        rows = levels[k].withColumn("context", _context(F.col("code")))
        cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        totals = rows.groupBy("context").agg(F.sum("n").alias("total"), F.sum(cut).alias("freed")).select("context", "total", (F.col("freed") / F.col("total")).alias("back"))
        totals = staged(totals, f"contexts-{k}")
        seen = rows.join(totals, "context").withColumn("direct", (F.col("n") - cut) / F.col("total"))
        if below is None:
            seen = seen.withColumn("lower", F.lit(1.0 / symbols))
        else:
            lower = below.select(F.col("code").alias("suffix"), F.col("p").alias("lower"))
            seen = seen.withColumn("suffix", F.col("code").bitwiseAND(F.lit(_MASKS[k - 1]))).join(lower, "suffix")
        below = staged(seen.select("code", (F.col("direct") + F.col("back") * F.col("lower")).alias("p")), f"p-{k}")
        out.append(below.select(F.lit(k).alias("kind"), F.col("code").alias("key"), F.col("p").alias("value")))
        out.append(totals.select(F.lit(_BACK + k).alias("kind"), F.col("context").alias("key"), F.col("back").alias("value")))
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole, symbols


def log_probabilities(codes: DataFrame, tables: DataFrame, symbols: int) -> DataFrame:
    """code and logp of each code: the first order in which it is seen, times the back-off weights above."""
    parts = {k: F.col("code").bitwiseAND(F.lit(_MASKS[k])) for k in range(1, ORDER + 1)}
    wanted = [F.struct(F.lit(k).alias("kind"), part.alias("key")) for k, part in parts.items()]
    wanted += [F.struct(F.lit(_BACK + k).alias("kind"), _context(part).alias("key")) for k, part in parts.items()]
    asked = codes.select("code", F.explode(F.array(*wanted)).alias("w")).select("code", "w.kind", "w.key")
    found = asked.join(tables, ["kind", "key"], "left")
    value = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("value"))).alias(f"v{kind}")
    wide = found.groupBy("code").agg(*[value(k) for k in parts], *[value(_BACK + k) for k in parts])
    p = F.lit(1.0 / symbols)
    for k in parts:
        p = F.coalesce(F.col(f"v{k}"), F.coalesce(F.col(f"v{_BACK + k}"), F.lit(1.0)) * p)
    return wide.select("code", F.log(p).alias("logp"))


def _asked(rows: pa.Table) -> pa.Table:
    seen = Seen()
    for text in rows.column("text"):
        for codes in grams(text.as_py()):
            seen.add(codes)
    codes = seen.codes()
    free_buffers()
    return pa.table({"block": pa.array(np.full(len(codes), rows.column("block")[0].as_py(), dtype=np.int64)), "code": codes})


def _scored(rows: pa.Table, known: pa.Table) -> pa.Table:
    values = Values(known.column("code").to_numpy(), known.column("logp").to_numpy())
    sums, n = [], []
    for text in rows.column("text"):
        parts = [values.of(codes) for codes in grams(text.as_py())]
        sums.append(float(sum(p.sum() for p in parts)))
        n.append(sum(map(len, parts)))
    columns = [rows.column(c) for c in ("doc_id", "lang", "sha")]
    free_buffers()
    return pa.table([*columns, pa.array(sums, pa.float64()), pa.array(n, pa.int64())], names=["doc_id", "lang", "sha", "logp", "n"])


def perplexities(docs: DataFrame, tables: DataFrame, symbols: int, block_chars: int = 16_000_000) -> DataFrame:
    """doc_id, lang, sha (a hash of the text) and perplexity of each row.

    ``docs`` has doc_id, lang and text without nulls. Empty texts have a null
    perplexity. ``block_chars`` is the expected size of a block.
    """
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-size // block_chars))
    sha = F.xxhash64("text")
    dealt = docs.select(F.pmod(F.xxhash64("doc_id", sha), F.lit(blocks)).alias("block"), "doc_id", "lang", sha.alias("sha"), "text")
    grouped = dealt.groupBy("block")
    asked = grouped.applyInArrow(_asked, "block long, code long")
    known = asked.join(log_probabilities(asked.select("code").distinct(), tables, symbols), "code").select("block", "code", "logp")
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = grouped.cogroup(known.groupBy("block")).applyInArrow(_scored, f"doc_id {kind}, lang string, sha long, logp double, n long")
    return scored.select("doc_id", "lang", "sha", F.when(F.col("n") > 1, F.exp(-F.col("logp") / F.col("n"))).alias("perplexity"))


def _quantiles(rows: DataFrame, quantile: float) -> DataFrame:
    """lang and threshold: the least value, in steps of 0.001 of its logarithm, that this part of the rows reaches at most."""
    from pyspark.sql import Window

    step = F.ceil(F.log("perplexity") * 1000).cast("long")
    bins = rows.where(F.col("perplexity").isNotNull()).groupBy("lang", step.alias("step")).agg(F.count("*").alias("n"))
    # Perplexity lies between 1 and the number of symbols, so a language has a bounded number of bins.
    run = Window.partitionBy("lang").orderBy("step")
    up = bins.withColumns({"run": F.sum("n").over(run), "all": F.sum("n").over(Window.partitionBy("lang"))})
    return up.where(F.col("run") >= F.col("all") * quantile).groupBy("lang").agg(F.exp(F.min("step") / 1000.0).alias("threshold"))


def held_back(doc_id: str = "doc_id") -> Column:
    """Trusted rows that set thresholds and are not trained on: one in five, by a hash of the id."""
    return F.pmod(F.xxhash64(F.col(doc_id).cast("string")), F.lit(5)) == 0


def classify(
    docs: DataFrame,
    trusted_ids: DataFrame,
    quantile: float = 0.99,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    small_ids: int = 2_000_000,
    block_chars: int = 16_000_000,
) -> DataFrame:
    """doc_id, lang, sha, perplexity, threshold and keep of every row of ``docs``.

    ``trusted_ids`` has a column doc_id: the documents whose text is trusted. Four in
    five train the model and the others set each language's threshold at ``quantile`` of
    their perplexity; a language without such documents gets the threshold over all
    languages. A null language is its own group. Null and empty texts have a null
    perplexity and are not kept. Where no trusted text exists nothing can be judged:
    every text that isn't empty is kept. Repeated rows are judged each. Trusted ids are
    broadcast up to ``small_ids`` of them, counted first, and joined by shuffle beyond.
    """
    short_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).cast("string").alias("lang"), whole_text(text).alias("text"))
    ids = staged(trusted_ids.select("doc_id").where(F.col("doc_id").isNotNull()).distinct(), "trusted")
    small = ids.count() <= small_ids
    training = ids.where(~held_back())
    trusted = rows.join(F.broadcast(training) if small else training, "doc_id", "left_semi")
    counts = staged(count_grams(trusted), "grams")
    tables, symbols = model_tables(counts)
    scored = staged(perplexities(rows, tables, symbols, block_chars), "scored")
    judges = scored.join(ids.where(held_back()), "doc_id", "left_semi")
    own = _quantiles(judges, quantile).withColumnRenamed("lang", "of")
    overall = _quantiles(judges.withColumn("lang", F.lit("")), quantile).first()
    rest = F.lit(overall["threshold"] if overall else float("inf"))
    out = scored.join(own, F.col("lang").eqNullSafe(F.col("of")), "left").withColumn("threshold", F.coalesce("threshold", rest))
    keep = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False))
    return out.select("doc_id", "lang", "sha", "perplexity", "threshold", keep.alias("keep"))


def keep_good(docs: DataFrame, decisions: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, with all their columns."""
    key = lambda who: F.xxhash64(who, F.col("__sha"))
    kept = decisions.where("keep").select(F.col("sha").alias("__sha"), "doc_id").withColumn("__key", key(F.col("doc_id"))).select("__sha", "__key")
    keyed = docs.withColumn("__sha", F.xxhash64(whole_text(text))).withColumn("__key", key(F.col(doc_id)))
    return keyed.join(kept, ["__sha", "__key"], "left_semi").drop("__sha", "__key")


def trusted_labels(labels: DataFrame) -> DataFrame:
    """Ids with good quality and no toxicity in every label they have."""
    good = F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))
    return labels.groupBy("doc_id").agg(F.min(good).alias("good")).where("good").select("doc_id")


@query("op1_kneser_ney_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lang, perplexity, threshold and keep of every document."""
    trusted = trusted_labels(table(spark, sf_dir, "labels"))
    return classify(table(spark, sf_dir, "documents"), trusted).drop("sha")
