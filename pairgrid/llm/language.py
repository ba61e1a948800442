"""Language identification by bit-sliced Bloom filters of letter n-grams.

Every slot of one table holds a word with a bit for each language. A language's n-grams
set its bit in the slots that their hashes name, so one look-up (the AND of the slots'
words) returns all languages whose filter contains an n-gram. A text's hits are counted
for each language, corrected for the filter's rate of false positives, and the language
with the largest corrected share decides.

Training counts n-grams in parts and sums them in Spark. Only the finished table comes
to the driver and is broadcast; its size is ``slots`` words whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairgrid.llm.common import CodeCounts, free_buffers, query, short_batches, table, unused, whole_text, worker_store
from pairgrid.session import staged

#: Characters of a long text that are turned to n-grams at a time.
_STRETCH = 1 << 18


def _letters() -> np.ndarray:
    """For each code point: is it a letter?"""
    store = worker_store("language")
    if "letters" not in store:
        store["letters"] = np.array([chr(c).isalpha() for c in range(0x110000)])
    return store["letters"]


def ngrams(text: str) -> np.ndarray:
    """Codes of the letter trigrams of a text, small letters, words padded by one space.

    Three code points of 21 bits each make a code. Runs of characters other than
    letters count as one space.
    """
    is_letter, out, tail = _letters(), [], np.array([32], dtype=np.uint32)
    low = text.lower()
    for k in range(0, len(low), _STRETCH):
        points = np.frombuffer(low[k : k + _STRETCH].encode("utf-32-le"), dtype="<u4")
        points = np.concatenate([tail, np.where(is_letter[points], points, 32)])
        keep = np.ones(len(points), dtype=bool)
        keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
        points = points[keep]
        out.append(points)
        tail = points[-1:]
    joined = [out[0]] + [p[1:] for p in out[1:]] if out else []
    p = np.concatenate([*joined, np.array([32], dtype=np.uint32)]).astype(np.int64) if out else np.empty(0, dtype=np.int64)
    if len(p) > 1 and p[-2] == 32:
        p = p[:-1]
    codes = p[:-2] << 42 | p[1:-1] << 21 | p[2:] if len(p) > 2 else np.empty(0, dtype=np.int64)
    return codes


def slots_of(codes: np.ndarray, hashes: int, slots: int) -> np.ndarray:
    """hashes x len(codes) slot numbers by double hashing; ``slots`` is a power of two."""
    x = codes.astype(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    first, step = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
    return np.stack([((first + np.uint64(k) * step) & np.uint64(slots - 1)).astype(np.int64) for k in range(hashes)])


@dataclass
class Filters:
    """languages in order; words[plane][slot] with a bit for each of 64 languages; false positive rates."""

    languages: list[str]
    words: np.ndarray
    rates: np.ndarray
    hashes: int

    def predict(self, text: str) -> tuple[str, float]:
        """Language and score. ``und`` and 0 without letters or without languages.

        The score is the winner's corrected share of hits over the sum of all
        languages' shares. Equal shares go to the first language in order.
        """
        return self.judge(text)[:2]

    def judge(self, text: str) -> tuple[str, float, float]:
        """Language, score and the winner's own corrected hits an n-gram, which no other language changes."""
        codes = ngrams(text)
        if not len(codes) or not self.languages:
            return "und", 0.0, 0.0
        hits = np.zeros(len(self.languages))
        for begin in range(0, len(codes), _STRETCH):
            at = slots_of(codes[begin : begin + _STRETCH], self.hashes, self.words.shape[1])
            for plane, words in enumerate(self.words):
                found = words[at[0]]
                for row in at[1:]:
                    found &= words[row]
                for k in range(64 * plane, min(64 * plane + 64, len(hits))):
                    hits[k] += np.count_nonzero(found & np.uint64(1 << (k % 64)))
        share = np.maximum((hits / len(codes) - self.rates) / np.maximum(1 - self.rates, 1e-9), 0)
        if not share.any():
            return self.languages[int(np.argmax(hits))], 0.0, 0.0
        best = int(np.argmax(share))
        return self.languages[best], float(share[best] / share.sum()), float(share[best])


def _handed_on(by: dict[str, CodeCounts]) -> Iterator[pa.RecordBatch]:
    for lang, counts in by.items():
        counts.sum_up()
        columns = [pa.array([lang] * len(counts.codes), pa.string()), pa.array(counts.codes), pa.array(counts.n)]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "code", "n"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, code, n) of a task's rows; handed on early where there are very many different codes."""
    by: dict[str, CodeCounts] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            by.setdefault(lang, CodeCounts(1 << 18)).add(ngrams(text.as_py()))
        if sum(len(c.codes) for c in by.values()) > 1 << 21:
            yield from _handed_on(by)
            by = {}
    yield from _handed_on(by)
    free_buffers()


def train(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    rows_per_language: int = 20_000,
    near_best: float = 0.2,
    least: int = 2,
    least_share: float = 0.0,
    slots: int = 1 << 20,
    hashes: int = 3,
) -> Filters:
    """Filters for the languages of ``docs``; rows with a null language or text are left out.

    A language with more than ``rows_per_language`` rows gives about that many, by a
    hash of the id and text: the one bound on what training reads. An n-gram belongs to
    the languages in which it is seen ``least`` times, makes up ``least_share`` of all
    n-grams and has a relative frequency of at least ``near_best`` of that in the language
    where it is most frequent. A share keeps out what a few texts with wrong labels bring.
    """
    short_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    part = F.least(F.lit(1.0), rows_per_language / F.count("*"))
    kept = rows.groupBy("lang").agg(part.alias("part"))
    languages = sorted(r["lang"] for r in kept.collect())  # one row a language
    if not languages:
        return Filters([], np.zeros((1, slots), dtype=np.uint64), np.zeros(0), hashes)
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.join(F.broadcast(kept), "lang").where(place < F.col("part")).select("lang", "text")
    counts = sample.mapInArrow(_counted, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    counts = staged(counts, "ngrams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = counts.join(F.broadcast(totals), "lang").withColumn("share", F.col("n") / F.col("total"))
    best = shares.groupBy("code").agg(F.max("share").alias("best"))
    number = F.array_position(F.array([F.lit(x) for x in languages]), F.col("lang")) - 1
    members = shares.join(best, "code").where((F.col("n") >= least) & (F.col("share") >= least_share) & (F.col("share") >= near_best * F.col("best")))
    placed = members.select("code", number.cast("int").alias("number"))

    def slot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = slots_of(batch.column(0).to_numpy(), hashes, slots)
            numbers = np.tile(batch.column(1).to_numpy(), hashes)
            yield pa.RecordBatch.from_arrays([pa.array(at.ravel()), pa.array(numbers)], names=["slot", "number"])

    bit = F.expr("shiftleft(1L, number % 64)")
    words = (
        placed.mapInArrow(slot_rows, "slot long, number int")
        .groupBy((F.col("number") / 64).cast("int").alias("plane"), "slot")
        .agg(F.bit_or(bit).alias("word"))
    )
    found = words.toArrow()  # at most ``slots`` rows a plane
    filled = np.zeros((-(-len(languages) // 64), slots), dtype=np.uint64)
    filled[found["plane"].to_numpy(), found["slot"].to_numpy()] = found["word"].to_numpy().astype(np.uint64)
    load = [np.count_nonzero(filled[k // 64] & np.uint64(1 << (k % 64))) / slots for k in range(len(languages))]
    return Filters(languages, filled, np.array(load) ** hashes, hashes)


def identify(
    docs: DataFrame, filters: Filters, text: str = "text", pred: str = "lang_pred", score: str = "score", hits: str | None = None
) -> DataFrame:
    """``docs`` with predicted language and score of each whole text, and where ``hits`` names a column the winner's hits an n-gram.

    Null texts and texts without a letter are ``und`` with score 0. All other columns
    stay, whatever their names; columns named as the two new ones are replaced.
    """
    short_batches(docs.sparkSession)
    # Plain values: a broadcast isn't read with this package at hand.
    sent = docs.sparkSession.sparkContext.broadcast((filters.languages, filters.words, filters.rates, filters.hashes))

    @F.pandas_udf("lang string, score double, hits double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Filters(*sent.value)
        for texts in batches:
            yield pd.DataFrame([model.judge(x) for x in texts], columns=["lang", "score", "hits"])
        free_buffers()

    # Deterministic and costly: kept as one column, so it runs once a row.
    inner = unused(docs, "predicted")
    both = docs.withColumn(inner, predicted(whole_text(text)))
    named = {pred: F.col(f"{inner}.lang"), score: F.col(f"{inner}.score")} | ({hits: F.col(f"{inner}.hits")} if hits else {})
    return both.withColumns(named).drop(inner)


def floors(found: DataFrame, languages: list[str], part: float, lang: str, pred: str, hits: str) -> dict[str, float]:
    """For each language ``part`` of the median hits an n-gram over the rows that are labelled and taken for it.

    ``found`` is what ``identify`` gives with ``hits``. A language without such rows gets
    the median over all. The median holds though some labels are wrong.
    """
    rows = found.where(F.col(lang) == F.col(pred)).select(F.col(lang).alias("lang"), F.col(hits).alias("hits"))
    median = F.percentile_approx("hits", F.lit(0.5), F.lit(1000)).alias("median")
    medians = rows.cube("lang").agg(median).collect()  # one row a language
    known = {r["lang"]: r["median"] for r in medians if r["median"] is not None}
    return {x: part * known.get(x, known.get(None, 0.0)) for x in languages}


def held_out(doc_id: str = "doc_id") -> Column:
    """Is the row kept from training?"""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    docs = table(spark, sf_dir, "documents")
    filters = train(docs.where(~held_out()))
    found = identify(docs.select("doc_id", "text"), filters)
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
