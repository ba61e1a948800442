"""From raw documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept,
and returns a DataFrame that is written as Parquet and read as the next one's docs.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairgrid.llm import language, mixing, near_copies, packing, quality
from pairgrid.llm.common import table, unused
from pairgrid.session import staged

#: A text with fewer hits an n-gram than this part of its language's median isn't in that language.
LEAST_PART = 0.4
#: An n-gram belongs to a language only if it is this part of the language's n-grams or more.
LEAST_SHARE = 1e-5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those whose language's n-grams are rare in them.

    Languages are learned from all documents with a label; wrong labels are outweighed,
    as an n-gram must make up a share of a language. The kept documents' lang is the
    predicted one, whatever it was, so later stages judge by it. Null and empty texts
    have no letter. Repeated rows are judged each; equal scores go to the first language
    by name.
    """
    pred, score, hits = (unused(docs, x) for x in ("lang_pred", "lang_score", "lang_hits"))
    filters = language.train(docs, least_share=LEAST_SHARE)
    found = staged(language.identify(docs, filters, pred=pred, score=score, hits=hits), "languages")
    least = language.floors(found, filters.languages, LEAST_PART, "lang", pred, hits)
    enough = F.lit(False)
    for name, floor in least.items():
        enough = enough | ((F.col(pred) == name) & (F.col(hits) >= floor))
    kept = found.where((F.col(pred) != "und") & (F.col(score) > 0) & enough)
    return kept.select(*(F.col(pred).alias("lang") if c == "lang" else F.col(c) for c in docs.columns))


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose perplexity is above their language's quantile of trusted text."""
    trusted = quality.trusted_labels(table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, quality.classify(docs, trusted))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group whose five-word runs are at least 0.8 alike.

    Candidates are probed by op4's steps and by bands of minimum hashes, and compared exactly.
    """
    return near_copies.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents as their sources' weights ask; one is repeated where its source has more than one epoch."""
    return mixing.mix(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 1024 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("quality", judge_quality),
    ("near_copies", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Tokenizing, n-gram models and Bloom filters are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
