"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL where there is one."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python at most ``rows`` at a time from now on in this session.

    A text may be long, and Spark's own 10,000 rows of them would fill a worker.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def free_buffers() -> None:
    """Give Arrow's unused memory back at the end of a task; the worker lives on."""
    pa.default_memory_pool().release_unused()


def worker_store(name: str) -> dict:
    """A dict that lives as long as the Python worker, so that its tasks share it.

    Functions of this package travel by value, which gives each task fresh module
    globals; an entry in ``sys.modules`` outlives them.
    """
    key = f"_pairgrid_store_{name}"
    return sys.modules.setdefault(key, types.ModuleType(key)).__dict__.setdefault("store", {})


class EncodingCache(dict):
    """A dict that makes missing values with ``encode`` and keeps two generations.

    When ``limit`` entries are held the present generation becomes the old one, and
    entries of the old one that are met again move on: memory stays bounded at
    ``2 * limit`` entries and what is frequent stays. Keys over ``longest``
    characters are encoded each time.
    """

    def __init__(self, encode: Callable[[str], object], limit: int, longest: int = 48):
        super().__init__()
        self.encode, self.limit, self.longest = encode, limit, longest
        self.old: dict[str, object] = {}

    def __missing__(self, key: str):
        found = self.old.get(key)
        if found is None:
            found = self.encode(key)
            if len(key) > self.longest:
                return found
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class CodeCounts:
    """How often each code was added; at most ``limit`` codes wait to be summed."""

    def __init__(self, limit: int = 1 << 20):
        self.limit, self.held, self.waiting = limit, 0, []
        self.codes, self.n = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def add(self, codes: np.ndarray) -> None:
        self.waiting.append(codes)
        self.held += len(codes)
        if self.held > self.limit:
            self.sum_up()

    def sum_up(self) -> None:
        if self.waiting:
            codes, n = np.unique(np.concatenate(self.waiting), return_counts=True)
            self.codes, at = np.unique(np.concatenate([self.codes, codes]), return_inverse=True)
            total = np.zeros(len(self.codes), dtype=np.int64)
            np.add.at(total, at, np.concatenate([self.n, n]))
            self.n, self.held, self.waiting = total, 0, []


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, others follow from code point 256."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


#: Beyond these characters normalisation and character classes may differ between
#: libraries, so the tokenizer itself sees the text.
PLAIN = re.compile("[\\x00-\u012f\u0131-\u024f]*")


class PretokenEncoder:
    """Token ids of one pre-token straight from a byte-level BPE model, without the pipeline around it."""

    def __init__(self, model):
        self.tokenize, self.letters = model.tokenize, _byte_letters()

    def tokens(self, pretoken: str) -> list:
        if not (pretoken.isascii() and pretoken.isalnum()):
            pretoken = pretoken.encode().decode("latin-1").translate(self.letters)
        return self.tokenize(pretoken)
