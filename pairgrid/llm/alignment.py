"""How the tokens of two tokenizers lie on one another across a corpus.

A text is encoded by a byte-level tokenizer A and a SentencePiece tokenizer B, which puts
a space before it; A is given that space. Byte offsets at which tokens of both end cut
the tokens into groups. In a one-to-one group both tokens have the same bytes, so an
array over A's ids that names B's id with the same bytes (the identity map) tells the
pair from A's id alone: such groups are counted in vectors as long as A's vocabulary.
Only links of irregular groups are summed by pair in a shuffle.

A link's count is then looked up in two tiers. Pairs that hold at least a ``table``-th
of all links are at most ``table`` many, so they are broadcast, and with them every pair
that could be hot; rarer ones are joined by pair.

Both tokenizers cut at a single space between two other characters (B has no piece with
a space behind another character), so long texts are encoded in stretches between such
spaces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairgrid.llm.common import PLAIN, _byte_letters, free_buffers, query, short_batches, table, whole_text, worker_store
from pairgrid.session import staged

_BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")
#: A longer text is encoded in stretches of about so many characters.
_STRETCH = 1 << 16


def token_bytes(tokenizer_json: str) -> list[bytes]:
    """Bytes of each id of a byte-level tokenizer."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(tokenizer_json)
    back = {letter: byte for byte, letter in _byte_letters().items()}
    vocabulary = tok.get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, k in vocabulary.items():
        out[k] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
    return out


def piece_bytes(model: bytes) -> list[bytes]:
    """Bytes of each id of a SentencePiece model."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = [sp.id_to_piece(k) for k in range(sp.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if sp.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]


def identity_map(a_bytes: list[bytes], b_bytes: list[bytes], b_special: set[int]) -> np.ndarray:
    """For each A id the B id with the same bytes, or -1. Of several the largest, which is a piece and not a byte."""
    named = {x: k for k, x in enumerate(b_bytes) if x and k not in b_special}
    return np.array([named.get(x, -1) if x else -1 for x in a_bytes], dtype=np.int64)


#: The pattern of pre-tokens that byte-level tokenizers of this kind share.
_PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteLevel:
    """Ids of a byte-level tokenizer, special strings taken as text.

    Where merges rank as the ids they make, ids are ranks, and the ranks library encodes
    the same several times faster. Characters whose classes may differ between libraries
    are left to the tokenizer itself.
    """

    def __init__(self, tokenizer_json: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(tokenizer_json)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.tok.encode_special_tokens = True
        spec = json.loads(tokenizer_json)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        made = [vocabulary["".join(x.split(" ") if isinstance(x, str) else x)] for x in merges]
        self.ranked = None
        if made == sorted(made) and spec["normalizer"] is None and spec["pre_tokenizer"]["type"] == "ByteLevel":
            back = {letter: byte for byte, letter in _byte_letters().items()}
            ranks = {bytes(back[c] for c in t): k for t, k in vocabulary.items() if all(c in back for c in t)}
            single = [k for t, k in ranks.items() if len(t) == 1]
            if len(ranks) == len(made) + 256 and max(single) < made[0]:
                self.ranked = tiktoken.Encoding("ranked", pat_str=_PRETOKEN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.ranked is not None and PLAIN.fullmatch(text):
            return self.ranked.encode_ordinary(text)
        return self.tok.encode(text, add_special_tokens=False).ids


class Aligner:
    """Tokens of a text by both tokenizers, aligned by their byte ends.

    A link's code is ``a * len(b_bytes) + b``.
    """

    def __init__(self, tokenizer_json: str, model: bytes):
        import sentencepiece

        self.a = ByteLevel(tokenizer_json)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.a_bytes, self.b_bytes = token_bytes(tokenizer_json), piece_bytes(model)
        special = {k for k in range(len(self.b_bytes)) if self.b.is_control(k) or self.b.is_unknown(k)}
        self.same = identity_map(self.a_bytes, self.b_bytes, special)
        self.a_size, self.b_size = (np.array([len(x) for x in y], dtype=np.int64) for y in (self.a_bytes, self.b_bytes))
        # An id within a group and at the end of one.
        self.a_shown = np.array([f"{k}{mark}" for k in range(len(self.a_bytes)) for mark in ",|"], dtype=object)
        self.b_shown = np.array([f"{k}{mark}" for k in range(len(self.b_bytes)) for mark in ",;"], dtype=object)

    def stretch(self, body: str) -> tuple | None:
        """n_a, n_b, n_groups, groups as text, A ids of exact groups, codes of other links; None where bytes differ."""
        a = np.array(self.a.ids(" " + body), dtype=np.int64)
        b = self.b.encode(body, num_threads=1)
        whole = (" " + body).encode()
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != whole or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
            return None
        b = np.array(b, dtype=np.int64)
        ends_a, ends_b = np.zeros(len(whole) + 1, dtype=bool), np.zeros(len(whole) + 1, dtype=bool)
        ends_a[np.cumsum(self.a_size[a])], ends_b[np.cumsum(self.b_size[b])] = True, True
        # What lies between two neighbouring ends, of whichever tokenizer, is one link.
        ends = np.flatnonzero(ends_a | ends_b)
        of_a, of_b = ends_a[ends], ends_b[ends]
        cut = of_a & of_b
        link_a, link_b, group = (np.cumsum(x) - x for x in (of_a, of_b, cut))
        code_a, code_b = a[link_a], b[link_b]
        exact = cut & np.append(True, cut[:-1]) & (self.same[code_a] == code_b)
        # Shown group by group: a group's A ids go behind all B ids of the groups before it.
        group_a, group_b, stop_a, stop_b = group[of_a], group[of_b], link_a[cut] + 1, link_b[cut] + 1
        out = np.empty(len(a) + len(b), dtype=object)
        out[np.arange(len(a)) + np.append(0, stop_b[:-1])[group_a]] = self.a_shown[2 * a + cut[of_a]]
        out[np.arange(len(b)) + stop_a[group_b]] = self.b_shown[2 * b + cut[of_b]]
        return len(a), len(b), len(stop_a), "".join(out.tolist())[:-1], code_a[exact], code_a[~exact] * len(self.b_bytes) + code_b[~exact]

    def of(self, text: str) -> tuple:
        """n_a, n_b, n_groups, n_links, digest, and exact ids and other codes with how often each occurs, as bytes."""
        nothing = (0, 0, 0, 0, "", b"", b"", b"", b"")
        totals, digest, exact, links, begin = [0, 0, 0], hashlib.sha256(), [], [], 0
        while begin < len(text):
            cut = _BETWEEN_WORDS.search(text, begin + _STRETCH)
            found = self.stretch(text[begin : cut.start() if cut else len(text)])
            if found is None:
                return nothing
            totals = [x + y for x, y in zip(totals, found)]
            digest.update(((";" if begin else "") + found[3]).encode())
            exact.append(found[4])
            links.append(found[5])
            begin = cut.end() if cut else len(text)
        if not text:
            return nothing
        ids, n = np.unique(np.concatenate(exact), return_counts=True)
        codes, m = np.unique(np.concatenate(links), return_counts=True)
        counted = (ids.astype("<u4"), n.astype("<u4"), codes.astype("<u8"), m.astype("<u4"))
        return (*totals, int(n.sum() + m.sum()), digest.hexdigest(), *(x.tobytes() for x in counted))


_ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, ids binary, ids_n binary, codes binary, codes_n binary"
_COUNTS = [pa.int64()] * 6 + [pa.string()] + [pa.binary()] * 4


def aligned_texts(docs: DataFrame, a_file: str, b_file: str, doc_id: str, text: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast((Path(a_file).read_text(), Path(b_file).read_bytes()))
    key = f"align:{a_file}:{b_file}"
    names = [c.split()[0] for c in _ALIGNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        store = worker_store("tokens")
        if key not in store:
            store[key] = Aligner(*sent.value)
        of = store[key].of
        for batch in batches:
            rows = [(r, i, *of(x.as_py())) for r, i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2))]
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _COUNTS)], names=names)
        free_buffers()

    short_batches(docs.sparkSession, 500)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    return rows.mapInArrow(run, _ALIGNED)


def _numbers(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a binary column, and how many each row has."""
    cells = [x.as_py() for x in column]
    width = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(cells), kind), np.array([len(c) // width for c in cells], dtype=np.int64)


def _summed(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(codes, return_inverse=True)
    total = np.zeros(len(found), dtype=np.int64)
    np.add.at(total, at, n)
    return found, total


def link_counts(aligned: DataFrame, same: np.ndarray, wide: int, held: int = 1 << 20) -> DataFrame:
    """code and n of every linked pair of ids in the corpus.

    A task adds exact groups to one vector over A's ids and sums other links in pieces
    of bounded size before they are shuffled.
    """
    sent = aligned.sparkSession.sparkContext.broadcast(same)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identity = sent.value
        vector = np.zeros(len(identity), dtype=np.int64)
        codes, n, waiting = np.empty(0, np.int64), np.empty(0, np.int64), []
        for batch in batches:
            ids, _ = _numbers(batch.column(0), "<u4")
            np.add.at(vector, ids, _numbers(batch.column(1), "<u4")[0].astype(np.int64))
            waiting.append((_numbers(batch.column(2), "<u8")[0].astype(np.int64), _numbers(batch.column(3), "<u4")[0].astype(np.int64)))
            if sum(len(x) for x, _ in waiting) > held:
                codes, n = _summed(np.concatenate([codes, *(x for x, _ in waiting)]), np.concatenate([n, *(y for _, y in waiting)]))
                waiting = []
                if len(codes) > held:
                    yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["code", "n"])
                    codes, n = np.empty(0, np.int64), np.empty(0, np.int64)
        codes, n = _summed(np.concatenate([codes, *(x for x, _ in waiting)]), np.concatenate([n, *(y for _, y in waiting)]))
        used = np.flatnonzero(vector)
        codes, n = np.concatenate([codes, used * wide + identity[used]]), np.concatenate([n, vector[used]])
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["code", "n"])
        free_buffers()

    parts = aligned.select("ids", "ids_n", "codes", "codes_n").mapInArrow(run, "code long, n long")
    return parts.groupBy("code").agg(F.sum("n").alias("n"))


_SCORED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, rare array<struct<code:long,m:long>>"
_RARE = pa.list_(pa.struct([("code", pa.int64()), ("m", pa.int64())]))


def _looked_up(sent, wide: int):
    """Sums of links whose pair the broadcast tables hold; the others are handed on as ``rare``."""

    def per_row(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        running = np.concatenate([[0], np.cumsum(values)])
        ends = np.cumsum(sizes)
        return running[ends] - running[ends - sizes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identity, exact_n, best, head, head_n = sent.value
        for batch in batches:
            ids, sizes = _numbers(batch.column("ids"), "<u4")
            m = _numbers(batch.column("ids_n"), "<u4")[0].astype(np.int64)
            n = exact_n[ids]
            count = per_row(n * m, sizes)
            top = per_row(m * (n == best[identity[ids]]), sizes)
            codes, sizes = _numbers(batch.column("codes"), "<u8")
            codes, m = codes.astype(np.int64), _numbers(batch.column("codes_n"), "<u4")[0].astype(np.int64)
            at = np.minimum(np.searchsorted(head, codes), max(len(head) - 1, 0))
            known = head[at] == codes if len(head) else np.zeros(len(codes), dtype=bool)
            n = head_n[at] * known if len(head) else np.zeros(len(codes), dtype=np.int64)
            count += per_row(n * m, sizes)
            top += per_row(m * (known & (n == best[codes % wide])), sizes)
            offsets = np.concatenate([[0], np.cumsum(per_row((~known).astype(np.int64), sizes))]).astype(np.int32)
            rare = pa.StructArray.from_arrays([pa.array(codes[~known]), pa.array(m[~known])], names=["code", "m"])
            same = [batch.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            columns = [*same, pa.array(top), pa.array(count), pa.ListArray.from_arrays(pa.array(offsets), rare)]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _SCORED.split(", ")])
        free_buffers()

    return run


def align(
    docs: DataFrame,
    a_file: str,
    b_file: str,
    doc_id: str = "doc_id",
    text: str = "text",
    table_pairs: int = 1 << 18,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each text.

    ``a_file`` is a byte-level tokenizer of the tokenizers library and ``b_file`` a
    SentencePiece model. n_links are pairs of token occurrences whose bytes overlap;
    count_sum adds for each link how many links of the corpus link its two ids, and
    n_best are links whose count is the highest of their B id, ties included. Null and
    empty texts, and texts that either tokenizer does not give back byte for byte, have
    zeros and an empty groups_sha256. Repeated rows and null or equal ids are documents
    of their own; other columns are ignored; an empty table gives an empty table.
    ``table_pairs`` bounds the broadcast pairs and changes no result.
    """
    import sentencepiece

    spark = docs.sparkSession
    model = Path(b_file).read_bytes()
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    b_bytes = piece_bytes(model)
    special = {k for k in range(len(b_bytes)) if sp.is_control(k) or sp.is_unknown(k)}
    same, wide = identity_map(token_bytes(Path(a_file).read_text()), b_bytes, special), len(b_bytes)

    aligned = staged(aligned_texts(docs, a_file, b_file, doc_id, text), "aligned")
    totals = staged(link_counts(aligned, same, wide), "link-counts")
    by_b = totals.groupBy((F.col("code") % wide).alias("b")).agg(F.max("n").alias("best"))
    highest = by_b.toArrow()  # at most B's vocabulary
    best = np.zeros(wide, dtype=np.int64)
    best[highest["b"].to_numpy()] = highest["best"].to_numpy()

    used = np.flatnonzero(same >= 0)
    identity = spark.createDataFrame(pa.table({"code": used * wide + same[used]}))
    exact = totals.join(F.broadcast(identity), "code").toArrow()  # at most A's vocabulary
    exact_n = np.zeros(len(same), dtype=np.int64)
    exact_n[exact["code"].to_numpy() // wide] = exact["n"].to_numpy()

    links = totals.agg(F.sum("n")).first()[0] or 0
    # Pairs with at least a ``table_pairs``-th of all links are at most ``table_pairs`` many.
    head = totals.where(F.col("n") >= -(-links // table_pairs)).orderBy("code").toArrow()
    tables = (same, exact_n, best, head["code"].to_numpy(), head["n"].to_numpy())
    scored = staged(aligned.mapInArrow(_looked_up(spark.sparkContext.broadcast(tables), wide), _SCORED), "scored")

    flagged = totals.withColumn("b", F.col("code") % wide).join(F.broadcast(by_b), "b").select("code", "n", (F.col("n") == F.col("best")).alias("top"))
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.code", "r.m").join(flagged, "code")
    more = rare.groupBy("row").agg(F.sum(F.col("n") * F.col("m")).alias("count"), F.sum(F.when(F.col("top"), F.col("m")).otherwise(0)).alias("best"))
    return scored.join(more, "row", "left").select(
        *("doc_id", "n_a", "n_b", "n_groups", "n_links"),
        (F.col("n_best") + F.coalesce("best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("count", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )


@query("op12_cross_tokenizer_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of every whole document between the byte-level and the SentencePiece tokenizer."""
    import public_tokenizers as files

    return align(table(spark, sf_dir, "documents"), files.path("byte_bpe_50k.json"), files.path("piece_bpe_32k.model"))
