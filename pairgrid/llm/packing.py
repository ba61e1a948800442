"""Best-fit packing whose partitions carry a certificate.

1. Texts become token ids next to the scan, in one Arrow pass; what leaves is a few
   numbers for each piece. Pieces of full length are sequences of their own.
2. The others go to partitions of bounded size and are packed best-fit decreasing.
   Dual feasible functions give a lower bound on the bins that any packing of the
   partition needs. Where bins equal the bound the partition is proven optimal and
   its bins are final.
3. A partition with a gap keeps its full bins and gives up the pieces of the others;
   pieces given up by several partitions meet in new ones and are packed again. After
   the last round every bin stands as it is.

No partition's result depends on another's, so a lost executor costs a re-run of its
own partitions from the written table.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairgrid.llm.common import PLAIN, EncodingCache, PretokenEncoder, free_buffers, query, short_batches, table, whole_text, worker_store
from pairgrid.session import staged

_BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


#: The pattern of pre-tokens that byte-level tokenizers of this kind share.
_PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class _Ids:
    """Token ids of a text as little-endian unsigned 32-bit numbers.

    A single space between two other characters always begins a pre-token, so the
    parts between such spaces can be encoded apart and remembered. A part with white
    space at an end has no encoding of its own; texts with such parts are split by
    pattern.
    """

    def __init__(self, spec: str, limit: int):
        import regex
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(spec)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.split, self.model = regex.compile(_PRETOKEN).findall, PretokenEncoder(self.tok.model)
        self.coded = [k.to_bytes(4, "little") for k in range(self.tok.get_vocab_size())]
        self.pretokens = EncodingCache(self.pretoken, limit)
        self.later = EncodingCache(self.later_part, 2 * limit)

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def pretoken(self, text: str) -> bytes:
        return b"".join([self.coded[t.id] for t in self.model.tokens(text)])

    def part(self, text: str) -> bytes:
        if not PLAIN.fullmatch(text):
            return self.whole(text)
        if text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
            return self.pretokens[text]
        if text[1:-1].isalpha() and text[0] == " " and text[-1] in ",.;:!?)":
            return self.pretokens[text[:-1]] + self.pretokens[text[-1]]
        return b"".join(map(self.pretokens.__getitem__, self.split(text)))

    def later_part(self, part: str) -> bytes | None:
        if not part or part[0].isspace() or part[-1].isspace():
            return None
        return self.part(" " + part)

    def of(self, text: str) -> bytes:
        if not text or any(s in text for s in self.special):
            return self.whole(text)
        first, *rest = text.split(" ")
        if first and not first[-1].isspace():
            coded = list(map(self.later.__getitem__, rest))
            if None not in coded:
                return self.part(first) + b"".join(coded)
        first, *rest = _BETWEEN_WORDS.split(text)
        return self.part(first) + b"".join([self.part(" " + x) for x in rest])


def token_pieces(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    cache_entries: int = 100_000,
) -> DataFrame:
    """Pieces of each document: doc_id, piece, start, length, ids_crc32.

    A document is its ids and then ``end_id``. One of more than ``capacity`` ids is cut
    so that all pieces but the first are full. A null text is an empty one and gives the
    single id ``end_id``. Rows with equal or null ids are documents of their own.
    """
    sent = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_file).read_text())
    key = f"ids:{tokenizer_file}:{cache_entries}"
    end = np.array([end_id], dtype="<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = worker_store("tokens")
        if key not in store:
            store[key] = _Ids(sent.value, cache_entries)
        encode = store[key].of
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(body.as_py()) + end
                n = len(ids) // 4
                begin, stop, k = 0, n - capacity * ((n - 1) // capacity), 0
                while begin < n:
                    for column, value in zip(rows, (name, k, begin, stop - begin, zlib.crc32(ids[4 * begin : 4 * stop]))):
                        column.append(value)
                    begin, stop, k = stop, stop + capacity, k + 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(v, t) for v, t in zip(rows, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])
        free_buffers()

    short_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text")).mapInArrow(pieces, _PIECES)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of two families of dual feasible functions.

    For a threshold t up to half the capacity, lengths over capacity - t count as whole
    bins, lengths under t as nothing, others as they are. For k, a length x counts as
    floor((k + 1) x / capacity) / k bins unless (k + 1) x is a multiple of the capacity,
    in which case it counts as it is.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    total = count * np.arange(capacity + 1)
    many, amount = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(total)])
    t = np.arange(0, capacity // 2 + 1)
    large = many[-1] - many[capacity - t + 1]
    middle = amount[capacity - t + 1] - amount[t]
    best = int(np.max(large + -(-middle // capacity)))
    x = np.arange(capacity + 1)
    for k in range(1, 21):
        steps = (k + 1) * x
        scaled = np.where(steps % capacity == 0, k * x, steps // capacity * capacity)
        best = max(best, int(-(-int((count * scaled).sum()) // (k * capacity))))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing: the bin of each item, and the room left in each bin.

    Bins with equal room wait in a stack each, and one integer has a bit for every room
    that some bin has, so the tightest fit is the lowest bit from the length upward.
    """
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    present, room = 0, []
    bins = np.empty(len(lengths), dtype=np.int64)
    for item in np.argsort(-lengths, kind="stable"):
        size = int(lengths[item])
        fits = present >> size
        if fits:
            had = size + (fits & -fits).bit_length() - 1
            stack = stacks[had]
            b = stack.pop()
            if not stack:
                present &= ~(1 << had)
        else:
            b, had = len(room), capacity
            room.append(capacity)
        left = had - size
        bins[item], room[b] = b, left
        if left:
            stacks[left].append(b)
            present |= 1 << left
    return bins, np.array(room, dtype=np.int64)


_PACKED = _PIECES + ", bin long, offset long, open boolean, part long"


def _pack_partition(pieces: pa.Table, capacity: int, last: bool) -> pa.Table:
    """Pack one partition; its bins are open where it has a gap and they have room."""
    order = pc.sort_indices(pieces, [(c, "ascending") for c in ("doc_id", "piece", "start", "ids_crc32")])
    pieces = pieces.take(order)
    lengths = pieces.column("length").to_numpy().astype(np.int64)
    bins, room = best_fit(lengths, capacity)
    gap = len(room) - lower_bound(lengths, capacity)
    by_bin = np.argsort(bins, kind="stable")
    ends = np.cumsum(lengths[by_bin])
    starts = ends - lengths[by_bin]
    first = np.concatenate([[True], np.diff(bins[by_bin]) > 0])
    offset = np.empty(len(lengths), dtype=np.int64)
    offset[by_bin] = starts - starts[first][np.cumsum(first) - 1]
    is_open = (room[bins] > 0) & (gap > 0) & (not last)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return pa.table(
        [pieces.column(c) for c in names] + [pa.array(bins), pa.array(offset), pa.array(is_open), pieces.column("part")],
        names=[*names, "bin", "offset", "open", "part"],
    )


def _packer(capacity: int, last: bool) -> Callable[[pa.Table], pa.Table]:
    return lambda group: _pack_partition(group, capacity, last)


def pack(pieces: DataFrame, capacity: int = 1024, partition_pieces: int = 60_000, rounds: int = 3) -> DataFrame:
    """Sequence and offset for every piece of at most ``capacity`` tokens.

    ``partition_pieces`` is the expected number of pieces that one task packs, and
    ``rounds`` the number of packings. Every round deals the pieces of open bins of
    all partitions with a gap anew by a hash of the piece, so partitions exchange
    documents. Equal rows get places of their own. Adds sequence_id and offset.
    """
    full = F.col("length") >= capacity
    done = [
        pieces.where(full).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    ]
    rest = pieces.where(~full)
    for k in range(rounds):
        n = rest.count()
        if not n:
            break
        parts, last = -(-n // partition_pieces), k == rounds - 1
        # Equal rows differ by their place, so a hot id is dealt out too.
        salt = F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id(), F.lit(k))
        dealt = rest.withColumn("part", F.pmod(salt, F.lit(parts)))

        packed = staged(dealt.groupBy("part").applyInArrow(_packer(capacity, last), _PACKED), f"packed-{k}")
        sequence = (F.lit(k).cast("long") * (1 << 56)) + F.col("part") * (1 << 28) + F.col("bin")
        done.append(packed.where(~F.col("open")).withColumn("sequence_id", sequence))
        rest = packed.where("open").select(*pieces.columns)
    columns = [*pieces.columns, "sequence_id", "offset"]
    out = done[0].select(*columns)
    for more in done[1:]:
        out = out.unionByName(more.select(*columns))
    return out


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = 1024, end_id: int = 2, **options: int) -> DataFrame:
    """Tokenize, cut and pack whole documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = staged(token_pieces(docs, tokenizer_file, capacity, end_id), "pieces")
    return pack(pieces, capacity, **options)


@query("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences of at most 1024 tokens."""
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
