"""Token counts by a two-tier lookup on the map side.

Tier one is a compact table of the pre-tokens that the tokenizer's own vocabulary
spells in full (its most frequent words), with the number of tokens of each. It is
made once on the driver and broadcast; the vocabulary bounds its size. Tier two is a
cache in each Python worker: a pre-token that tier one lacks is encoded once and
remembered. Rows never move, so no key can be hot, and a lost executor costs its
own tasks only.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairgrid.llm.common import PLAIN, EncodingCache, PretokenEncoder, free_buffers, query, short_batches, table, whole_text, worker_store

#: Python's ``str.split`` takes these for white space and the tokenizer doesn't.
_NOT_SPACE = "\x1c\x1d\x1e\x1f"


def frequent_pretokens(tokenizer_json: str) -> bytes:
    """Words that the vocabulary holds whole with their token counts, in one block.

    One word a line, then a tab and the count. At most one line a vocabulary entry.
    """
    import json

    from tokenizers import Tokenizer

    model = json.loads(tokenizer_json)["model"]
    suffix = model.get("end_of_word_suffix") or ""
    tok = Tokenizer.from_str(tokenizer_json)
    words = sorted({w[: len(w) - len(suffix)] for w in model["vocab"] if suffix and w.endswith(suffix)})
    words = [w for w in words if w.isascii() and w.isalnum()]
    encoded = tok.encode_batch(words, add_special_tokens=False)
    return "\n".join(f"{w}\t{len(e.ids)}" for w, e in zip(words, encoded)).encode()


class _Counter:
    """Counts the tokens of a text: tier one, then the worker's caches, then the model.

    The worker remembers both runs between white space and the pre-tokens they consist of.
    """

    def __init__(self, tokenizer_json: str, frequent: bytes, pattern: str, limit: int):
        import regex
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(tokenizer_json)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.split = regex.compile(pattern).findall
        self.model = PretokenEncoder(self.tok.model)
        lines = (line.rsplit("\t", 1) for line in frequent.decode().split("\n") if line)
        self.frequent = {w: int(n) for w, n in lines}
        self.pretokens = EncodingCache(lambda x: len(self.model.tokens(x)), limit)
        self.runs = EncodingCache(self.second_tier, 2 * limit)

    def whole(self, text: str) -> int:
        return len(self.tok.encode(text, add_special_tokens=False).ids)

    def second_tier(self, run: str) -> int:
        found = self.frequent.get(run)
        if found is not None:
            return found
        if not PLAIN.fullmatch(run) or any(s in run for s in self.special):
            return self.whole(run)
        low = run.lower()
        if low.isalpha():
            return self.pretokens[low]
        return sum(map(self.pretokens.__getitem__, self.split(low)))

    def count(self, text: str) -> int:
        if any(c in text for c in _NOT_SPACE):
            return self.whole(text)
        return sum(map(self.runs.__getitem__, text.split()))


def count_tokens(
    docs: DataFrame,
    tokenizer_file: str,
    text: str = "text",
    out: str = "n_tokens",
    cache_entries: int = 100_000,
) -> DataFrame:
    """``docs`` with the number of tokens of each whole text in column ``out``.

    The tokenizer must drop white space when it splits, as its pre-tokens are then the
    runs between white space, whatever stands around them (others raise). Special
    strings inside a text count as the library counts them by default. Null and empty
    texts have 0 tokens. All other columns stay; a column named ``out`` is replaced.
    ``cache_entries`` bounds a generation of the worker's cache and has no effect on
    the result. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    spec = Path(tokenizer_file).read_text()
    pattern = _split_pattern(spec)
    sent = spark.sparkContext.broadcast((spec, frequent_pretokens(spec), pattern))
    key = f"count:{hash(spec)}:{cache_entries}"

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        store = worker_store("tokens")
        if key not in store:
            store[key] = _Counter(*sent.value, cache_entries)
        count = store[key].count
        for texts in batches:
            yield pd.Series([count(x) for x in texts], dtype="int64")
        free_buffers()

    short_batches(spark)
    return docs.withColumn(out, counted(whole_text(text)))


def _split_pattern(spec: str) -> str:
    """The pattern of the tokenizer's pre-tokens; raises unless white space only parts them."""
    import json

    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(spec)
    ids = [tok.encode(x, add_special_tokens=False).ids for x in ("Ab cd", "ab  \n cd", "ab", "cd")]
    steps = json.loads(spec)["pre_tokenizer"].get("pretokenizers", [])
    patterns = [x["pattern"]["Regex"] for x in steps if x["type"] == "Split" and x["invert"] and x["behavior"] == "Removed"]
    if not ids[0] == ids[1] == ids[2] + ids[3] or len(patterns) != 1 or steps[-1]["type"] != "ByteLevel":
        raise ValueError("needs a lower-casing byte-level tokenizer whose pattern of pre-tokens leaves white space out")
    return patterns[0]


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", whole_text().alias("text"))
    counted = count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 2048).alias("over_limit"),
    )
