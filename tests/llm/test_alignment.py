"""Cross-tokenizer alignment against a plain version that walks tokens one by one."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pairgrid.llm import alignment
from test_operators import TEXTS, docs_of, empty

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain_tokens(text, tok, sp, letters):
    """(start, end, id) of each token of both, or None."""
    if not text:
        return None
    whole, sides = (" " + text).encode(), []
    a = tok.encode(" " + text, add_special_tokens=False)
    in_a = [bytes(letters[c] for c in t) for t in a.tokens]
    b = sp.encode(text)
    in_b = [bytes([int(sp.id_to_piece(k)[3:5], 16)]) if sp.is_byte(k) else sp.id_to_piece(k).replace("▁", " ").encode() for k in b]
    for ids, parts in ((a.ids, in_a), (b, in_b)):
        if b"".join(parts) != whole:
            return None
        at, side = 0, []
        for k, x in zip(ids, parts):
            side.append((at, at + len(x), k))
            at += len(x)
        sides.append(side)
    return sides


def brute(rows):
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    # The byte-level alphabet, from the tokenizer's own single-byte entries: ids 0 to 187 are printable bytes.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in shown}
    letters |= {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in shown)}
    out, count = [], Counter()
    for doc, text in rows:
        sides = plain_tokens(text, tok, sp, letters)
        if sides is None:
            out.append([doc, 0, 0, 0, [], ""])
            continue
        a, b = sides
        cuts = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        by_cut = defaultdict(lambda: ([], []))
        for side, tokens in enumerate(sides):
            for _, end, k in tokens:
                by_cut[next(c for c in cuts if c >= end)][side].append(str(k))
        text_of = ";".join(",".join(x) + "|" + ",".join(y) for _, (x, y) in sorted(by_cut.items()))
        links = [(k, m) for s, e, k in a for t, f, m in b if s < f and t < e]
        count.update(links)
        out.append([doc, len(a), len(b), len(cuts), links, hashlib.sha256(text_of.encode()).hexdigest()])
    best = defaultdict(int)
    for (_, m), n in count.items():
        best[m] = max(best[m], n)
    return sorted(
        (doc, na, nb, g, len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), sha)
        for doc, na, nb, g, links, sha in out
    )


def awkward():
    rng = random.Random(3)
    mixed = ["".join(rng.choice("ab'sé Zº½\n\t\xa0　你<s>|.1 \x1c​\U0001f600▁") for _ in range(rng.randint(1, 25))) for _ in range(60)]
    return [t if t is None or len(t) < 2000 else t[:1500] for t in TEXTS] + mixed + ["aa a", "aaa aa", "<s> <|endoftext|> hi</s>"]


@pytest.mark.parametrize("table_pairs", [1 << 18, 3])
def test_alignment(spark, table_pairs, monkeypatch):
    monkeypatch.setattr(alignment, "_STRETCH", 40)
    texts = awkward()
    got = alignment.align(docs_of(spark, texts), A, B, table_pairs=table_pairs)
    found = sorted(map(tuple, got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()))
    assert found == brute(list(enumerate(texts)))
    assert sum(r[1] == 0 for r in found) > 3


def test_equal_and_null_ids_are_documents_of_their_own(spark):
    got = alignment.align(docs_of(spark, ["one two", "one two", "one"], [None, 5, 5]), A, B)
    rows = sorted(((r.doc_id is None, r.doc_id, r.n_links) for r in got.collect()), key=str)
    assert [r[1] for r in rows] == [5, 5, None]
    assert alignment.align(empty(spark), A, B).count() == 0


def test_one_to_one_groups_never_enter_the_pair_list(spark):
    docs = docs_of(spark, ["the of and in to", "the the"])
    rows = alignment.aligned_texts(docs, A, B, "doc_id", "text").collect()
    assert all(len(r.codes) == 0 and len(r.ids) > 0 for r in rows)


def test_long_text(spark):
    text = "The quick brown foxes aren't overly cautious, naturally. " * 6000
    row = alignment.align(docs_of(spark, [text]), A, B).first()
    tok = Tokenizer.from_file(A)
    assert row.n_a == len(tok.encode(" " + text, add_special_tokens=False).ids)
    assert row.n_links == row.n_a + row.n_b - row.n_groups
    assert alignment.align(docs_of(spark, [text]), A, B).where(F.col("count_sum") > 0).count() == 1
