"""Near copies by exact similarity of five-word runs, against brute force over all pairs."""

import random

import pytest
import xxhash

import corpus_pipeline
from conftest import SF
from pairgrid.llm import near_copies


def runs(text):
    words = text.lower().split()
    return {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def similarity(a, b):
    return len(a & b) / len(a | b)


def roots_of(sets):
    root = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if root[a] != root[b] and similarity(sets[a], sets[b]) >= 0.8:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return root


def corpus(groups, copies, words=80, edits=(1, 2)):
    """Texts with copies of copies in which single words are changed: similarities from about 0.6 up."""
    rng = random.Random(3)
    texts = []
    for _ in range(groups):
        group = [[f"w{rng.randrange(10**6)}" for _ in range(words)]]
        for _ in range(copies):
            copy = list(rng.choice(group))
            for _ in range(rng.choice(edits)):
                copy[rng.randrange(words)] = f"w{rng.randrange(10**6)}"
            group.append(copy)
        texts += [" ".join(g) for g in group]
    return texts


def kept_of(spark, texts, **how):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted(r.doc_id for r in near_copies.one_of_each(docs, **how).collect())


@pytest.mark.parametrize("crowd", [4, 256])
def test_groups_are_those_of_all_pairs(spark, crowd):
    texts = corpus(4, 40)
    want = sorted(set(roots_of([runs(t) for t in texts])))
    assert 4 < len(want) < len(texts) - 4
    assert kept_of(spark, texts, crowd=crowd) == want


def test_stage_links_at_a_similarity_of_80_percent(spark):
    words = [f"w{k}" for k in range(60)]
    near = [*words[:30], "other", *words[31:]]  # 51 of 61 runs
    far = [*words[:20], "one", *words[21:40], "two", *words[41:]]  # 46 of 66 runs
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate([words, near, far])], "doc_id long, text string")
    assert similarity(runs(" ".join(words)), runs(" ".join(near))) >= 0.8 > similarity(runs(" ".join(words)), runs(" ".join(far)))
    kept = dict(corpus_pipeline.STAGES)["near_copies"](spark, docs, SF)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2]


def fingerprint(text):
    hashes = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in runs(text)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_probe_of_fingerprints_finds_near_copies_that_share_no_band(spark, monkeypatch):
    """Bands hold one text each here, so all that is found comes from fingerprints within two bits."""
    monkeypatch.setattr(near_copies, "band_keys", lambda hashes: [int(hashes.sum(dtype="uint64").astype("int64"))] if len(hashes) else [])
    texts = [*corpus(6, 12, words=900, edits=(1,)), "", " "]
    prints, sets = [fingerprint(t) for t in texts], [runs(t) for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    assert all(similarity(sets[k], sets[r]) >= 0.8 for k, r in enumerate(root) if k != r and sets[k])
    want = sorted(set(root))
    assert 6 < len(want) < len(texts) - 6
    assert kept_of(spark, texts) == want
