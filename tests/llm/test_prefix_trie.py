"""The prefix trie against nested dicts, with components split in Spark and in a task."""

import hashlib
import random
import zlib

import pytest

from pairgrid.llm import prefix_trie
from pairgrid.llm.prefix_trie import local_rollup, shared_turns
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string, node string, digest string"


def brute(rows):
    convs = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    again = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        again[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    members = {}
    for c, turns in again.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        ends = ",".join(str(c) for c in sorted(convs) if len(again[c]) == len(node))
        children = {m[: len(node) + 1] for m in below if len(m) > len(node)}
        leaves = sum(not any(len(x) == len(m) + 1 and x[: len(m)] == m for x in below) for m in below)
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m)
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **options):
    turns = prefix_trie.numbered(spark.createDataFrame(rows, SCHEMA))
    again = prefix_trie.rebuilt(turns, shared_turns(), F.col("conv_id") - F.col("conv_id") % 5)
    got = prefix_trie.prefix_trie(again, turns.select("conv_id").distinct(), **options)
    return sorted(map(tuple, got.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


def awkward(seed=1, convs=25):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, 9)):
            rows.append((c, t if rng.random() > 0.1 else None, rng.choice(["user", "assistant", None]), rng.choice(["a", "é", None, "", "b" * 300]), "n", "d"))
    rows += [(10**12, k, "user", "a", "n", "d") for k in range(40)]  # deep
    rows += [(100 + k, 0, "user", "a", "n", "d") for k in range(30)]  # many copies
    rows += [(7777, None, "user", "same", "n", "d")] * 3 + [(None, 1, "user", "lost", "n", "d")]
    return rows


@pytest.mark.parametrize("local_nodes", [20_000, 6])
def test_trie(spark, local_nodes, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_BLOCK", 4)
    monkeypatch.setattr(prefix_trie, "_IDS_A_PIECE", 3)
    rows = awkward()
    assert found(spark, rows, local_nodes=local_nodes) == brute(rows)


def test_empty_and_turnless(spark):
    assert found(spark, [(None, 1, "user", "x", "n", "d")]) == []
    # Conversation 6 has one turn and takes over more of the missing conversation 5.
    lone = next(c for c in range(6, 1000) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(lone, 0, "user", "x", "n", "d")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows)[0][1] == 0


def test_numbers_span_tasks(spark):
    rows = [(3, 0, "user", "same", "n", "d")] * 500 + [(4, k, "user", str(k), "n", "d") for k in range(100)]
    got = prefix_trie.numbered(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()
    assert sorted(r["at"] for r in got if r.conv_id == 3) == list(range(1, 501))
    digest = {str(k): hashlib.sha256(f"4:user{k}".encode()).hexdigest() for k in range(100)}
    assert {r["at"]: r.digest for r in got if r.conv_id == 4} == {k + 1: digest[str(k)] for k in range(100)}


def test_local_rollup_equals_a_walk():
    rng = random.Random(4)
    for n in [1, 2, 3, 50, 400]:
        for shape in ("random", "chain", "star"):
            parent = [-1] + [{"random": rng.randrange(k), "chain": k - 1, "star": 0}[shape] for k in range(1, n)]
            depth = [0] * n
            for k in range(1, n):
                depth[k] = depth[parent[k]] + 1
            order = sorted(range(n), key=lambda k: depth[k])
            place = {k: i for i, k in enumerate(order)}
            parent = [-1 if parent[k] < 0 else place[parent[k]] for k in order]
            value = [rng.randrange(10) for _ in range(n)]
            size, total = [1] * n, list(value)
            for k in range(n - 1, 0, -1):
                size[parent[k]] += size[k]
                total[parent[k]] += total[k]
            assert local_rollup(parent, list(size), [value, size and [1] * n]) == [total, size]
