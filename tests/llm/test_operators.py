"""Each operator against a plain version of itself, on small tables with awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pairgrid.llm import chat, fingerprints, language, mixing, neighbours, packing, quality, simhash, token_counts, warc

LONG = "the quick of and thing over lazy " * 3000
TEXTS = [
    None, "", " ", "\n\t ", "a", "Hello  world\n\n  indented\ttabs ", "don't WON'T it's <|endoftext|> and <|startoftext|>x",
    "naïve café ²½ İstanbul ΣΣΣ 你好世界 \U0001f600\x1cq", "same text twice over", "same text twice over", LONG, " lead", "trail ", "x" * 5000,
]
SCHEMA = "doc_id long, text string, lang string, source string, n_tokens string, fp string, sequence_id string"


def docs_of(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, ["en", "de", None][k % 3], ["a", "a", "b", None][k % 4], "x", "y", "z") for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return docs_of(spark, ["a"]).limit(0)


# --- token counts and packing -----------------------------------------------------------


def test_token_counts(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    got = {r.doc_id: r for r in token_counts.count_tokens(docs_of(spark, TEXTS), path, cache_entries=5).collect()}
    for k, text in enumerate(TEXTS):
        assert got[k].n_tokens == len(tok.encode(text or "", add_special_tokens=False).ids), repr(text)[:40]
        assert got[k].fp == "y"
    assert token_counts.count_tokens(empty(spark), path).count() == 0
    with pytest.raises(ValueError):
        token_counts.count_tokens(empty(spark), public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("options", [{}, {"partition_pieces": 2, "rounds": 3}])
def test_packing(spark, options):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    ids = [*range(len(TEXTS) - 2), None, None]
    out = packing.pack_documents(docs_of(spark, TEXTS, ids), path, **options).collect()
    wanted, found = Counter(), Counter()
    for name, text in zip(ids, TEXTS):
        codes = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        first = len(codes) - 1024 * ((len(codes) - 1) // 1024)
        cuts = [0, *range(first, len(codes) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            wanted[name, piece, a, b - a, zlib.crc32(codes[a:b].tobytes())] += 1
    places = defaultdict(list)
    for r in out:
        found[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        places[r.sequence_id].append((r.offset, r.length))
    assert wanted == found
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack_documents(empty(spark), path).count() == 0


def test_bound_and_best_fit():
    rng = random.Random(3)
    for _ in range(200):
        lengths = np.array([rng.randint(1, 30) for _ in range(rng.randint(1, 9))])
        bins, room = packing.best_fit(lengths, 30)
        assert all(lengths[bins == b].sum() + room[b] == 30 for b in range(len(room)))

        def fewest(rest, bins):
            if not rest:
                return len(bins)
            options = [fewest(rest[1:], bins[:k] + [b + rest[0]] + bins[k + 1 :]) for k, b in enumerate(bins) if b + rest[0] <= 30]
            return min([*options, fewest(rest[1:], [*bins, rest[0]])])

        best = fewest(sorted(map(int, lengths), reverse=True)[:7], [])
        assert packing.lower_bound(np.sort(lengths)[::-1][:7], 30) <= best
        assert packing.lower_bound(lengths, 30) <= len(room)


# --- near copies ------------------------------------------------------------------------


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    runs = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    ones = [sum(xxhash.xxh64_intdigest(r.encode(), 42) >> b & 1 for r in runs) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(runs))


def components(values, tau):
    parent = list(range(len(values)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= tau:
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return [top(x) for x in range(len(values))]


def test_near_duplicates(spark):
    got = {r.doc_id: r for r in simhash.near_duplicates(docs_of(spark, TEXTS)).collect()}
    values = [plain_fingerprint(t) for t in TEXTS]
    for k, root in enumerate(components(values, 2)):
        assert got[k].fingerprint == f"{values[k]:016x}"
        assert got[k].component_id == root
    kept = simhash.one_of_each(docs_of(spark, TEXTS))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(components(values, 2)))
    assert kept.columns == docs_of(spark, TEXTS).columns
    assert simhash.near_duplicates(empty(spark)).count() == 0
    doubled = docs_of(spark, ["x y z", "x y z", "p q r s"], [None, None, None])
    assert simhash.near_duplicates(doubled).count() == 3
    assert simhash.one_of_each(doubled).count() == 2


@pytest.mark.parametrize("bucket", [1, 3, 1000])
def test_links_in_crowded_buckets(spark, bucket):
    rng = random.Random(5)
    values = {0}
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(25):
            values.add(centre)
            centre ^= 1 << rng.randrange(64)
            values.add(centre ^ 1 << rng.randrange(64))
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    joined = {r.node: r.root for r in simhash.roots(simhash.links(fps, bucket=bucket)).collect()}
    mine = [joined.get(v, v) for v in signed]
    theirs = components(values, 2)
    assert len({*zip(mine, theirs)}) == len(set(mine)) == len(set(theirs))


def test_allocation_is_the_cheapest():
    import itertools

    rng = random.Random(1)
    for total in (-2, 0, 1):
        costs = [[0.0, *sorted(rng.random() for _ in range(3))] for _ in range(3)]
        best = min((sum(c[t + 1] for c, t in zip(costs, ts)) for ts in itertools.product(range(-1, 3), repeat=3) if sum(ts) == total))
        assert math.isclose(sum(c[t + 1] for c, t in zip(costs, simhash.allocate(costs, total))), best)


# --- fingerprints -----------------------------------------------------------------------


def plain_chunks(data, gear, how):
    """Chunk digests and lengths, byte by byte."""
    found, at, h = {}, 0, 0
    for k, byte in enumerate(data):
        h = (2 * h + int(gear[byte])) % 2**32
        n = k + 1 - at
        clear = how.strict if n <= how.normal else how.loose
        if k + 1 == len(data) or n == how.largest or (n >= how.least and h < 2 ** (32 - clear)):
            found[xxhash.xxh64_hexdigest(data[at : k + 1])] = n
            at = k + 1
    return found


def plain_likeness(a, b):
    if not a or not b:
        return float(a == b)
    return sum(a[d] for d in set(a) & set(b)) / min(sum(a.values()), sum(b.values()))


def test_content_chunks(spark):
    how, gear = fingerprints.Chunking(), fingerprints._gear(1)
    data = LONG.encode()
    slow = [sum(int(gear[data[i - k]]) << k for k in range(32) if i >= k) % (1 << 32) for i in range(300)]
    assert fingerprints.rolling(data[:300], gear).tolist() == slow
    ids = [5, None, 3, 3, *range(10, 10 + len(TEXTS) - 4)]
    for ranges in (1, 3, 8, 211):
        docs = docs_of(spark, TEXTS, ids).withColumn("key", F.lit("x")).withColumn("range", F.lit(7))
        out = fingerprints.compare_with_next(docs, ranges=ranges).collect()
        order = sorted(zip(ids, TEXTS), key=lambda p: (p[0] is None, -(p[0] or 0)))
        assert Counter(r.doc_id for r in out) == Counter(ids)
        for k, (name, text) in enumerate(order):
            if name == 3 or (k + 1 < len(order) and order[k + 1][0] == 3):
                continue  # equal ids go by a hash of the text
            own, following = text or "", order[(k + 1) % len(order)][1] or ""
            edited = own[: len(own) - len(own) // 3] + following[: len(own) // 3]
            (r,) = [r for r in out if r.doc_id == name]
            a, b, c = (plain_chunks(t.encode(), gear, how) for t in (own, edited, following))
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(own)
            assert (r.fingerprint, r.edited_fingerprint) == tuple("".join(f"{d}{n:02x}" for d, n in sorted(x.items())) for x in (a, b))
            assert math.isclose(r.near_edited, plain_likeness(a, b)) and math.isclose(r.near_next, plain_likeness(a, c))
    assert fingerprints.compare_with_next(empty(spark)).count() == 0


def test_content_chunks_of_null_and_repeated_ids(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcdef ", k=200)) for _ in range(60)]
    ids = [None] * 25 + [7] * 25 + list(range(10))
    out = fingerprints.compare_with_next(docs_of(spark, texts, ids), ranges=6)
    assert out.select(F.spark_partition_id()).distinct().count() == 6  # neither null nor one id is a range of its own
    gear, how = fingerprints._gear(1), fingerprints.Chunking()
    shown = {fingerprints.shown(fingerprints.chunk_set(t, gear, how)): (i, t) for i, t in zip(ids, texts)}
    rows = out.collect()
    assert {r.fingerprint for r in rows} == set(shown) and all(shown[r.fingerprint][0] == r.doc_id for r in rows)
    # Each text follows exactly one other.
    heads = {(shown[r.fingerprint][1][:134] + t[:66]): t for r in rows for t in texts}
    followers = [t for r in rows for t in texts if r.edited_sha256 == hashlib.sha256((shown[r.fingerprint][1][:134] + t[:66]).encode()).hexdigest()]
    assert sorted(followers) == sorted(texts) and len(heads) == len(texts) ** 2


# --- language ---------------------------------------------------------------------------


def test_language(spark):
    rng = random.Random(2)
    vocabulary = {"en": ["the", "and", "with", "thing", "over"], "de": ["der", "und", "mit", "über", "keit"], "fr": ["les", "des", "pour", "été", "eau"]}
    rows = [(k, " ".join(rng.choices(vocabulary[lang], k=30)), lang) for k in range(90) for lang in [["en", "de", "fr"][k % 3]]]
    rows += [(900, None, "en"), (901, "123 !!", None), (902, "", "fr"), (903, rows[0][1], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = language.train(docs.where(~language.held_out()))
    assert filters.languages == ["de", "en", "fr"]
    got = {r.doc_id: r for r in language.identify(docs, filters).collect()}
    assert all(got[k].lang_pred == lang for k, _, lang in rows[:90])
    assert [got[k].lang_pred for k in (900, 901, 902, 903)] == ["und", "und", "und", "en"]
    assert all(0 <= r.score <= 1 for r in got.values())
    none = language.train(docs.limit(0))
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}
    assert language.identify(docs.limit(0), filters).count() == 0


def test_trigrams_across_stretches(monkeypatch):
    text = "Ab, céd  EF1g" * 5
    low = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    wanted = [ord(a) << 42 | ord(b) << 21 | ord(c) for a, b, c in zip(low, low[1:], low[2:])]
    for size in (3, 7, 1 << 18):
        monkeypatch.setattr(language, "_STRETCH", size)
        assert language.ngrams(text).tolist() == wanted


# --- neighbours -------------------------------------------------------------------------


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    clean = [(k, rng.normal(size=6).round(2).tolist()) for k in range(400)] + [(1000 + k, [1.0] * 6) for k in range(40)]
    bad = [(2000, None), (2020, [0.0] * 6), (2040, [1.0, float("nan")] + [0.0] * 4), (2060, [1.0, None] + [0.0] * 4), (2080, [float("inf")] + [1.0] * 5), (2100, [1.0]), (None, [9.0] * 6)]
    table = spark.createDataFrame(clean + bad, "vec_id long, embedding array<double>")
    out = neighbours.nearest(table, F.col("vec_id") % 20 == 0, k=5, shard_rows=64, block_rows=7, leaf=8).collect()
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append(r.vec_id)
    for name, own in clean:
        if name % 20 == 0:
            ranked = sorted((-float((np.array(v) * np.array(own)).sum()), i) for i, v in clean if i != name)
            assert got.pop(name) == [i for _, i in ranked[:5]]
    assert not got
    assert neighbours.nearest(table.limit(0), F.lit(True)).count() == 0
    few = neighbours.nearest(table.where("vec_id in (0, 1, 2)"), F.col("vec_id") == 0, k=5)
    assert few.count() == 2


# --- mixing -----------------------------------------------------------------------------


def test_mixing(spark):
    rows = [(k, "w " * (k % 7), "big" if k % 5 else ["s", "t", None][k % 3], "x") for k in range(600)] + [(7, "w w", "big", "x"), (None, "w", "big", "x"), (9999, None, "none", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_note string")
    target = mixing.Target(evenness=0.99, repetition=3.0, block_tokens=100, range_rows=50)
    out = mixing.mix(docs, target).collect()
    plan = {}
    for _, text, source, _ in rows:
        plan[source or ""] = plan.get(source or "", 0) + len((text or "").split())
    total = sum(plan.values())
    p = np.array([t / total for t in plan.values() if t])

    def at(a):
        q = p**a / (p**a).sum()
        return -(q * np.log(q)).sum(), (q / p).max()

    grid = [k / 4096 for k in range(4097)]
    even = max(a for a in grid if at(a)[0] >= 0.99 * math.log(len(p)))
    most = min(a for a in grid if at(a)[1] <= 3.0)
    a = max(even, most)
    q = dict(zip([s for s, t in plan.items() if t], p**a / (p**a).sum()))
    taken = Counter()
    for r in out:
        taken[r.source or ""] += r.mix_tokens
    for source, weight in q.items():
        assert abs(taken[source] - weight * total) <= 7 + total / 1000
    assert taken["none"] == 0 and {r.mix_note for r in out} == {"x"}
    assert max(r.mix_copy for r in out) <= 3
    blocks = Counter()
    for r in out:
        blocks[r.mix_block] += r.mix_tokens
    assert sorted(blocks) == list(range(-(-total // 100))) and max(blocks.values()) <= 100 + 7 * len(q) * 2
    assert mixing.mix(docs.limit(0), target).count() == 0
    assert mixing.mix(docs.where("source = 'none'"), target).count() == 0


# --- chat -------------------------------------------------------------------------------

HARD = ["", " ", "</s>", "<s>a</s>", "[INST] x [/INST]", " [/INST]", "<\\s>", "<\\\\/s>", "<<ROLE:user>> x <</ROLE>>", "<", "[", "a\\", "<</s>", "line\nbreak", "é\U0001f600", "$1\\"]


def test_chat(spark):
    roles = ["user", "assistant", "system", "a>>b", ">>>", "<s>", "", None, "x\\"]
    rows = [(k, n, role, text, "x") for k, role in enumerate(roles) for n, text in enumerate([*HARD, None])]
    rows += [(50, 0, "user", "tie", "x"), (50, 0, "user", "tie", "x"), (None, None, None, None, None), (60, 0, "assistant", LONG, "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = {r.conv_id: r for r in chat.format_conversations(turns).collect()}
    for k, role in enumerate(roles):
        r = out[k]
        assert r.round_trip
        assert [(t.role, t.text) for t in r.parsed] == [(role or "", x or "") for x in [*HARD, None]]
        spoken = [x or "" for x in [*HARD, None]] if role == "assistant" else []
        assert len(r.loss_spans) == len(spoken)
        for span, text in zip(r.loss_spans, spoken):
            body = r.formatted[span.start : span.start + span.length]
            assert re.sub(r"(<|\[)\\(\\*)(/?s>|/?INST\]|<ROLE:|</ROLE>>)", r"\1\2\3", body) == text
    assert len(out[50].parsed) == 2 and out[None].round_trip and out[60].round_trip
    assert chat.format_conversations(turns.limit(0)).count() == 0


# --- archives ---------------------------------------------------------------------------


def test_archive(spark, tmp_path):
    body = "WARC/1.1\r\n\r\né " * 400
    rows = [(1, "http://a/\r\nX", body, "n"), (2, None, body, "n"), (2, "u", body, "n"), (None, "u", body, "n"), (3, "u", None, "n"), (4, "u", "", "n"), (5, "u", "tiny", "n"), (6, "u", "tiny", "n"), (7, "u", LONG, "n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, name string")
    records = warc.archive_records(pages, segment_bytes=700, chunk_bytes=64).repartition(5)
    warc.write_archive(records, f"{tmp_path}/w", records_per_file=40)
    read = warc.read_records(spark, f"{tmp_path}/w")
    out = warc.payloads(warc.reassemble(read)).withColumns({"page": warc.page_of(F.col("name")), "to": warc.page_of(F.col("refers_to"))}).collect()
    assert len(out) == len(rows) and {r.status for r in out} == {"ok"}
    wanted = Counter((i, hashlib.sha1((t or "").encode()).hexdigest(), len((t or "").encode())) for i, _, t, _ in rows)
    assert wanted == Counter((r.page, r.payload_digest, r.payload_bytes) for r in out)
    assert Counter((r.kind, r.to) for r in out) == Counter({("response", None): 6, ("revisit", 2): 3})
    parted = read.where("segment is not null")
    assert parted.count() > 10
    lost = warc.reassemble(read.where("not (segment <=> 2)"))
    assert {r.status for r in lost.collect()} == {"ok", "missing_segment"}
    short = read.withColumn("total", F.col("total") + 1)
    assert "length_mismatch" in {r.status for r in warc.reassemble(short).collect()}
    wrong = read.withColumn("digest", F.when(F.col("kind") == "response", F.lit("sha1:00")).otherwise(F.col("digest")))
    assert "digest_mismatch" in {r.status for r in warc.payloads(warc.reassemble(wrong)).collect()}
    assert warc.archive_records(pages.limit(0)).count() == 0
    assert [r[-1] for r in warc.parse_records(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")] == [False]
    assert warc.decode_http(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\nzz\r\n") == (None, False)


# --- quality ----------------------------------------------------------------------------


def plain_model(texts):
    """Modified Kneser-Ney of order four with dictionaries."""
    levels = {4: Counter()}
    for text in texts:
        s = "\x02\x02\x02" + text + "\x03"
        levels[4].update(s[k : k + 4] for k in range(len(s) - 3))
    for k in (3, 2, 1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    cuts = {}
    for k, level in levels.items():
        n1, n2, n3, n4 = (sum(v == c for v in level.values()) for c in (1, 2, 3, 4))
        if n1 and n2 and n3:
            y = n1 / (n1 + 2 * n2)
            raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
            cuts[k] = [min(max(d, 0.05), c - 0.05) for d, c in zip(raw, (1, 2, 3))]
        else:
            cuts[k] = [0.5, 1.0, 1.5]
    symbols = len(levels[1]) + 1

    def p(gram):
        if not gram:
            return 1 / symbols
        k, level = len(gram), levels[len(gram)]
        inside = {g: c for g, c in level.items() if g[:-1] == gram[:-1]}
        if not inside:
            return p(gram[1:])
        total = sum(inside.values())
        cut = lambda c: cuts[k][min(c, 3) - 1]
        return (max(inside.get(gram, 0) - cut(inside[gram]), 0) if gram in inside else 0) / total + sum(map(cut, inside.values())) / total * p(gram[1:])

    return p


def test_quality(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["ab", "cd", "ef", "gh"]) for _ in range(3))
    texts = [" ".join(word() for _ in range(12)) for _ in range(40)] + ["$$$ ||| %%% QQQ", None, "", "ab" * 4000, "\U0001f600 zz"]
    docs = docs_of(spark, texts)
    ids = spark.createDataFrame([(k,) for k in range(40)] + [(None,), (0,)], "doc_id long")
    out = {r.doc_id: r for r in quality.classify(docs, ids, block_chars=600).collect()}
    train = {r.doc_id for r in ids.where(~quality.held_back()).collect()} - {None}
    p = plain_model([texts[k] for k in train])
    for k in (0, 1, 40, 44):
        s = "\x02\x02\x02" + "".join(c if ord(c) < 0xFF00 else chr(0xE000 + ord(c) % 0x1000) for c in texts[k]) + "\x03"
        logs = [math.log(p(s[i : i + 4])) for i in range(len(s) - 3)]
        assert math.isclose(out[k].perplexity, math.exp(-sum(logs) / len(logs)), rel_tol=1e-9)
    assert not out[40].keep and not out[41].keep and not out[42].keep and out[41].perplexity is None
    assert sum(out[k].keep for k in range(40)) >= 36
    assert {r.doc_id for r in quality.keep_good(docs, quality.classify(docs, ids)).collect()} >= {k for k in range(40) if out[k].keep}
    nobody = quality.classify(docs, ids.limit(0)).collect()
    assert {r.doc_id for r in nobody if r.keep} == {k for k, t in enumerate(texts) if t}
    assert quality.classify(docs.limit(0), ids).count() == 0
