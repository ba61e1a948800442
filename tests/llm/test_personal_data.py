"""The rules against plain patterns, and the field against all segmentations written out."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from pairgrid.llm import personal_data as pii
from test_operators import TEXTS, docs_of, empty

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CARDS = ["4111111111111111", "5500005555555559", "340000000000009"]
WORDS = "the and of erre onti handst lynd ouer".split()


def checksum(digits):
    doubled = [int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(digits[::-1])]
    return sum(doubled) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and checksum(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def prose(rng, n):
    out = []
    for _ in range(n):
        words = [rng.choice(WORDS) for _ in range(30)]
        number = "".join(rng.choice("0123456789") for _ in range(16))
        words[rng.randrange(25)] = rng.choice([
            f"{rng.choice(WORDS)}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com",
            ".".join(str(rng.randrange(300)) for _ in range(4)),
            rng.choice(CARDS),
            number if not checksum(number) else "12",
            f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}",
        ])
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("letters", ["1234567890 -+().@a", "0125.", "a@b.-_% 1", "+1 (5).-"])
def test_rules_equal_plain_patterns(letters):
    rng = random.Random(2)
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text)[0]] == plain(text), text


def test_rules_stay_linear_on_long_runs():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+" * 300_000, "a@" * 150_000, "1 " * 150_000, "@" + "a" * 300_000):
        pii.base_spans(text)
        pii.islands(text)


def all_segmentations(field, c):
    """Every way to cut the atoms, with its score."""
    by_start = {}
    for i, j, kind, feats in field.segments(c):
        by_start.setdefault(i, []).append((j, kind, field.score(feats)))

    def walk(at, came, score, cut):
        if at == len(c.atoms):
            yield score, cut
            return
        for j, kind, own in by_start[at]:
            yield from walk(j, kind, score + own + field.step(came, kind), [*cut, (kind, at, j)])

    return list(walk(0, len(pii.KINDS), 0.0, []))


def test_field_equals_all_segmentations():
    rng = random.Random(5)
    for body in ("+1 (499) 555-6503 1.2.3.4", "4111111111111111 5500005555555559", "12.34.5.6-77 8899"):
        c = pii.Candidates(body, "x ", " y")
        field = pii.Field()
        names = {f for s in field.segments(c) for f in s[3]} | {f"t:{a}>{b}" for a in range(5) for b in range(5)}
        field.weights = {f: rng.uniform(-1, 1) for f in names}
        ways = all_segmentations(field, c)
        score, cut = max(ways)
        none = len(pii.KINDS)
        assert field.best(c, [], 0.0) == [(k, c.starts[i], c.starts[j]) for k, i, j in cut if k != none]
        # Gradient of the log likelihood, by differences.
        gold = {x for x in ways[len(ways) // 2][1] if x[0] != none}
        wanted = [s for s, w in ways if {x for x in w if x[0] != none} == gold][0]

        def likelihood():
            again = all_segmentations(field, c)
            own = [s for s, w in again if {x for x in w if x[0] != none} == gold][0]
            top = max(s for s, _ in again)
            return own - top - math.log(sum(math.exp(s - top) for s, _ in again))

        assert wanted == pytest.approx(wanted)
        gradient = field.gradient(c, gold)
        for f in rng.sample(sorted(names), 12):
            before = likelihood()
            field.weights[f] += 1e-5
            assert (likelihood() - before) / 1e-5 == pytest.approx(gradient.get(f, 0.0), abs=1e-3)
            field.weights[f] -= 1e-5


def test_query_columns(spark):
    rng = random.Random(7)
    texts = [*TEXTS, *prose(rng, 300)]
    joined = "handst +1 (826) 555-4081 190.137.223.204 erre 4111111111111111 5500005555555559 ouer"
    texts.append(joined)
    got = {r.doc_id: r for r in pii.personal_data(docs_of(spark, texts)).collect()}
    for k, text in enumerate(texts):
        base = plain(text or "")
        row = got[k]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(x[0] == n for x in base) for n in PATTERNS]
        assert row.base_sha256 == hashlib.sha256(",".join(f"{n}:{a}:{b}" for n, a, b in base).encode()).hexdigest()
        spans = row.spans.split(",") if row.spans else []
        assert {f"{n}:{a}:{b}" for n, a, b in base} <= set(spans)
        order = [(list(PATTERNS).index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert order == sorted(order)
        if k < len(texts) - 1:
            assert len(spans) == len(base), text  # nothing is added where the rules miss nothing
    added = {(s.split(":")[0], joined[int(s.split(":")[1]) : int(s.split(":")[2])]) for s in got[len(texts) - 1].spans.split(",")}
    assert added == {("phone", "+1 (826) 555-4081"), ("ip", "190.137.223.204"), ("card", "4111111111111111"), ("card", "5500005555555559")}


def test_equal_null_ids_and_empty_table(spark):
    rows = pii.personal_data(docs_of(spark, ["a.b@c.de", "a.b@c.de", None], [None, 4, 4])).collect()
    assert sorted(((r.doc_id, r.n_email, r.spans) for r in rows), key=str) == [(4, 0, ""), (4, 1, "email:0:8"), (None, 1, "email:0:8")]
    assert pii.personal_data(empty(spark)).count() == 0
    assert pii.personal_data(docs_of(spark, ["é +1 (499) 555-6503"])).select(F.col("spans")).first()[0] == "phone:2:19"
