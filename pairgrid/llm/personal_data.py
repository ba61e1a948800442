"""Personal data by fixed rules and a semi-Markov conditional random field.

Rules find e-mail and IP addresses, card and telephone numbers where they stand alone. A
rule takes the longest run and drops it whole if a check fails, so a number beside
another one is lost. The field takes these up: a text's islands (runs of digits and what
stands between them, and what looks like an address) are cut to atoms, every run of atoms
of bounded length that could be an entity is a candidate, and features of the whole
candidate (digits, groups, checksum, separators, neighbours) score it. Dynamic
programming over all segmentations chooses boundaries and kinds together. What the rules
found stays as it is.

The field is learned from the rules' own finds by maximum likelihood. Islands in which a
rule dropped a run too long for its kind are left out, as they may hold several entities;
other drops are examples of what is none. Learning reads a bounded number of different
islands; each text is read once.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairgrid.llm.common import free_buffers, query, short_batches, table, whole_text
from pairgrid.session import staged

KINDS = ("email", "ip", "card", "phone")

# The rules' patterns, written so that none begins again within a run that it has read.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Islands of the field.
_NUMBERS = re.compile(r"[+(]?[0-9][0-9 ().+-]*(?<=[0-9])")
_ADDRESS = re.compile(r" ?(?:@|[\[(]at[\])]) ?[A-Za-z0-9-]+(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]+)+")
_ATOMS = re.compile(r"[0-9]+|[A-Za-z]+|[^0-9A-Za-z]")
_LOCAL_CHARACTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")

#: An entity of the field has at most so many atoms and digits.
MOST_ATOMS, MOST_DIGITS = 24, 19


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _local_start(text: str, at: int, least: int) -> int:
    while at > least and text[at - 1] in _LOCAL_CHARACTERS:
        at -= 1
    return at


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(kind, start, end) of what the rules find, by kind and start, and what they dropped as too long."""
    found: list[tuple[int, int, int]] = []
    too_long: list[tuple[int, int]] = []
    end = 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            start = _local_start(text, m.start(), end)
            if start < m.start():
                end = m.end()
                found.append((0, start, end))
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) < 4 and int(x) <= 255 for x in m[0].split(".")):
            found.append((1, *m.span()))
    for kind, pattern, least, most in ((2, _CARD, 13, 19), (3, _PHONE, 9, 15)):
        if kind == 3 and "+" not in text:
            continue
        for m in pattern.finditer(text):
            if len(m[0]) < least:
                continue
            digits = "".join(filter(str.isdecimal, m[0]))
            if len(digits) > most:
                too_long.append(m.span())
            elif len(digits) >= least and (kind == 3 or luhn(digits)):
                found.append((kind, *m.span()))
    return found, too_long


def islands(text: str) -> list[tuple[int, int]]:
    """Stretches that may hold an entity: numbers with seven digits or more, and addresses."""
    out = []
    for m in _NUMBERS.finditer(text):
        if m.end() - m.start() >= 7 and sum(map(str.isdecimal, m[0])) >= 7:
            out.append(m.span())
    if "@" in text or "at)" in text or "at]" in text:
        end = 0
        for m in _ADDRESS.finditer(text):
            start = _local_start(text, m.start(), end)
            if start < m.start():
                end = m.end()
                out.append((start, end))
    return out


def _around(char: str) -> str:
    return "end" if not char else "digit" if char.isdecimal() else "letter" if char.isalnum() else "blank" if char.isspace() else char if char in "@+.-_/:=#" else "mark"


class Candidates:
    """Atoms of an island and every segment that may be an entity: (first atom, end atom, kind, features)."""

    def __init__(self, body: str, left: str, right: str):
        self.atoms = _ATOMS.findall(body)
        self.starts = [0]
        for a in self.atoms:
            self.starts.append(self.starts[-1] + len(a))
        self.body, self.left, self.right = body, left, right
        self.segments: list[tuple[int, int, int, list[str]]] = []
        if any(x in body for x in ("@", "at)", "at]")):
            self.addresses()
        else:
            self.numbers()

    def edges(self, i: int, j: int) -> list[str]:
        before = self.atoms[i - 1][-1] if i else self.left[-1:]
        behind = self.atoms[j][0] if j < len(self.atoms) else self.right[:1]
        return [f"before={_around(before)}", f"behind={_around(behind)}"]

    def addresses(self) -> None:
        m = re.search(r" ?(@|[\[(]at[\])]) ?", self.body)
        if not m or not m.start():
            return
        first = self.starts.index(m.end()) if m.end() in self.starts else len(self.atoms)
        labels = 0
        for j in range(first + 1, len(self.atoms) + 1):
            last = self.atoms[j - 1]
            if last[-1].isalnum() and (j == len(self.atoms) or not (self.atoms[j][0].isalnum() or self.atoms[j] == "-")):
                host = self.body[m.end() : self.starts[j]]
                labels = len(re.findall(r"\.|[\[(]dot[\])]", host))
                if labels and not host.endswith(("(dot", "[dot")):
                    mark = "plain" if m[1] == "@" else "named"
                    feats = ["bias", f"at={mark}", f"labels={min(labels, 4)}", f"top={min(len(last), 7)}", f"blank={' ' in self.body[: self.starts[j]]}"]
                    self.segments.append((0, j, 0, [f"0:{f}" for f in feats + self.edges(0, j)]))

    def numbers(self) -> None:
        atoms = self.atoms
        for i, a in enumerate(atoms):
            nxt = atoms[i + 1] if i + 1 < len(atoms) else ""
            if not (a.isdecimal() or (a in "+(" and nxt.isdecimal()) or (a == "+" and nxt == "(")):
                continue
            digits, groups, between, open_brackets = "", [], "", 0
            for j in range(i, min(i + MOST_ATOMS, len(atoms))):
                x = atoms[j]
                if x.isdecimal():
                    digits += x
                    groups.append(len(x))
                    if len(digits) > MOST_DIGITS:
                        break
                    if len(digits) >= 4 and not open_brackets:
                        self.number(i, j + 1, digits, groups, between)
                    continue
                open_brackets += (x == "(") - (x == ")")
                if open_brackets < 0 or (x == "+" and j > i):
                    break
                between += x

    def number(self, i: int, j: int, digits: str, groups: list[int], between: str) -> None:
        shape = "-".join(map(str, groups[:8]))
        common = [f"marks={''.join(sorted(set(between)))}", *self.edges(i, j)]
        if between == "..." and len(groups) == 4 and all(int(x) <= 255 for x in self.body[self.starts[i] : self.starts[j]].split(".")):
            self.segments.append((i, j, 1, [f"1:{f}" for f in ["bias", *common]]))
        if 13 <= len(digits) <= 19 and set(between) <= {" ", "-"} and len(between) == len(groups) - 1:
            feats = ["bias", f"luhn={luhn(digits)}", f"digits={len(digits)}", f"groups={shape}", *common]
            self.segments.append((i, j, 2, [f"2:{f}" for f in feats]))
        if 7 <= len(digits) <= 15:
            first = self.atoms[i]
            feats = ["bias", f"first={first if first in '+(' else 'digit'}", f"digits={len(digits)}", f"groups={shape}", f"n={min(len(groups), 7)}", *common]
            self.segments.append((i, j, 3, [f"3:{f}" for f in feats]))

    def outside(self, k: int) -> list[str]:
        """Features of an atom that is in no entity."""
        a = self.atoms[k]
        return [f"o:digits={min(len(a), 20)}"] if a.isdecimal() else ["o:letters" if a.isalpha() else "o:mark"]


_LABELS = len(KINDS) + 1  # the last one is "no entity"


def _logsum(values: list[float]) -> float:
    top = max(values)
    return top if top == -math.inf else top + math.log(sum(math.exp(v - top) for v in values))


class Field:
    """Weights of features and of neighbouring labels."""

    def __init__(self, weights: dict[str, float] | None = None):
        self.weights = weights or {}

    def segments(self, c: Candidates, banned: list[tuple[int, int]] = ()) -> list[tuple[int, int, int, list[str]]]:
        """Candidates and single atoms by their end; none of the former overlaps ``banned`` places of the island."""
        free = [s for s in c.segments if not any(c.starts[s[0]] < e and b < c.starts[s[1]] for b, e in banned)]
        return sorted([*free, *((k, k + 1, _LABELS - 1, c.outside(k)) for k in range(len(c.atoms)))], key=lambda s: s[1])

    def score(self, feats: list[str]) -> float:
        return sum(self.weights.get(f, 0.0) for f in feats)

    def step(self, a: int, b: int) -> float:
        return self.weights.get(f"t:{a}>{b}", 0.0)

    def best(self, c: Candidates, banned: list[tuple[int, int]], caution: float) -> list[tuple[int, int, int]]:
        """(kind, start, end) of the entities of the best segmentation; each must be worth ``caution``."""
        n, none = len(c.atoms), _LABELS - 1
        top = [[-math.inf] * _LABELS for _ in range(n + 1)]
        back: list[list[tuple | None]] = [[None] * _LABELS for _ in range(n + 1)]
        top[0][none] = 0.0
        for i, j, kind, feats in self.segments(c, banned):
            own = self.score(feats) - (caution if kind != none else 0.0)
            came = max(range(_LABELS), key=lambda k: top[i][k] + self.step(k, kind))
            value = top[i][came] + self.step(came, kind) + own
            if value > top[j][kind]:
                top[j][kind], back[j][kind] = value, (i, came)
        out, j, kind = [], n, max(range(_LABELS), key=lambda k: top[n][k])
        while j:
            i, came = back[j][kind]
            if kind != none:
                out.append((kind, c.starts[i], c.starts[j]))
            j, kind = i, came
        return out[::-1]

    def gradient(self, c: Candidates, gold: set[tuple[int, int, int]]) -> dict[str, float]:
        """Of the log likelihood of ``gold``, (kind, first atom, end atom): its features less the expected ones."""
        n, none = len(c.atoms), _LABELS - 1
        segments = self.segments(c)
        own = [self.score(s[3]) for s in segments]
        steps = [[self.step(a, b) for b in range(_LABELS)] for a in range(_LABELS)]
        ahead = [[-math.inf] * _LABELS for _ in range(n + 1)]
        ahead[0][none] = 0.0
        behind = [[-math.inf] * _LABELS for _ in range(n + 1)]
        behind[n] = [0.0] * _LABELS
        parts: dict[tuple[int, int], list[float]] = defaultdict(list)
        at = 0
        for j in range(1, n + 1):
            parts.clear()
            while at < len(segments) and segments[at][1] == j:
                i, _, kind, _ = segments[at]
                parts[j, kind] += [ahead[i][k] + steps[k][kind] + own[at] for k in range(_LABELS) if ahead[i][k] > -math.inf]
                at += 1
            for (_, kind), values in parts.items():
                ahead[j][kind] = _logsum(values) if values else -math.inf
        starts: dict[int, list[int]] = defaultdict(list)
        for k, s in enumerate(segments):
            starts[s[0]].append(k)
        for i in range(n - 1, -1, -1):
            for k in range(_LABELS):
                values = [steps[k][segments[s][2]] + own[s] + behind[segments[s][1]][segments[s][2]] for s in starts[i]]
                behind[i][k] = _logsum(values) if values else -math.inf
        whole = _logsum(ahead[n])
        out: dict[str, float] = defaultdict(float)
        for s, (i, j, kind, feats) in enumerate(segments):
            for k in range(_LABELS):
                if ahead[i][k] == -math.inf or behind[j][kind] == -math.inf:
                    continue
                p = math.exp(ahead[i][k] + steps[k][kind] + own[s] + behind[j][kind] - whole)
                out[f"t:{k}>{kind}"] -= p
                for f in feats:
                    out[f] -= p
        known = {(kind, i, j): feats for i, j, kind, feats in segments}
        at, came = 0, none
        inside = {i: (kind, j) for kind, i, j in gold}
        while at < n:
            kind, j = inside.get(at, (none, at + 1))
            out[f"t:{came}>{kind}"] += 1
            for f in known[kind, at, j]:
                out[f] += 1
            at, came = j, kind
        return out


def learn(examples: list[tuple[str, str, str]], epochs: int = 8, rate: float = 0.3, decay: float = 1e-3) -> Field:
    """A field from (body, left, right) of islands, labelled by the rules; steps shrink by past gradients."""
    ready = []
    for body, left, right in examples:
        found, too_long = base_spans(body)
        c = Candidates(body, left, right)
        place = {x: k for k, x in enumerate(c.starts)}
        kinds = {(i, j, kind) for i, j, kind, _ in c.segments}
        gold, reached = set(), 0
        for kind, start, end in sorted(found, key=lambda s: (s[1], -s[2])):
            i, j = place.get(start), place.get(end)
            if (i, j, kind) in kinds and start >= reached:
                gold.add((kind, i, j))
                reached = end
        if not too_long and c.atoms and len(gold) == len({(s, e) for _, s, e in found}):
            ready.append((c, gold))
    field, past = Field(), defaultdict(float)
    for _ in range(epochs):
        for c, gold in ready:
            for f, g in field.gradient(c, gold).items():
                g -= decay * field.weights.get(f, 0.0)
                past[f] += g * g
                if g:
                    field.weights[f] = field.weights.get(f, 0.0) + rate * g / math.sqrt(past[f] + 1e-9)
    return field


_READ = "doc_id long, base array<int>, bodies array<struct<start:int,body:string,left:string,right:string>>"
_ISLANDS = pa.list_(pa.struct([("start", pa.int32()), ("body", pa.string()), ("left", pa.string()), ("right", pa.string())]))


def read_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base (kind, start, end of each find in one list) and islands of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, bodies = [], []
            for cell in batch.column(1):
                body = cell.as_py()
                base.append([x for span in base_spans(body)[0] for x in span])
                bodies.append([{"start": a, "body": body[a:b], "left": body[max(0, a - 8) : a], "right": body[b : b + 8]} for a, b in islands(body)])
            columns = [batch.column(0), pa.array(base, pa.list_(pa.int32())), pa.array(bodies, _ISLANDS)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "base", "bodies"])
        free_buffers()

    short_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text")).mapInArrow(run, _READ)


def fit(read: DataFrame, islands_read: int = 3000, longest: int = 120) -> Field:
    """A field from at most ``islands_read`` different islands of at most ``longest`` characters, by a hash of them.

    These two numbers bound what learning reads, whatever the number of texts.
    """
    parts = read.select(F.explode("bodies").alias("i")).select("i.body", "i.left", "i.right").where(F.length("body") <= longest)
    some = parts.distinct().orderBy(F.xxhash64("body", "left", "right"), "body", "left", "right").limit(islands_read)
    return learn([tuple(r) for r in some.collect()])


_OUT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in sorted(spans))


def find(read: DataFrame, field: Field, caution: float = 2.0) -> DataFrame:
    """Counts and digest of the rules' finds, and all spans, of what ``read_texts`` gave."""
    sent = read.sparkSession.sparkContext.broadcast(field.weights)  # bounded by the islands read in learning

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Field(sent.value)
        for batch in batches:
            rows = []
            for doc, flat, bodies in zip(*(batch.column(k).to_pylist() for k in range(3))):
                base = list(zip(flat[::3], flat[1::3], flat[2::3]))
                spans = list(base)
                for x in bodies:
                    a, b = x["start"], x["start"] + len(x["body"])
                    taken = [(s - a, e - a) for _, s, e in base if s < b and a < e]
                    if len(taken) == 1 and taken[0][0] <= 0 and taken[0][1] >= b - a:
                        continue
                    spans += [(kind, a + s, a + e) for kind, s, e in model.best(Candidates(x["body"], x["left"], x["right"]), taken, caution)]
                n = [sum(1 for kind, _, _ in base if kind == k) for k in range(len(KINDS))]
                rows.append((doc, *n, hashlib.sha256(_shown(base).encode()).hexdigest(), _shown(spans)))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            columns = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[c.split()[0] for c in _OUT.split(", ")])

    return read.mapInArrow(run, _OUT)


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", islands_read: int = 3000) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of each text.

    The numbers and the digest are of the rules' finds; spans has those and what the
    field adds, which never overlaps them. Places count code points. A null text is an
    empty one and has no spans. Repeated rows and null or equal ids are documents of
    their own; other columns are ignored; an empty table gives an empty table.
    """
    read = staged(read_texts(docs, doc_id, text), "islands")
    return find(read, fit(read, islands_read))


@query("op13_semi_markov_pii")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole document."""
    return personal_data(table(spark, sf_dir, "documents"))
