"""Personal data: fixed base patterns plus spans of a semi-Markov conditional random field.

The base patterns find e-mail addresses, IP addresses, card and phone numbers as they are usually
written. The random field looks at the stretches the base patterns leave: runs of digits and
separators, and words around a spelled-out "at" and "dot". A stretch is a row of pieces (words,
digit groups, separators). A candidate segment is up to ``LONGEST`` pieces under one type, scored by
features of the whole span: digits, their grouping, separators, Luhn and range tests, what stands
around it. Dynamic programming over the pieces finds the best set of segments, boundaries and types
together; text outside segments scores zero, and stretches never overlap base spans.

Training is weakly supervised: the spans that the base patterns find in at most ``SAMPLE`` rows are
rewritten the way people hide them (``a (at) b (dot) c``, numbers without their plus sign, with other
separators), and plain numbers and random cuts of them stand for everything else. The weights are
the regularised maximum of the conditional likelihood, from forward-backward sums over all
segmentations.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.llm.common import arrow_map, bounded_sample, slices, stage, str_texts

KINDS = ("email", "ip", "card", "phone")
LONGEST = 24
SAMPLE, TAUGHT = 600, 120
DIMENSIONS = 1 << 12
EACH = 16  # features of a segment
STEPS, RATE, RIDGE = 40, 1.0, 0.001

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+$")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only start where a run of digits starts; saying so keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")

_DIGITS = re.compile(r"[(\[+]?[0-9][0-9\x20()\[\].,/_:-]{5,}[0-9][)\]]?")
_AT = re.compile(r"[\x20]?[(\[{<][\x20]?at[\x20]?[)\]}>][\x20]?|\x20at\x20|\x20?@\x20?", re.I)
_DOT = re.compile(r"[\x20]?[(\[{<][\x20]?dot[\x20]?[)\]}>]|\x20dot\x20", re.I)
_WORD_END = re.compile(r"[A-Za-z0-9._%+-]{1,64}$")
_HIDDEN_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,64}(?:(?:\x20?[(\[{<]\x20?dot\x20?[)\]}>]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{1,64}){1,6}", re.I)
_PIECE = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.S)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 if d > 4 else d * 2
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their @ signs so that long words stay linear."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by kind, then start."""
    if not _ANY.search(text):
        return []
    out: list[Span] = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(x := p.lstrip("0")) <= 3 and int(x or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def stretches(text: str, taken: list[Span]) -> list[tuple[int, int]]:
    """Where hidden data could be: stretches of text, apart from each other and from base spans.

    Stretches that overlap are one; base spans are cut out of a stretch, and what is left of it on
    either side stays.
    """
    found = [(m.start(), m.end()) for m in _DIGITS.finditer(text) if len(_digits(m[0])) >= (4 if "[.]" in m[0] or "(.)" in m[0] else 7)]
    for m in _AT.finditer(text):
        end = _HIDDEN_DOMAIN.match(text, m.end())
        begin = _WORD_END.search(text, max(0, m.start() - 64), m.start()) if end else None
        if begin and (m[0] != "@" or _DOT.search(end[0])):
            found.append((begin.start(), end.end()))
    whole: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if whole and a < whole[-1][1]:
            whole[-1] = (whole[-1][0], max(b, whole[-1][1]))
        else:
            whole.append((a, b))
    out: list[tuple[int, int]] = []
    blocked = sorted((a, b) for _, a, b in taken)
    at = 0
    for a, b in whole:
        while at < len(blocked) and blocked[at][0] < b:
            if blocked[at][1] > a:
                if a < blocked[at][0]:
                    out.append((a, blocked[at][0]))
                a = blocked[at][1]
            if blocked[at][1] >= b:
                break  # the same base span may reach into the next stretch
            at += 1
        if a < b:
            out.append((a, b))
    return out


@lru_cache(200_000)
def _hash(name: str) -> int:
    return zlib.crc32(name.encode()) % DIMENSIONS


def span_features(kind: str, span: str, before: str, after: str) -> list[int]:
    """Features of a whole candidate segment under a type."""
    groups = re.findall(r"[0-9]+", span)
    digits = "".join(groups)
    seps = "".join(sorted(set(re.findall(r"[^\w]", span))))
    letters = re.findall(r"[^\W\d_]+", span.lower())
    shape = "-".join(str(min(len(g), 9)) for g in groups[:8])
    names = [
        "bias", f"digits={min(len(digits), 20)}", f"groups={min(len(groups), 8)}", f"shape={shape}", f"seps={seps}",
        f"luhn={len(digits) >= 13 and luhn(digits)}", f"bytes={len(groups) == 4 and all(len(g) < 4 and int(g) < 256 for g in groups)}",
        f"at={'@' in span or 'at' in letters}", f"dot={'dot' in letters or bool(letters) and '.' in span}", f"words={min(len(letters), 8)}",
        f"last={len(letters[-1]) if letters and 2 <= len(letters[-1]) <= 4 else 0}", f"first={_class(span[:1])}", f"end={_class(span[-1:])}",
        f"before={_class(before[-1:])}", f"after={_class(after[:1])}", f"address={'@' in span or 'at' in letters}{'dot' in letters}{len(letters) >= 4}",
    ]
    return [_hash(f"{kind}|{n}") for n in names]


def _class(c: str) -> str:
    return "none" if not c else "digit" if c.isdigit() else "letter" if c.isalpha() else "space" if c.isspace() else c


@dataclass
class Lattice:
    """The candidate segments of a stretch: pieces, and for each segment its ends, kind and features."""

    edges: list[int]
    first: np.ndarray
    last: np.ndarray
    kind: np.ndarray
    features: np.ndarray


def lattice(text: str, start: int, end: int) -> Lattice:
    pieces = [(m.start(), m.end()) for m in _PIECE.finditer(text, start, end)]
    edges = [a for a, _ in pieces] + [end]
    solid = [not text[a:b].isspace() for a, b in pieces]
    rows = []
    for i in range(len(pieces)):
        if not solid[i]:
            continue
        for j in range(i, min(len(pieces), i + LONGEST)):
            a, b = edges[i], edges[j + 1]
            if not solid[j] or b - a < 7:
                continue
            before, after = text[max(0, a - 1) : a], text[b : b + 1]
            if (before.isalnum() and text[a].isalnum()) or (after.isalnum() and text[b - 1].isalnum()):
                continue  # a segment does not begin or end inside a word or number
            rows += [(i, j + 1, k, span_features(kind, text[a:b], before, after)) for k, kind in enumerate(KINDS)]
    pick = lambda c: np.array([r[c] for r in rows], np.int64)
    return Lattice(edges, pick(0), pick(1), pick(2), np.array([r[3] for r in rows], np.int64).reshape(len(rows), EACH))


def _sums(found: Lattice, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log sums over all segmentations; a piece outside segments scores zero."""
    n = len(found.edges)
    forward, backward = np.full(n, -np.inf), np.full(n, -np.inf)
    forward[0] = backward[-1] = 0.0
    ends, starts = [[] for _ in range(n)], [[] for _ in range(n)]
    for s, (i, j) in enumerate(zip(found.first.tolist(), found.last.tolist(), strict=True)):
        ends[j].append(s)
        starts[i].append(s)
    for k in range(1, n):
        forward[k] = np.logaddexp.reduce([forward[k - 1], *(forward[found.first[s]] + scores[s] for s in ends[k])])
    for k in range(n - 2, -1, -1):
        backward[k] = np.logaddexp.reduce([backward[k + 1], *(backward[found.last[s]] + scores[s] for s in starts[k])])
    return forward, backward


def train(examples: list[tuple[str, int, int, list[Span]]]) -> np.ndarray:
    """Weights from texts, the place of a stretch in each, and its true spans."""
    data = []
    for text, start, end, spans in examples:
        found = lattice(text, start, end)
        if not len(found.first):
            continue
        truth = {(a, b, KINDS.index(k)) for k, a, b in spans}
        gold = [s for s in range(len(found.first)) if (found.edges[found.first[s]], found.edges[found.last[s]], found.kind[s]) in truth]
        if len(gold) == len(truth):
            data.append((found, gold))
    weights, squares = np.zeros(DIMENSIONS), np.full(DIMENSIONS, 1e-8)
    for _ in range(STEPS):
        gradient = -RIDGE * weights
        for found, gold in data:
            scores = weights[found.features].sum(1)
            forward, backward = _sums(found, scores)
            expected = np.exp(forward[found.first] + scores + backward[found.last] - forward[-1])
            expected[gold] -= 1
            np.subtract.at(gradient, found.features, (expected / len(data))[:, None])
        squares += gradient**2
        weights += RATE * gradient / np.sqrt(squares)
    return weights


def decode(text: str, start: int, end: int, weights: np.ndarray, margin: float = 0.0) -> list[Span]:
    """The best segmentation of a stretch, jointly over boundaries and types."""
    found = lattice(text, start, end)
    n = len(found.edges)
    if not len(found.first):
        return []
    scores = weights[found.features].sum(1) - margin
    best, back = np.zeros(n), [-1] * n
    by_end: list[list[int]] = [[] for _ in range(n)]
    for s, j in enumerate(found.last.tolist()):
        by_end[j].append(s)
    for k in range(1, n):
        best[k] = best[k - 1]
        for s in by_end[k]:
            if best[found.first[s]] + scores[s] > best[k]:
                best[k], back[k] = best[found.first[s]] + scores[s], s
    out: list[Span] = []
    k = n - 1
    while k > 0:
        s = back[k]
        if s < 0:
            k -= 1
        else:
            out.append((KINDS[found.kind[s]], found.edges[found.first[s]], found.edges[found.last[s]]))
            k = int(found.first[s])
    return out[::-1]


def all_spans(text: str, weights: np.ndarray) -> tuple[list[Span], list[Span]]:
    """The base spans, and all spans in the same order."""
    base = base_spans(text)
    more = [s for a, b in stretches(text, base) for s in decode(text, a, b, weights, margin=1.0)]
    return base, sorted([*base, *more], key=lambda s: (KINDS.index(s[0]), s[1], s[2])) if more else base


def disguise(kind: str, span: str, chance: random.Random) -> str:
    """The span as somebody would hide it from the base patterns."""
    if kind == "email":
        at = chance.choice([" at ", " (at) ", "[at]", " [at] ", "(at)", " @ "])
        plain_dots = at.strip()[0] in "([" and chance.random() < 0.3
        dot = chance.choice([" dot ", " (dot) ", "[dot]", " [dot] ", "(dot)"])
        name, _, domain = span.partition("@")
        if chance.random() < 0.5:  # people's addresses are plainer than generated ones
            name, domain = re.sub(r"[0-9]+", "", name).strip(".") or name, re.sub(r"[0-9]+", "", ".".join(domain.split(".")[-2:]))
        return name + at + (domain if plain_dots else domain.replace(".", dot))
    if kind == "ip":
        if chance.random() < 0.5:
            span = ".".join(str(int(256 ** chance.random()) - 1) for _ in range(4))
        return span.replace(".", chance.choice(["[.]", "(.)", " . ", "-"]))
    if kind == "card":
        digits = _digits(span)
        return chance.choice([".", "/", "_", " - "]).join(digits[k : k + 4] for k in range(0, len(digits), 4))
    digits = _digits(span)
    area, middle, last = digits[-10:-7], digits[-7:-4], digits[-4:]
    return chance.choice([f"({area}) {middle}-{last}", f"{area}-{middle}-{last}", f"{area}.{middle}.{last}", f"{area} {middle} {last}"])


def plain(chance: random.Random) -> str:
    """A number that is no personal data: amounts, dates, versions, ids, codes."""
    d = lambda n: "".join(chance.choice("0123456789") for _ in range(n))
    return chance.choice([
        lambda: f"{chance.randint(1, 999)},{d(3)},{d(3)}", lambda: f"20{d(2)}-0{chance.randint(1, 9)}-{chance.randint(10, 28)}",
        lambda: f"{chance.randint(10, 28)}/0{chance.randint(1, 9)}/20{d(2)}", lambda: f"20{d(2)}-0{chance.randint(1, 9)}-{chance.randint(10, 28)} {chance.randint(10, 23)}:{d(2)}:{d(2)}",
        lambda: d(chance.randint(7, 24)), lambda: f"{d(4)}-{d(4)}", lambda: f"{d(5)}.{d(6)}", lambda: f"{chance.randint(300, 999)}.{d(2)}.{d(3)}.{d(4)}",
        lambda: f"{d(3)}-{d(1)}-{d(2)}-{d(6)}-{d(1)}", lambda: f"1, 2, 3, {d(2)}, {d(2)}, {d(3)}", lambda: f"{d(4)} {d(4)} {d(4)} {d(3)}", lambda: f"{d(2)}:{d(2)}:{d(2)}.{d(3)}",
    ])()


def examples(spans: list[tuple[str, str]], seed: int = 7) -> list[tuple[str, int, int, list[Span]]]:
    """Training stretches from base spans: each disguised twice, and as many plain numbers, between words."""
    chance, out = random.Random(seed), []

    def add(body: str, own: list[Span]) -> None:
        before, after = chance.choice(["", "on ", "a ", "\n", "is: "]), chance.choice(["", " or", ".", ", a", "\nIn"])
        k = len(before)
        out.append((before + body + after, k, k + len(body), [(kind, a + k, b + k) for kind, a, b in own]))

    for kind, span in spans:
        for _ in range(2):
            hidden, number = disguise(kind, span, chance), plain(chance)
            add(hidden, [(kind, 0, len(hidden))])
            add(number, [])
            if chance.random() < 0.3 and kind != "email":
                add(f"{number}, {hidden}", [(kind, len(number) + 2, len(number) + 2 + len(hidden))])
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> np.ndarray:
    """Weights of the random field from the base spans of at most ``sample`` rows that have some.

    Without any base span the weights are zero and the field adds nothing.
    """
    own = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")).where(F.col("t").rlike("@|[0-9]{3}"))

    def run(batches):
        for batch in slices(batches):
            each = [[f"{k}\t{t[a:b]}" for k, a, b in base_spans(t) if b - a <= 80] for t in str_texts(batch, "t")]
            keep = pa.array([bool(x) for x in each], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(each, pa.list_(pa.string()))], names=["i", "s"]).filter(keep)

    rows = bounded_sample(stage(arrow_map(own, run, "i string, s array<string>")).withColumn("s", F.slice(F.array_sort("s"), 1, 4)), sample, "i", "s").collect()
    rng = random.Random(11)
    spans = sorted({tuple(x.split("\t", 1)) for r in rows for x in r["s"]})
    return train(examples(rng.sample(spans, min(len(spans), TAUGHT))))


def find_pii(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, base, spans)`` for every row of ``docs``: lists of ``(kind, start, end)``.

    Positions are code points, ``end`` is exclusive; spans are in order of kind (e-mail, IP, card,
    phone), then start. Null counts as an empty text. Repeated rows are each returned; an empty table
    gives an empty result; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in slices(batches):
            found = [all_spans(t, shared.value) for t in str_texts(batch, "t")]
            lists = [pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in one[c]] for one in found], kind) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("i"), *lists], names=["i", "base", "spans"])

    picked = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t"))
    each = "array<struct<kind:string,start:long,end:long>>"
    out = arrow_map(picked, run, f"i {picked.schema['i'].dataType.simpleString()}, base {each}, spans {each}")
    return out.withColumnRenamed("i", id_col)


def digest_columns(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS]
    return found.select(id_col, *counts, F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))
