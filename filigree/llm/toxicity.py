"""Toxicity of restored text: a noisy channel undoes leetspeak, spacing and repetition first.

1. *Language model.* Counts of character trigrams over all documents (28 symbols: boundary, a-z, any
   other letter), interpolated with bigrams and single characters.
2. *Decoding.* A word, or single letters parted by white space, becomes a lattice: each sign may
   stand for one of its letters or for nothing, a run of a letter for one or two, a gap for nothing
   or a word boundary. Viterbi finds the cheapest path under channel costs plus the language model.
   Words with a single path, letters none of which is doubled, are left as they are. Decodings are
   remembered by word.
3. *Score.* A logistic regression on the presence of words and word beginnings in the restored text.
   Its features stand out by their log-likelihood ratio on at most ``SAMPLE`` labelled rows outside
   the held-out fold.

Labels take part in fitting only; language, source and id are never looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.llm.common import arrow_map, bounded_sample, held_out, raw_texts, slices, stage, str_texts

SAMPLE = 6000
FEATURES = 512
PREFIXES = (4, 5, 6)
SYMBOLS = 28
REMEMBERED = 100_000
AT_ONCE = 1 << 20

# Letters that a sign can stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l"}
# Channel costs in nats.
AS_LETTER, DROPPED, EDGE_DROPPED, GAP_DROPPED, GAP_KEPT, ONE_OF_TWO, ONE_OF_MANY, TWO_OF_MANY = 1.0, 9.0, 0.5, 0.3, 1.5, 1.0, 0.7, 0.9

_CODE_OF_BYTE = np.array([c - 96 if 97 <= c <= 122 else c - 64 if 65 <= c <= 90 else 27 if c >= 128 else 0 for c in range(256)], np.int32)
_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
_DOUBLED = re.compile(r"(.)\1")
_EDGES = re.compile(r"^[^\w@$!|+€£]+|[^\w@$!|+€£]+$|([^\w\s])\1\1$")


def character_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Trigram counts of all texts, an array of 28 x 28 x 28."""
    size = SYMBOLS**3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in slices(batches):
            raw = b"  " + b" ".join(raw_texts(batch, "t")) + b" "
            for start in range(0, len(raw) - 2, AT_ONCE):  # a long text is a slice of its own
                codes = _CODE_OF_BYTE[np.frombuffer(raw, np.uint8, min(AT_ONCE + 2, len(raw) - start), start)]
                total += np.bincount((codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:], minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["gram", "n"])

    counted = arrow_map(docs.select(F.col(text_col).cast("string").alias("t")), run, "gram int, n long")
    out = np.zeros(size, np.int64)
    for row in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect():  # at most 28 ** 3 rows
        out[row[0]] = row[1]
    return out.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


def language_model(counts: np.ndarray) -> np.ndarray:
    """Costs ``-log P(c | a, b)``, interpolated so that no cost is infinite."""
    pair, single = counts.sum(0) + 0.0, counts.sum((0, 1)) + 1.0
    base = single / single.sum()
    two = (pair + 20 * base) / (pair.sum(1, keepdims=True) + 20)
    return -np.log((counts + 20 * two[None]) / (counts.sum(2, keepdims=True) + 20)).astype(np.float64)


def _code(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0


def lattice(stretch: str) -> list[list[tuple[str, float]]]:
    """For each run of equal characters, the strings it may stand for with their channel costs."""
    runs = [m.group(0) for m in re.finditer(r"(.)\1*", stretch, re.S)]
    out = []
    for k, run in enumerate(runs):
        c, n = run[0], len(run)
        if c.isalpha():
            out.append([(c, 0.0)] if n == 1 else [(c * 2, 0.0), (c, ONE_OF_TWO)] if n == 2 else [(c, ONE_OF_MANY), (c * 2, TWO_OF_MANY)])
        elif c in LEET:
            edge = k in (0, len(runs) - 1) and c in "!|+"
            letters = [(x * min(n, 2), AS_LETTER * min(n, 2)) for x in LEET[c]]
            out.append([*letters, ("", EDGE_DROPPED if edge else DROPPED * min(n, 2))])
        else:
            out.append([("", GAP_DROPPED), (" ", GAP_KEPT)])
    return out


def decode(stretch: str, costs: np.ndarray) -> str:
    """The cheapest reading of a disguised stretch (Viterbi over its lattice)."""
    best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for choices in [*lattice(stretch), [(" ", 0.0)]]:
        reached: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, before) in best.items():
            for piece, price in choices:
                x, y, total = a, b, cost + price
                for c in piece:
                    z = _code(c)
                    total += costs[x, y, z] if (y or z) else 0.0
                    x, y = y, z
                if (x, y) not in reached or total < reached[x, y][0]:
                    reached[x, y] = (total, (before, piece))
        best = reached
    _, last = min(best.values(), key=lambda x: x[0])
    pieces = []
    while last:  # pieces are linked, not joined, on the way, so that long words stay linear
        last, piece = last
        pieces.append(piece)
    return "".join(reversed(pieces)).strip()


class Restorer(dict):
    """Restored form by word; a word that is plain, or has one path only, is its lower-cased self."""

    def __init__(self, costs: np.ndarray):
        super().__init__()
        self.costs = costs

    def __missing__(self, word: str) -> str:
        core = _EDGES.sub("", word)
        if not core or core.isalpha() and not _DOUBLED.search(core):
            found = core
        else:
            found = decode(core, self.costs)
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = found
        return found

    def text(self, text: str) -> str:
        """The restored text: lower case, words parted by single spaces, one space at either end."""
        text = text.lower()
        joined = _SPACED.sub(lambda m: decode(" ".join(m[0].split()), self.costs), text) if _SPACED.search(text) else text
        return f" {' '.join(map(self.__getitem__, joined.split()))} "


def features(restored: str) -> set[str]:
    """Words (`` word ``) and word beginnings (`` begin``) of a restored text."""
    words = set(restored.split())
    return {f" {w} " for w in words} | {f" {w[:k]}" for w in words for k in PREFIXES if len(w) > k}


@dataclass
class Model:
    """What scoring needs; small whatever the corpus."""

    costs: np.ndarray
    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for f, w in self.weights.items():
            found.add_word(f, (f, w))
        if self.weights:
            found.make_automaton()
        return found


def score_text(restored: str, found: ahocorasick.Automaton, bias: float) -> float:
    present = dict(x for _, x in found.iter(restored)) if len(found) else {}
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, bias + sum(present.values())))))


def _ratio(n: np.ndarray, t: np.ndarray, rows: int, toxic: int) -> np.ndarray:
    """Log-likelihood ratio of a feature in ``n`` rows, ``t`` of them toxic."""
    p, q = t / np.maximum(n, 1), (toxic - t) / np.maximum(rows - n, 1)
    r = toxic / rows
    part = lambda k, m, x: k * np.log(np.maximum(x, 1e-12)) + (m - k) * np.log(np.maximum(1 - x, 1e-12))
    return 2 * (part(t, n, p) + part(toxic - t, rows - n, q) - part(t, n, r) - part(toxic - t, rows - n, r))


def choose(rows: list[tuple[int, list[str]]], tested: int, limit: int = FEATURES) -> list[str]:
    """Features whose ratio stands out among the ``tested`` ones, strongest first.

    Of features that begin alike, as a word and its beginnings do, the strongest is taken, and of
    equal ones the shortest, which covers most beyond the sample.
    """
    names = sorted({f for _, own in rows for f in own})
    at = {f: k for k, f in enumerate(names)}
    n, t = np.zeros(len(names)), np.zeros(len(names))
    for y, own in rows:
        places = [at[f] for f in own]
        n[places] += 1
        t[places] += y
    ratio = _ratio(n, t, len(rows), sum(y for y, _ in rows))
    strong = [k for k in range(len(names)) if t[k] > n[k] / 2 and ratio[k] >= 2 * math.log(max(2, tested)) + 2]
    out: list[str] = []
    for k in sorted(strong, key=lambda k: (-round(ratio[k], 9), len(names[k]), names[k])):
        if len(out) < limit and not any(names[k].startswith(f) or f.startswith(names[k]) for f in out):
            out.append(names[k])
    return out


def logistic(matrix: np.ndarray, labels: np.ndarray, ridge: float = 0.05, steps: int = 50) -> np.ndarray:
    """Weights, the bias last, by Newton's method."""
    x = np.hstack([matrix, np.ones((len(matrix), 1))])
    penalty = np.full(x.shape[1], ridge)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (labels - p) - penalty * w)
        w += move
        if np.abs(move).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """The model for ``docs``: character counts of all of them, weights from a bounded sample.

    Rows without id or label do not teach; of several labels of an id the largest counts. Without
    labelled rows, or with one class only, every text scores the share of toxic rows (0 if none).
    """
    costs = language_model(character_counts(docs, text_col))
    usable = labels.where(F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    marked = usable.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("y"))
    picked = stage(bounded_sample(marked, sample, "_id"))
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("t"))
    texts = own.join(F.broadcast(picked), "_id").dropDuplicates(["_id"]).select("y", "t")  # at most ``sample`` rows

    def run(batches):
        restorer = Restorer(costs)
        for batch in slices(batches):
            each = [sorted(features(restorer.text(x))) for x in str_texts(batch, "t")]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(each, pa.list_(pa.string()))], names=["y", "f"])

    rows = stage(arrow_map(texts, run, "y int, f array<string>").withColumn("row", F.monotonically_increasing_id()))
    seen = rows.agg(F.count("*"), F.sum("y")).first()
    n, toxic = int(seen[0]), int(seen[1] or 0)
    if not n or toxic in (0, n):
        share = toxic / n if n else 0.0
        return Model(costs, math.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    often = stage(rows.where("y = 1").select(F.explode("f").alias("f")).groupBy("f").agg(F.count("*").alias("t")).where("t >= 4"))
    flat = rows.select("row", "y", F.explode("f").alias("f")).join(often, "f")
    clear = flat.groupBy("f").agg(F.count("*").alias("n"), F.sum("y").alias("t")).where(F.col("t") > 0.5 * F.col("n"))
    clear = clear.orderBy(F.desc(F.col("t") * F.col("t") / F.col("n")), "f").limit(4 * FEATURES).select("f")
    carried = rows.select("row", F.explode("f").alias("f")).join(F.broadcast(clear), "f").groupBy("row").agg(F.collect_list("f").alias("f"))
    sampled = rows.select("row", "y").join(carried, "row", "left").select("y", "f").collect()  # at most ``sample`` rows
    table = [(int(r[0]), list(r[1] or [])) for r in sampled]
    names = choose(table, often.count())
    if not names:
        return Model(costs, math.log(toxic / (n - toxic)))
    matrix = np.array([[f in own for f in names] for own in (set(x) for _, x in table)], float)
    weights = logistic(matrix, np.array([y for y, _ in table], float))
    return Model(costs, float(weights[-1]), dict(zip(names, weights[:-1].tolist(), strict=True)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, held_out, score, predicted)`` for every row of ``docs``.

    Null counts as an empty text, which scores the bias. Rows without an id count as held out.
    Repeated rows score alike. An empty table gives an empty result; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own: Model = shared.value
        restorer, found = Restorer(own.costs), own.automaton()
        for batch in slices(batches):
            scores = [score_text(restorer.text(x), found, own.bias) for x in str_texts(batch, "t")]
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(scores, pa.float64())], names=["i", "score"])

    picked = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t"))
    scored = arrow_map(picked, run, f"i {picked.schema['i'].dataType.simpleString()}, score double")
    return scored.select(F.col("i").alias(id_col), held_out(F.col("i")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def restore(docs: DataFrame, model: Model, text_col: str = "text", to: str = "restored") -> DataFrame:
    """``docs`` with the restored text as a further column ``to``, which must be a new name."""
    names = docs.columns
    if to in names:
        raise ValueError(f"{to} is a column already")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        restorer = Restorer(shared.value.costs)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([restorer.text(x).strip() for x in str_texts(batch, text_col)])], names=[*names, to])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return arrow_map(docs, run, f"{schema}, `{to}` string")


def drop_toxic(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns kept; also rows without an id."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own: Model = shared.value
        restorer, found = Restorer(own.costs), own.automaton()
        for batch in slices(batches):
            keep = [score_text(restorer.text(x), found, own.bias) < 0.5 for x in str_texts(batch, text_col)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return arrow_map(docs, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields))
