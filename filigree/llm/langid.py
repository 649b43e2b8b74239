"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Texts are lower-cased, anything but letters becomes one boundary, and n-grams of one to three
characters are hashed into ``BUCKETS``. Document frequencies count all documents outside the held-out fold. The weights are
learned by follow-the-regularised-leader with elastic-net penalties, which leaves most of them zero,
on at most ``SAMPLE`` labelled rows outside the held-out fold; a fifth of these rows sets the
temperature instead.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.llm.common import arrow_map, bounded_sample, held_out, slices, stage, str_texts

BUCKETS = 1 << 15
SAMPLE = 4000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1
CHUNK = 1 << 18
UNKNOWN = "und"


@cache
def _is_letter() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def bucket_counts(text: str) -> np.ndarray | None:
    """How often each bucket's n-grams occur in a text; None if it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[points]
    if not letter.any():
        return None
    keep = letter | np.append(True, letter[:-1])
    codes = np.concatenate([[0], np.where(letter, points, 0)[keep], [0]]).astype(np.uint32)
    out = np.zeros(BUCKETS, np.int64)
    for start in range(0, len(codes), CHUNK):  # a bounded piece at a time; pieces overlap by two
        c = codes[start : start + CHUNK + 2]
        one = c * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ (c[1:] * np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35)
        three = (two[:-1] ^ (c[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
        for grams in (one[:CHUNK], two[:CHUNK], three[:CHUNK]):
            out += np.bincount(grams >> np.uint32(17), minlength=BUCKETS)
    return out


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[int, np.ndarray]:
    """Documents with letters, and how many of them have each bucket; over all of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1, np.int64)
        for batch in slices(batches):
            for text in str_texts(batch, "t"):
                counts = bucket_counts(text)
                if counts is not None:
                    total[:-1] += counts > 0
                    total[-1] += 1
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["bucket", "n"])

    counted = arrow_map(docs.select(F.col(text_col).cast("string").alias("t")), run, "bucket int, n long")
    out = np.zeros(BUCKETS + 1, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS + 1 rows
        out[row[0]] = row[1]
    return int(out[-1]), out[:-1]


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text and their values, of length one."""
    at = np.flatnonzero(counts)
    values = (1 + np.log(counts[at])) * idf[at]
    return at, (values / max(math.sqrt(float(values @ values)), 1e-12)).astype(np.float32)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


class Leader:
    """Follow-the-regularised-leader (proximal) for a multinomial model, one example at a time."""

    def __init__(self, buckets: int, classes: int):
        self.z, self.n = np.zeros((buckets + 1, classes)), np.zeros((buckets + 1, classes))

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z = self.z[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(at)
        miss = softmax(values @ w)
        miss[label] -= 1
        g = values[:, None] * miss[None]
        more = np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])
        self.z[at] += g - more / ALPHA * w
        self.n[at] += g * g


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets and the bias, by class
    temperature: float = 1.0

    def predict(self, text: str) -> tuple[str, float]:
        counts = bucket_counts(text)
        if counts is None or not self.langs:
            return UNKNOWN, 0.0
        at, values = tf_idf(counts, self.idf)
        p = softmax((values @ self.weights[at] + self.weights[-1]) / self.temperature)
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature under which held-back rows are likeliest, by golden section on its logarithm."""

    def loss(t: float) -> float:
        z = logits / math.exp(t)
        z = z - z.max(1, keepdims=True)
        return float((np.log(np.exp(z).sum(1)) - z[np.arange(len(z)), labels]).mean())

    low, high, ratio = math.log(0.02), math.log(20), (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """The model for ``docs``. Rows without id, text, letters or language do not teach.

    Without any teaching row every prediction is ``und``; with one language, it is that language.
    """
    n, df = document_frequencies(docs.where(~held_out(F.col(id_col))), text_col)
    idf = np.log((1 + n) / (1 + df)) + 1
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("t"), F.col(lang_col).alias("lang"))
    usable = own.where(F.col("lang").isNotNull() & F.col("t").isNotNull() & ~held_out(F.col("_id")))
    ids = stage(bounded_sample(usable.select("_id", "lang"), sample, "_id", "lang"))
    texts = usable.join(F.broadcast(ids.distinct()), ["_id", "lang"]).dropDuplicates(["_id", "lang"]).select("lang", "t", "_id")

    def run(batches):
        for batch in slices(batches):
            rows = [(lang, i, *tf_idf(c, idf)) for lang, i, t in zip(batch.column("lang").to_pylist(), batch.column("_id").to_pylist(), str_texts(batch, "t"), strict=True) if (c := bucket_counts(t)) is not None]
            columns = [pa.array([r[0] for r in rows], pa.string()), pa.array([str(r[1]) for r in rows], pa.string()), pa.array([r[2].astype("<u2").tobytes() for r in rows], pa.binary()), pa.array([r[3].astype("<f4").tobytes() for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "i", "at", "v"])

    vectors = stage(arrow_map(texts, run, "lang string, i string, at binary, v binary"))
    rows = vectors.orderBy(F.crc32(F.encode("i", "UTF-8")), "i").collect()  # at most ``sample`` rows, numbers only
    langs = sorted({r["lang"] for r in rows})
    place = {x: k for k, x in enumerate(langs)}
    data = [(np.append(np.frombuffer(r["at"], "<u2").astype(np.int64), BUCKETS), np.append(np.frombuffer(r["v"], "<f4"), np.float32(1)), place[r["lang"]]) for r in rows]
    cut = max(1, len(data) * 4 // 5)
    leader = Leader(BUCKETS, max(1, len(langs)))
    for _ in range(EPOCHS if len(langs) > 1 else 0):
        for at, values, label in data[:cut]:
            leader.learn(at, values, label)
    model = Model(langs, idf, leader.weights(slice(None)).astype(np.float32))
    if len(langs) > 1 and len(data) > cut:
        logits = np.array([v @ model.weights[at] for at, v, _ in data[cut:]], np.float64)
        model.temperature = temperature(logits, np.array([y for *_, y in data[cut:]]))
    return model


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, held_out, lang_pred, score)`` for every row of ``docs``.

    ``score`` is the calibrated probability of ``lang_pred``. A text that is null or has no letter is
    ``und`` with score zero. Rows without an id count as held out. Repeated rows are each returned;
    an empty table gives an empty result; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches):
            found = [shared.value.predict(x) for x in str_texts(batch, "t")]
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array([x for x, _ in found], pa.string()), pa.array([p for _, p in found], pa.float64())], names=["i", "lang_pred", "score"])

    picked = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t"))
    out = arrow_map(picked, run, f"i {picked.schema['i'].dataType.simpleString()}, lang_pred string, score double")
    return out.select(F.col("i").alias(id_col), held_out(F.col("i")).alias("held_out"), "lang_pred", "score")
