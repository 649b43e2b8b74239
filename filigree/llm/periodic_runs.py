"""Runs of words that repeat with a period, found by catching squares online in dyadic blocks.

A square is a stretch of words that stands twice in a row; squares of one period next to each other
merge into a run. Words are appended one after another. On level ``k`` every completed block of
``B = 2 ** k`` words becomes a catcher, which waits for its own words to come back ``2 B - 1`` to
``4 B - 2`` words later: any square with such a period holds a whole block in its first half. Each
appended word completes one suffix of ``B`` words on every level, and at these distances only two
catchers are waiting for it, so a word costs two comparisons a level. Suffixes are compared by a
polynomial hash, which never misses equal ones. Caught blocks of one period that follow each other
form a chain; when a chain ends, it is lengthened word by word (less than one block on either side),
checked word by word and, if it is long enough, reported as a run. Chains inside a run whose period
divides theirs bring nothing new.

Texts of a batch are appended one after another with a word of its own behind each, which no run can
cross. What a word gives does not depend on how many are appended at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree.llm.common import arrow_map, slices, split

LEAST_LENGTH, LEAST_EXPONENT = 24, 3
AT_ONCE = 1 << 17
SPACE = " \t\n\x0b\f\r"
RESULT = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mixed(ids: np.ndarray) -> np.ndarray:
    """A 64-bit value for each word number."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def _powers(base: int, first: int, n: int) -> np.ndarray:
    """``first * base ** k`` for ``k`` below ``n``, modulo 2 ** 64."""
    steps = np.full(n, base, np.uint64)
    steps[:1] = first
    return np.cumprod(steps, dtype=np.uint64)


class Catchers:
    """The runs of a growing sequence of word numbers: ``append`` words, then ``finish``; see ``runs``.

    ``longest`` may bound the number of words in which a run can lie (that of the longest text).
    """

    def __init__(self, least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT, longest: int | None = None):
        self.least_length, self.least_exponent, self.longest = least_length, max(2, least_exponent), longest
        self.words = np.zeros(0, np.int32)
        self.sums, self.scale = np.zeros(1, np.uint64), np.ones(1, np.uint64)
        self.next_power = 1
        self.pending: dict[int, np.ndarray] = {}
        self.found: dict[tuple[int, int], int] = {}
        self.reach, self.own = np.zeros(0, np.int64), np.ones(0, np.int64)  # end and period of a run over each word

    def append(self, ids: np.ndarray) -> None:
        """Add words at the end; every completed suffix meets the catchers that wait for it."""
        for start in range(0, len(ids), AT_ONCE):
            self._grow(ids[start : start + AT_ONCE])

    def finish(self) -> None:
        """No word follows: chains still open end here."""
        for level in sorted(self.pending):
            self._report(1 << level, self.pending.pop(level))

    @property
    def runs(self) -> list[tuple[int, int, int]]:
        """``(start, length, period)`` by start and period, as far as ended."""
        return sorted((s, e - s, p) for (s, e), p in self.found.items())

    def _grow(self, ids: np.ndarray) -> None:
        before, n = len(self.words), len(ids)
        self.words = np.concatenate([self.words, ids.astype(np.int32)])
        powers = _powers(_BASE, self.next_power, n + 1)
        self.next_power = int(powers[-1])
        self.sums = np.concatenate([self.sums, self.sums[-1] + np.cumsum(_mixed(ids) * powers[:-1], dtype=np.uint64)])
        self.scale = np.concatenate([self.scale, _powers(_INVERSE, int(self.scale[-1]) * _INVERSE % (1 << 64), n)])
        self.reach, self.own = np.concatenate([self.reach, np.zeros(n, np.int64)]), np.concatenate([self.own, np.ones(n, np.int64)])
        level, block = 0, 1
        while 3 * block - 1 <= len(self.words) and (self.longest is None or 4 * block - 2 <= self.longest):
            self._advance(level, block, before)
            level, block = level + 1, 2 * block

    def _suffixes(self, starts: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the stretches of ``size`` words, alike wherever they start."""
        return (self.sums[starts + size] - self.sums[starts]) * self.scale[starts]

    def _advance(self, level: int, block: int, before: int) -> None:
        """Compare the suffixes completed by the words from ``before`` on with the catchers of a level."""
        total = len(self.words)
        starts = np.arange(max(before - block + 1, 2 * block - 1), total - block + 1)
        chains = [self.pending.pop(level)] if level in self.pending else []
        if len(starts):
            own = self._suffixes(starts, block)
            near = (starts - (2 * block - 1)) // block
            first = max(0, int(near[0]) - 1)
            caught = self._suffixes(np.arange(first, int(near[-1]) + 1) * block, block)
            for place in (near, near - 1):
                hit = np.flatnonzero((place >= 0) & (own == caught[np.maximum(place - first, 0)]))
                at = place[hit] * block
                chains.append(np.stack([at, at + block, starts[hit] - at]))
        if not chains:
            return
        merged = _merged(np.concatenate(chains, axis=1))
        open_ = merged[1] + merged[2] + block > total  # the next block's suffix is not complete yet
        if open_.any():
            self.pending[level] = merged[:, open_]
        self._report(block, merged[:, ~open_])

    def _report(self, block: int, chains: np.ndarray) -> None:
        """Lengthen the chains of a level that can be long enough, and keep those that are."""
        first, end, period = chains
        need = np.maximum((self.least_exponent - 1) * period, self.least_length - period)
        known = (self.reach[first] >= end + period) & (period % self.own[first] == 0)
        chains = chains[:, (end - first + 2 * (block - 1) >= need) & ~known]
        rows = max(1, (1 << 20) // block)
        for k in range(0, chains.shape[1], rows):
            first, end, period = chains[:, k : k + rows]
            left = self._agreeing(first[:, None] - 1 - np.arange(block - 1), period)
            right = self._agreeing(end[:, None] + np.arange(block - 1), period)
            for x, y, p in zip((first - left).tolist(), (end + right).tolist(), period.tolist(), strict=True):
                self._keep(x, y, p)

    def _agreeing(self, places: np.ndarray, period: np.ndarray) -> np.ndarray:
        """How many words of each row of ``places``, from its beginning, come back a period later."""
        later = places + period[:, None]
        inside = (places >= 0) & (later < len(self.words))
        same = inside & (self.words[np.maximum(places, 0)] == self.words[np.minimum(later, len(self.words) - 1)])
        return np.logical_and.accumulate(same, axis=1).sum(axis=1)

    def _keep(self, first: int, end: int, period: int) -> None:
        """A stretch whose words come back a period later; words that only hash alike part it."""
        need = max((self.least_exponent - 1) * period, self.least_length - period)
        same = self.words[first:end] == self.words[first + period : end + period]
        if not same.all():
            cuts = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
            for x, y in cuts.reshape(-1, 2).tolist():
                self._keep(first + x, first + y, period)
        elif end - first >= need and period < self.found.get((first, end + period), period + 1):
            self.found[first, end + period] = period
            over = slice(first, end + period)
            longer = self.reach[over] < end + period
            self.reach[over][longer], self.own[over][longer] = end + period, period


def _merged(chains: np.ndarray) -> np.ndarray:
    """Chains ``(first, end, period)`` with those of a period that touch put together."""
    first, end, period = chains[:, np.lexsort((chains[0], chains[2]))]
    new = np.ones(len(first), bool)
    new[1:] = (period[1:] != period[:-1]) | (first[1:] != end[:-1])
    last = np.append(new[1:], True) if len(new) else new
    return np.stack([first[new], end[last], period[new]])


def text_runs(ids: np.ndarray, sizes: np.ndarray, least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """The runs ``(start, length, period)`` of every text; ``ids`` are the words of all, ``sizes`` their numbers."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    catchers = Catchers(least_length, least_exponent, int(sizes.max(initial=0)))
    ends = np.cumsum(sizes)
    own = int(ids.max(initial=-1)) + 1 + np.arange(len(sizes))  # a word of its own behind each text
    catchers.append(np.insert(ids, ends, own))
    catchers.finish()
    starts = ends - sizes + np.arange(len(sizes))
    for start, length, period in catchers.runs:
        text = int(np.searchsorted(starts, start, "right")) - 1
        out[text].append((start - int(starts[text]), length, period))
    return out


def _rows(batch: pa.RecordBatch, least_length: int, least_exponent: int) -> list[pa.Array]:
    words, sizes = split(batch.column("t"))
    ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int32)
    runs = text_runs(ids, sizes, least_length, least_exponent)
    starts, keep = np.cumsum(sizes) - sizes, np.ones(len(ids), bool)
    for place, own in zip(starts.tolist(), runs, strict=True):
        for start, length, period in own:
            keep[place + start + period : place + start + length] = False
    left = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([starts, [len(ids)]])]
    kept = pa.LargeListArray.from_arrays(pa.array(left, pa.int64()), words.filter(pa.array(keep)).cast(pa.large_string()))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    listed = [[{"start": s, "length": n, "period": p} for s, n, p in own] for own in runs]
    return [pa.array(sizes, pa.int64()), pa.array(listed, kind), pc.binary_join(kept, pa.scalar(" ", pa.large_string())).cast(pa.string())]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> DataFrame:
    """``(id_col, n_words, runs, collapsed)`` for every row of ``docs``.

    ``runs`` lists ``(start, length, period)`` by start, then period: the stretches of words with a
    smallest period, at least ``least_length`` words and ``least_exponent`` (2 or more) periods long,
    that no neighbouring word lengthens. ``collapsed`` is the text, joined by single spaces, without
    the words that stand in a run after its first period. Null and blank texts have no words. Rows
    are handled each by itself, so repeated rows and rows without an id are nothing special. An
    empty table gives an empty result; other columns are not read.
    """
    picked = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("i"), *_rows(batch, least_length, least_exponent)], names=["i", "n_words", "runs", "collapsed"])

    return arrow_map(picked, run, f"i {picked.schema['i'].dataType.simpleString()}, {RESULT}").withColumnRenamed("i", id_col)


def with_planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, text_col)`` with the query's planted repetitions: a tenth of the ids, drawn by CRC-32, gets a periodic end."""
    h = F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8"))
    trimmed = F.trim(F.col(text_col), F.lit(SPACE))
    words = F.when((h % 10 == 0) & (F.length(trimmed) > 0), F.split(trimmed, "[ \t-\r]+"))
    drawn = docs.select(F.col(id_col), F.col(text_col), F.floor(h / 10).alias("g"), words.alias("w"))
    sized = drawn.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    sized = sized.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    planted = F.expr("array_join(transform(w, (x, i) -> if(i < a, x, w[cast(a + (i - a) % p as int)])), ' ')")
    return sized.select(id_col, F.when(F.col("w").isNotNull(), planted).otherwise(F.col(text_col)).alias(text_col))


def strongest(runs: Column) -> Column:
    """The run of greatest length for its period, of equal ones the first; null without runs."""
    better = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    return F.aggregate(runs, F.get(runs, 0), lambda best, x: F.when(better(x, best), x).otherwise(best))


def digest_columns(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of runs, the strongest one, and digests of all runs and of the collapsed text."""
    best = found.withColumn("best", strongest(F.col("runs")))
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    milli = F.expr("best.length * 1000 div best.period")
    return best.select(id_col, F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", milli.alias("exponent_milli"), sha(listed).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"))
