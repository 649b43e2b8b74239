"""Token counts by rank-synchronous array merging, equal to the library's BPE.

A text is cut where no piece of the vocabulary spans the cut: before a run of word marks and around
line ends. The distinct pre-tokens of a batch that a worker has not seen yet are held as one ragged
array of piece ids. In each step every sequence merges its lowest-rank pair, the leftmost of equal
ones; a merge can make a pair of lower rank than those that remain, so that one merge for each
sequence and step is what keeps the result equal to the library's. Sequences without a pair left the
step before are finished; what survives is counted, a character outside the vocabulary as its bytes.

The steps of a sequence grow with its length, so sequences beyond ``LONG`` symbols take a queue of
pairs instead, which gives the same count.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.llm.common import arrow_map, slices

MARK = "▁"
LIMIT = 4096
LONG = 256
REMEMBERED = 600_000
NONE = np.int32(2**31 - 1)


class Pieces:
    """The vocabulary as arrays: ids of characters, mergeable pairs with their rank and result."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        own = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        pieces = {model.id_to_piece(i): model.get_score(i) for i in own}
        self.ids = {p: k for k, p in enumerate(pieces)}
        parts = {c for p in pieces for c in p} | {p[:k] for p in pieces for k in range(1, len(p))} | {p[k:] for p in pieces for k in range(1, len(p))}
        self.known = len(self.ids)
        for c in sorted(x for x in parts if len(x) == 1 and x not in self.ids):
            self.ids[c] = len(self.ids)
        self.base = len(self.ids) + 1  # the last id stands for any other character
        ranks = {s: k for k, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        found = []
        for p, score in pieces.items():
            for k in range(1, len(p)):
                a, b = self.ids.get(p[:k]), self.ids.get(p[k:])
                if a is not None and b is not None:
                    found.append((a * self.base + b, ranks[score], self.ids[p]))
        table = np.array(sorted(found), np.int64).reshape(-1, 3)
        self.keys, self.ranks, self.merged = table[:, 0].copy(), table[:, 1].astype(np.int32), table[:, 2].astype(np.int64)
        self.pairs = {int(k): (int(r), int(m)) for k, r, m in table}
        inside = {p[k : k + 2] for p in pieces for k in range(len(p) - 1)}
        if any(x[1] == MARK != x[0] for x in inside) or any("\n" in x for x in inside):
            raise ValueError("a piece of this vocabulary spans a word mark or a line end")

        points = np.arange(0x110000)
        self.by_point = np.full(len(points), self.base - 1, np.int32)
        for c, k in self.ids.items():
            if len(c) == 1:
                self.by_point[ord(c)] = k
        self.extra = np.where(self.by_point >= self.known, (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF), 0)

    def symbols(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One ragged array of ids, its lengths, and what characters outside the vocabulary add to each count."""
        points = np.frombuffer("".join(tokens).encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        extra = np.add.reduceat(self.extra[points], np.cumsum(lengths) - lengths, dtype=np.int64)
        return self.by_point[points].astype(np.int64), lengths, extra

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places in the pair table; -1 where a pair does not merge."""
        keys = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def merge_all(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Surviving symbols of each sequence."""
        counts = lengths.copy()
        owner = np.repeat(np.arange(len(lengths)), lengths)
        ids = ids.copy()
        place = self._places(ids, owner)
        while len(ids):
            rank = np.where(place >= 0, self.ranks[place], NONE)
            heads = np.flatnonzero(np.diff(owner, prepend=-1))
            sizes = np.diff(np.append(heads, len(ids)))
            least = np.repeat(np.minimum.reduceat(rank, heads), sizes)
            chosen = np.flatnonzero((rank == least) & (least != NONE))
            chosen = chosen[np.diff(owner[chosen], prepend=-1) != 0]  # the leftmost of each sequence
            if not len(chosen):
                break
            ids[chosen] = self.merged[place[chosen]]
            counts[owner[chosen]] -= 1
            going = least != NONE
            going[chosen + 1] = False
            stale = np.zeros(len(ids), bool)
            stale[chosen] = True
            stale[np.maximum(chosen - 1, 0)] = True
            ids, owner, place, stale = ids[going], owner[going], place[going], stale[going]
            again = np.flatnonzero(stale)
            again = again[again < len(ids) - 1]
            place[again] = np.where(owner[again] == owner[again + 1], self.look_up(ids[again], ids[again + 1]), -1)
            if len(place):
                place[-1] = -1
        return counts

    def _places(self, ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
        place = np.full(len(ids), -1, np.int64)
        if len(ids) > 1:
            place[:-1] = np.where(owner[:-1] == owner[1:], self.look_up(ids[:-1], ids[1:]), -1)
        return place

    def merge_long(self, ids: list[int]) -> int:
        """Surviving symbols of one long sequence, by a queue of its pairs."""
        ids, after, before = list(ids), list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        alive, n = [True] * len(ids), len(ids)
        pairs, base = self.pairs, self.base
        queue = [(*pairs[k], i) for i in range(n - 1) if (k := ids[i] * base + ids[i + 1]) in pairs]
        queue = [(r, i, m) for r, m, i in queue]
        heapq.heapify(queue)
        left = n
        while queue:
            _, i, m = heapq.heappop(queue)
            j = after[i]
            if not alive[i] or j >= n or pairs.get(ids[i] * base + ids[j], (0, -1))[1] != m:
                continue
            ids[i], alive[j], after[i] = m, False, after[j]
            if after[i] < n:
                before[after[i]] = i
            left -= 1
            for a in (before[i], i):
                if a >= 0 and (b := after[a]) < n and (found := pairs.get(ids[a] * base + ids[b])):
                    heapq.heappush(queue, (found[0], a, found[1]))
        return left


_CUT = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")
_loaded: dict[str, tuple[Pieces, dict[str, int]]] = {}


def count_tokens(texts: list[str], pieces: Pieces, seen: dict[str, int]) -> list[int]:
    """Tokens of each text; ``seen`` remembers the counts of pre-tokens."""
    cut = [_CUT.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
    if len(seen) > REMEMBERED:
        seen.clear()
    fresh = list({p for own in cut for p in own if p not in seen})
    if fresh:
        ids, lengths, counts = pieces.symbols(fresh)
        long = lengths > LONG
        stops = np.cumsum(lengths)
        for k in np.flatnonzero(long):
            counts[k] += pieces.merge_long(ids[stops[k] - lengths[k] : stops[k]].tolist())
        counts[~long] += pieces.merge_all(ids[np.repeat(~long, lengths)], lengths[~long])
        seen.update(zip(fresh, counts.tolist(), strict=True))
    return [sum(map(seen.__getitem__, own)) for own in cut]


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """``(id_col, n_bytes, n_tokens, over_limit)`` for every row of ``docs``.

    ``path`` is the vocabulary file, present on every executor. Null counts as an empty text, which
    has no tokens. Repeated rows are each counted; an empty table gives an empty result; other
    columns are not read. A very long text costs time in proportion to its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _loaded:
            _loaded[path] = (Pieces(path), {})
        pieces, seen = _loaded[path]
        for batch in slices(batches, 2 << 20):
            texts = ["" if x is None else x for x in batch.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("i"), batch.column("n"), pa.array(count_tokens(texts, pieces, seen), pa.int64())], names=["i", "n", "k"])

    own = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t"))
    own = own.select("i", "t", F.coalesce(F.octet_length("t"), F.lit(0)).cast("long").alias("n"))
    kind = own.schema["i"].dataType.simpleString()
    counted = arrow_map(own, run, f"i {kind}, n long, k long")
    return counted.select(F.col("i").alias(id_col), F.col("n").alias("n_bytes"), F.col("k").alias("n_tokens"), (F.col("k") > limit).alias("over_limit"))
