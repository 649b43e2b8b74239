"""SimHash near-duplicates: pivot distance tables over 64-bit fingerprints.

A fingerprint's row of the pivot table holds its Hamming distances to 65 reference fingerprints:
zero, and for each of four bands of 16 bits the 15 Walsh patterns and the full pattern of that band.
Two fingerprints that differ in at most two bits

* have distances to every pivot that differ by at most two (triangle inequality), and
* leave at least two bands untouched, so that the distances to these bands' pivots, taken relative
  to the distance to zero, are equal.

The second fact makes keys (one for each pair of bands) under which candidates meet, the first one
discards candidates by their largest coordinate difference, and the survivors are verified.

A key shared by more than ``PAIR_LIMIT`` fingerprints (a large group of near copies) is not paired.
Its fingerprints go by midpoints instead: two fingerprints differ in at most two bits exactly if
some value is within one bit of both, and at most 65 fingerprints are within one bit of a value. No
link is lost on that path either, and its rows grow with the fingerprints, not with their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.llm.common import arrow_map, raw_texts, slices, stage
from filigree.llm.components import connected_components

SEED, SHINGLE, MAX_BITS = 42, 3, 2
BANDS, WIDTH = 4, 16
PAIR_LIMIT = 32
LANES = np.uint64(0x0101010101010101)
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits set; eight byte-wide counters are added at a time."""
    out = np.zeros(64, np.int64)
    at = np.arange(0, len(hashes), 255)
    for j in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(j)) & LANES, at)
        out[j::8] += sums.view(np.uint8).reshape(-1, 8).sum(0, dtype=np.int64)
    return out


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of a text in UTF-8; zero if it has no word."""
    words = raw.lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(text, SEED)
    gaps = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(text))
    n = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    hashes = np.fromiter((digest(text[i:j], SEED) for i, j in spans), np.uint64, n)
    bits = bit_counts(hashes) * 2 > n
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, fp)`` for every row; ``fp`` holds the fingerprint's 64 bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([fingerprint(x) for x in raw_texts(batch, "t")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(fps)], names=["i", "fp"])

    picked = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t"))
    kind = picked.schema["i"].dataType.simpleString()
    return arrow_map(picked, run, f"i {kind}, fp long").withColumnRenamed("i", id_col)


@cache
def pivots() -> np.ndarray:
    """The reference fingerprints: zero, then 16 for each band."""
    rows = [sum((bin(i & r).count("1") & 1) << i for i in range(WIDTH)) for r in range(1, WIDTH)]
    band = [*rows, (1 << WIDTH) - 1]
    return np.array([0, *(w << (WIDTH * b) for b in range(BANDS) for w in band)], np.uint64)


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to each pivot."""
    return np.bitwise_count(fps.view(np.uint64)[:, None] ^ pivots()[None, :])


def band_keys(fps: np.ndarray) -> np.ndarray:
    """For each pair of bands a 64-bit key of the relative distances to their pivots."""
    table = pivot_table(fps)
    relative = (table[:, 1:].astype(np.int8) - table[:, :1].astype(np.int8)).reshape(len(fps), BANDS, WIDTH)
    out = []
    for k, (a, b) in enumerate(combinations(range(BANDS), 2)):
        words = np.ascontiguousarray(relative[:, (a, b)]).reshape(len(fps), -1).view(np.uint64)
        key = np.full(len(fps), k + 1, np.uint64)
        for c in range(words.shape[1]):
            key = (key ^ words[:, c]) * MIX[c]
            key ^= key >> np.uint64(29)
        out.append(key)
    return np.stack(out, axis=1)


def _keyed(nodes: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            keys = band_keys(fps)
            each = keys.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(fps, each))], names=["key", "fp"])

    return arrow_map(nodes.select("fp"), run, "key long, fp long")


def close_pairs(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of a small block that differ in at most ``MAX_BITS`` bits."""
    a, b = np.triu_indices(len(fps), 1)
    table = pivot_table(fps).astype(np.int16)
    near = np.abs(table[a] - table[b]).max(axis=1) <= MAX_BITS
    a, b = a[near], b[near]
    same = np.bitwise_count(fps.view(np.uint64)[a] ^ fps.view(np.uint64)[b]) <= MAX_BITS
    return a[same], b[same]


def _pairs(blocks: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            lefts, rights = [], []
            for fps in batch.column("fps").to_pylist():
                block = np.array(sorted(set(fps)), np.int64)
                a, b = close_pairs(block)
                lefts.append(block[a])
                rights.append(block[b])
            if lefts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(lefts)), pa.array(np.concatenate(rights))], names=["a", "b"])

    return arrow_map(blocks.select("fps"), run, "a long, b long")


def links(nodes: DataFrame, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Links ``(a, b)`` that connect exactly the fingerprints of ``nodes(fp)`` within two bits."""
    keyed = _keyed(nodes)
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = keyed.join(sizes, "key")
    blocks = members.where(F.col("n") <= pair_limit).groupBy("key").agg(F.collect_list("fp").alias("fps"))
    hot = members.where(F.col("n") > pair_limit).select("fp").distinct()
    flips = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.expr("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    spread = hot.select("fp", F.explode(F.concat(F.array("fp"), flips)).alias("midpoint"))
    stars = spread.groupBy("midpoint").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1")
    around = stars.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return _pairs(blocks).unionByName(around)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, fingerprint, component_id)`` for every row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits, ``component_id`` the smallest id reachable over
    links of at most two differing bits. Null and empty texts have fingerprint zero and are linked
    like any other; repeated rows and ids are each returned; a null id is never the smallest one
    unless its whole group has null ids. Other columns of ``docs``, whatever their names, are not
    read. An empty table gives an empty result.
    """
    prints = stage(fingerprints(docs, id_col, text_col).withColumnRenamed(id_col, "_id"))
    nodes = stage(prints.groupBy("fp").agg(F.min("_id").alias("first")))
    found = stage(connected_components(links(nodes)))
    labelled = nodes.join(found, nodes.fp == found.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    tops = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    each = labelled.join(tops, "component").select("fp", "component_id")
    out = prints.join(each, "fp")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return out.select(F.col("_id").alias(id_col), hexed.alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group, all columns kept.

    Rows without an id stay only where a whole group has none; rows that repeat the smallest id all
    stay, as ids name documents.
    """
    groups = near_duplicates(docs, id_col, text_col)
    keep = stage(groups.select("component_id").distinct()).withColumnRenamed("component_id", "_keep")
    # The ids kept grow with the documents, so they are never broadcast, however few they are.
    return docs.join(keep.hint("merge"), docs[id_col].eqNullSafe(keep["_keep"]), "left_semi")
