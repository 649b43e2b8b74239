"""Benchmark decontamination: one Aho-Corasick automaton over the test items, one pass over each text.

Both sides are normalised alike: A-Z lower-cased, words of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``
joined by single spaces. The patterns are the items' windows of ten words (an item of fewer words is
one window) with a space on either side, so that matches begin and end with words. The byte-for-byte
translation keeps positions, which maps a hit back to code points of the original text.

The benchmark is a stated query set. Its windows go to the tasks in blocks of at most
``BLOCK_BYTES`` of item text: one automaton of known size at a time. One block is the usual case and
needs no shuffle; with several, the hits found by the passes over the blocks are put together by row.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.llm.common import arrow_map, raw_texts, slices, stage

WINDOW = 10
BLOCK_BYTES = 4 << 20
_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEEP else 0x20 for c in range(256))
_HITS = "array<struct<first:int,last:int>>"
_SPANS = "array<struct<start:long,end:long>>"
_built: dict[str, ahocorasick.Automaton] = {}


def words(raw: bytes) -> list[str]:
    return [w.decode("utf-8", "replace") for w in raw.translate(_TABLE).split()]


def windows(items: list[tuple[str, bytes]], size: int = WINDOW) -> dict[str, list[str]]:
    """Item ids by window; an item without words has no window."""
    out: dict[str, set[str]] = defaultdict(set)
    for item, raw in items:
        own = words(raw)
        for k in range(max(1, len(own) - size + 1) if own else 0):
            out[" ".join(own[k : k + size])].add(item)
    return {w: sorted(ids) for w, ids in out.items()}


def automaton(patterns: dict[str, list[str]], name: str) -> ahocorasick.Automaton:
    """The automaton over ``patterns``; a worker keeps the last one it built."""
    if name not in _built:
        found = ahocorasick.Automaton()
        for window, items in patterns.items():
            found.add_word(f" {window} ", (window.count(" ") + 1, items))
        found.make_automaton()
        _built.clear()
        _built[name] = found
    return _built[name]


def scan(raw: bytes, found: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int]], list[str]]:
    """Number of words, runs of hit words as (first, last), ids of the items with a window here."""
    own = raw.translate(_TABLE).split()
    hits = list(found.iter(f" {b' '.join(own).decode('utf-8', 'replace')} ")) if own and len(found) else []
    if not hits:
        return len(own), [], []
    stops = np.cumsum([len(w.decode("utf-8", "replace")) + 1 for w in own])
    runs: list[tuple[int, int]] = []
    for last, length in sorted((int(np.searchsorted(stops, end)), n) for end, (n, _) in hits):
        first = last - length + 1
        while runs and runs[-1][1] >= first - 1:
            first = min(first, runs.pop()[0])
        runs.append((first, last))
    return len(own), runs, sorted({i for _, (_, items) in hits for i in items})


def original_spans(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code-point spans of the runs of words in the original text, end exclusive."""
    is_word = np.frombuffer(raw.translate(_TABLE), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(is_word, prepend=False, append=False))
    points = np.append(0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))
    return [(int(points[edges[2 * a]]), int(points[edges[2 * b + 1]])) for a, b in runs]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> list[list[tuple[str, bytes]]]:
    """The items in blocks of about ``BLOCK_BYTES``, fetched one after another."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    items = benchmark.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("i"), text.cast("binary").alias("t"))
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n = int(total // BLOCK_BYTES) + 1
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield [(r[0], bytes(r[1])) for r in part.collect()]


def _pass(docs: DataFrame, items: list[tuple[str, bytes]], size: int) -> DataFrame:
    patterns = windows(items, size)
    name = hashlib.sha256(repr(sorted(patterns.items())).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(patterns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(shared.value, name)
        for batch in slices(batches):
            counts, runs, spans, ids, marks = [], [], [], [], []
            for raw in raw_texts(batch, "t"):
                n, hit, items = scan(raw, found)
                counts.append(n)
                runs.append([{"first": a, "last": b} for a, b in hit])
                spans.append([{"start": a, "end": b} for a, b in (original_spans(raw, hit) if hit else [])])
                ids.append(items)
                marks.append(hashlib.blake2b(raw, digest_size=8).digest())
            pair = lambda a, b, kind: pa.list_(pa.struct([(a, kind), (b, kind)]))
            columns = [pa.array(counts, pa.int64()), pa.array(runs, pair("first", "last", pa.int32())), pa.array(spans, pair("start", "end", pa.int64())), pa.array(ids, pa.list_(pa.string())), pa.array(marks, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("i"), *columns], names=["i", "n_words", "hits", "spans", "items", "mark"])

    kind = docs.schema["i"].dataType.simpleString()
    return arrow_map(docs, run, f"i {kind}, n_words long, hits {_HITS}, spans {_SPANS}, items array<string>, mark binary")


def _together(passes: list[DataFrame]) -> DataFrame:
    """One row for each row of the first pass, with the hits of all passes."""
    first = stage(passes[0])
    rest = passes[1].where("size(hits) > 0")
    for p in passes[2:]:
        rest = rest.unionByName(p.where("size(hits) > 0"))
    found = rest.unionByName(first.where("size(hits) > 0")).dropDuplicates(["i", "mark", "items", "hits"])
    merged = found.groupBy(F.col("i").alias("_i"), F.col("mark").alias("_mark")).agg(*[F.flatten(F.collect_list(c)).alias(f"_{c}") for c in ("hits", "spans", "items")])
    joined = first.join(merged, first.i.eqNullSafe(merged._i) & (first.mark == merged._mark), "left")
    merge = """aggregate(array_sort(_{c}), cast(array() as {kind}), (done, x) ->
        if(size(done) > 0 and element_at(done, -1).{b} >= x.{a} - 1,
           concat(slice(done, 1, size(done) - 1), array(named_struct('{a}', element_at(done, -1).{a}, '{b}', greatest(element_at(done, -1).{b}, x.{b})))),
           concat(done, array(x))))"""
    hits = F.expr(merge.format(c="hits", kind=_HITS, a="first", b="last"))
    columns = {"hits": F.coalesce(hits, F.col("hits")), "spans": F.coalesce(F.array_sort("_spans"), F.col("spans")), "items": F.coalesce(F.array_sort(F.array_distinct("_items")), F.col("items"))}
    return joined.select("i", "n_words", *[c.alias(n) for n, c in columns.items()])


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``(id_col, n_words, n_hit, items, spans)`` for every row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of a window, ``items`` are the ids (as strings,
    in order) of the items with a window in the text, ``spans`` the hit runs of words as code points
    of the original text. Null and empty texts have no words. Items without id or words match
    nothing, repeated items count once, items with equal windows are all named. Repeated rows are
    each returned. Without items nothing is hit; without documents the result is empty. Other
    columns are not read.
    """
    own = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t"))
    passes = [_pass(own, items, window) for items in _blocks(benchmark, item_col, item_text_col)]
    out = passes[0] if len(passes) == 1 else _together(passes)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["last"] - x["first"] + 1)
    return out.select(F.col("i").alias(id_col), "n_words", n_hit.alias("n_hit"), "items", "spans")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, all columns kept."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    out = docs
    for k, items in enumerate(_blocks(benchmark, item_col, item_text_col)):
        patterns = windows(items, window)
        name = hashlib.sha256(repr(sorted(patterns.items())).encode()).hexdigest()
        shared = docs.sparkSession.sparkContext.broadcast(patterns)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            found = automaton(shared.value, name)
            for batch in slices(batches):
                clean = [not scan(raw, found)[1] for raw in raw_texts(batch, text_col)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        out = arrow_map(stage(out) if k else out, run, schema)
    return out


def digest_columns(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    listed = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select(id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), listed.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH b AS (SELECT item_id, {WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id::VARCHAR AS item, least(len(w), {WINDOW}) AS n, array_to_string(w[k:k + {WINDOW} - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
d AS (SELECT doc_id, {WORDS} AS w FROM documents),
pos AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n),
hit AS (SELECT a.doc_id, a.k, a.n, win.item FROM pos a JOIN win ON a.n = win.n AND array_to_string(a.w[a.k:a.k + a.n - 1], ' ') = win.s),
marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS listed FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN items USING (doc_id)
"""
