"""Per-group n-gram TF-IDF and label suggestions."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filigree.functions.numbers import round_half_away
from filigree.functions.text import distinct_texts
from filigree.operators.joins import by_shuffle
from filigree.operators.windows import top_per_group
from filigree.plans.sampling import sample_per_group
from filigree.session import cut_lineage

# Label hints in the order in which they are tried.
LABEL_HINTS = (
    ("Business / Overview", ("business", "segment", "customers", "products", "overview")),
    ("Risk Factors", ("risk", "risks", "adverse", "uncertain")),
    ("MD&A (Discussion & Analysis)", ("management", "discussion", "analysis", "operations", "md&a")),
    ("Financial Statements / Notes", ("consolidated", "statement", "net", "sales", "revenue", "income", "note")),
    ("Controls & Procedures", ("controls", "disclosure", "procedures", "internal control")),
    ("Legal / Exhibits", ("exhibit", "agreement", "incorporated", "reference", "schedule")),
)


def _gram_hashes(sizes: Sequence[int]):
    """The function tasks use to read texts: the hash of every n-gram, its text and its place, and the words.

    Texts are lower case; their tokens are ASCII, so every other byte parts words. A hash has 64 bits and includes
    the seed of the group.
    """

    def mixed(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB
        return x ^ (x >> 31)

    def read(texts: pa.Array, seed: int):
        from hashlib import blake2b

        import numpy as np
        import pyarrow.compute as pc

        keep = b"abcdefghijklmnopqrstuvwxyz0123456789%$."
        table = bytes(x if x in keep else 32 for x in range(256))
        plain = [x.translate(table) for x in texts.cast(pa.binary()).to_pylist()]
        cut = pc.ascii_split_whitespace(pa.array([x.decode() for x in plain], pa.large_string()))
        listed, owner = pc.list_flatten(cut), pc.list_parent_indices(cut)
        real = pc.not_equal(listed, "")
        coded = pc.dictionary_encode(listed.filter(real))
        owner = owner.filter(real).to_numpy(zero_copy_only=False)
        words = coded.dictionary.to_pylist()
        own = np.array([int.from_bytes(blake2b(w.encode(), digest_size=8).digest(), "little") for w in words], np.uint64)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        hashes, docs, places, lengths = [], [], [], []
        one, start = own[codes] if len(codes) else np.zeros(0, np.uint64), np.full(1, seed & (2**64 - 1), np.uint64)
        for n in sizes:
            count = max(0, len(one) - n + 1)
            total = np.full(count, n, np.uint64) + start
            for j in range(n):
                total = mixed(total * 0x9E3779B97F4A7C15 + one[j : j + count])
            whole = np.flatnonzero(owner[:count] == owner[n - 1 : n - 1 + count])
            hashes.append(total[whole].view(np.int64)), docs.append(owner[whole]), places.append(whole), lengths.append(np.full(len(whole), n))
        return *(np.concatenate(x) for x in (hashes, docs, places, lengths)), words, codes

    return read


def _blocks(docs: DataFrame, sizes: Sequence[int], bytes_each: int = 1 << 21, pairs_each: int = 1 << 15) -> DataFrame:
    """The n-grams of neighbouring documents of one group: a block, in rows of up to ``pairs_each``, since tasks read many rows at once.

    ``h`` ascending, for each different n-gram of a document its hash, ``d`` the document's place in the block, ``tf``
    how often; ``nos`` and ``copies`` by document; all packed.
    """
    read = _gram_hashes(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            seeds = batch.column("seed").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(seeds)) + 1).tolist(), batch.num_rows]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                part = batch.slice(low, high - low)
                step = max(1, min(60000, part.num_rows * bytes_each // max(1, part.column("text").get_total_buffer_size() * part.num_rows // batch.num_rows)))
                for start in range(0, part.num_rows, step):
                    piece = part.slice(start, step)
                    h, d, *_ = read(piece.column("text"), int(seeds[low]))
                    order = np.argsort(h, kind="stable")
                    h, d = h[order], d[order]
                    new = np.ones(len(h), bool)
                    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
                    firsts = np.flatnonzero(new)
                    tf = np.diff(np.append(firsts, len(h))).astype(np.int32)
                    nos, copies = (piece.column(c).to_numpy().astype(np.int64) for c in ("no", "copies"))
                    h, d = h[firsts], d[firsts].astype(np.uint16)
                    for at in range(0, max(1, len(h)), pairs_each):
                        span = slice(at, at + pairs_each)
                        packed = [x.tobytes() for x in (nos, copies, h[span], d[span], tf[span])]
                        columns = [pa.array([int(nos[0])]), piece.column("seed").slice(0, 1), piece.column("n").slice(0, 1), pa.array([len(h[span])])]
                        columns += [pa.array([x], pa.binary()) for x in packed]
                        yield pa.RecordBatch.from_arrays(columns, names=["block", "seed", "n", "pairs", "nos", "copies", "h", "d", "tf"])

    return docs.mapInArrow(run, "block bigint, seed bigint, n bigint, pairs bigint, nos binary, copies binary, h binary, d binary, tf binary")


def _placed(blocks: DataFrame, tasks: int) -> DataFrame:
    """The n-grams of the blocks dealt out by hash: ``(part, block, seed, n, docs, h, d, tf, c)``, a row a block and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        bounds = np.array([-(2**63) + (2**64 * i) // tasks for i in range(1, tasks)], np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                h, d, tf = np.frombuffer(row["h"], np.int64), np.frombuffer(row["d"], np.uint16), np.frombuffer(row["tf"], np.int32)
                copies = np.frombuffer(row["copies"], np.int64)
                cuts = [0, *np.searchsorted(h, bounds).tolist(), len(h)]
                spans = [(i, lo, hi) for i, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if hi > lo]
                many = copies[d] if (copies > 1).any() else None
                packed = [[x[lo:hi].tobytes() if x is not None else None for _, lo, hi in spans] for x in (h, d, tf, many)]
                same = [np.full(len(spans), x, np.int64) for x in (row["block"], row["seed"], row["n"], len(copies))]
                columns = [pa.array([i for i, _, _ in spans], pa.int32()), *map(pa.array, same), *[pa.array(x, pa.binary()) for x in packed]]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "seed", "n", "docs", "h", "d", "tf", "c"])

    rows = blocks.mapInArrow(run, "part int, block bigint, seed bigint, n bigint, docs bigint, h binary, d binary, tf binary, c binary")
    return rows.repartitionById(tasks, "part")


def _weighed(placed: DataFrame, min_df: int, max_df: float) -> DataFrame:
    """The vocabulary ``(seed, n, h, df)`` as lists, and for each block the part of its documents' squared lengths.

    A task holds the n-grams of one range of hashes, whose number was counted when the ranges were set, and the squares
    of one block at a time; it gives those of the documents that have one of its n-grams.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        names = ["seed", "n", "h", "df", "block", "squares", "at"]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary()]

        def out(block, total):
            """One block's squares; of few documents with their places, so that they need no more room than its n-grams."""
            at = np.flatnonzero(total)
            few = 2 * len(at) < len(total)
            row = [None, len(total), None, None, block, (total[at] if few else total).tobytes(), at.astype(np.uint16).tobytes() if few else None]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=names)

        rows, packed = [], {c: [] for c in ("h", "d", "tf", "c")}
        for batch in batches:
            rows += zip(*(batch.column(c).to_pylist() for c in ("block", "seed", "n", "docs")), strict=True)
            for c, kind in (("h", np.int64), ("d", np.uint16), ("tf", np.int32), ("c", np.int64)):
                packed[c] += [None if x is None else np.frombuffer(x, kind) for x in batch.column(c).to_pylist()]
            del batch
        if not rows:
            return
        by_block = sorted(range(len(rows)), key=lambda i: rows[i][0])
        rows, packed = [rows[i] for i in by_block], {c: [x[i] for i in by_block] for c, x in packed.items()}
        lengths = np.array([len(x) for x in packed["h"]])
        h = np.concatenate(packed.pop("h"))
        copies = np.concatenate([np.ones(k, np.int64) if x is None else x for x, k in zip(packed.pop("c"), lengths, strict=True)])
        order = np.argsort(h, kind="stable")
        new = np.ones(len(h), bool)
        new[1:] = np.diff(h[order]) != 0
        firsts = np.flatnonzero(new)
        df = np.add.reduceat(copies[order], firsts)
        first_row = np.searchsorted(np.cumsum(lengths), order[firsts], side="right")
        seeds, sizes = np.array([r[1] for r in rows])[first_row], np.array([r[2] for r in rows])[first_row]
        known = (df >= min_df) & (df <= sizes * float(max_df))
        idf = np.where(known, np.log((1 + sizes) / (1 + df)) + 1, 0.0)
        weight = np.empty(len(h))
        weight[order] = np.repeat(idf, np.diff(np.append(firsts, len(h))))
        terms = h[order[firsts]]
        del h, copies, order, new, first_row
        for seed in np.unique(seeds[known]):
            mine = known & (seeds == seed)
            mine = np.flatnonzero(mine)
            for start in range(0, len(mine), 1 << 16):
                some = mine[start : start + (1 << 16)]
                row = [[int(seed)], [int(sizes[some[0]])], [terms[some]], [df[some]], [None], [None], [None]]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names=names)
        own, total, start = None, 0, 0
        for (block, _, _, docs), d, tf, k in zip(rows, packed["d"], packed["tf"], lengths, strict=True):
            if block != own and own is not None:
                yield out(own, total)
            w = weight[start : start + k] * tf
            total = np.bincount(d, w * w, docs) + (total if block == own else 0)
            own, start = block, start + k
        yield out(own, total)

    return placed.mapInArrow(run, "seed bigint, n bigint, h array<bigint>, df array<bigint>, block bigint, squares binary, at binary")


def _lengths(parts: DataFrame) -> DataFrame:
    """``(block, length)``: the lengths of a block's documents, packed, from the parts of their squares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        block, total = None, 0
        out = lambda: pa.RecordBatch.from_arrays([pa.array([block]), pa.array([np.sqrt(total).tobytes()], pa.binary())], names=["block", "length"])
        for batch in batches:
            for b, n, x, at in zip(*(batch.column(c).to_pylist() for c in ("block", "n", "squares", "at")), strict=True):
                if b != block:
                    if block is not None:
                        yield out()
                    block, total = b, np.zeros(n)
                total[slice(None) if at is None else np.frombuffer(at, np.uint16)] += np.frombuffer(x)
        if block is not None:
            yield out()

    return parts.repartition("block").sortWithinPartitions("block").mapInArrow(run, "block bigint, length binary")


def _scored(blocks: DataFrame) -> DataFrame:
    """``(seed, h, total, no)`` for the candidates ``ch``, ``cdf`` of each block's group: the sum of their shares by task, and a document with each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        group, terms, totals, seen = None, None, None, None

        def out():
            got = np.flatnonzero(seen >= 0)
            columns = [np.full(len(got), group), terms[got], totals[got], seen[got]]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["seed", "h", "total", "no"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("seed", "n", "nos", "copies", "h", "d", "tf", "length")}
                ch, cdf = (batch.column(c)[i].values.to_numpy() for c in ("ch", "cdf"))
                if row["seed"] != group:
                    if group is not None:
                        yield out()
                    group, terms, totals, seen = row["seed"], ch.copy(), np.zeros(len(ch)), np.full(len(ch), -1)
                h, d, tf = np.frombuffer(row["h"], np.int64), np.frombuffer(row["d"], np.uint16), np.frombuffer(row["tf"], np.int32)
                nos, copies, length = np.frombuffer(row["nos"], np.int64), np.frombuffer(row["copies"], np.int64), np.frombuffer(row["length"])
                low, high = np.searchsorted(h, ch), np.searchsorted(h, ch, side="right")
                count = high - low
                which = np.repeat(np.arange(len(ch)), count)
                at = np.arange(len(which)) + np.repeat(low - (np.cumsum(count) - count), count)
                idf = np.log((1 + row["n"]) / (1 + cdf)) + 1
                totals += np.bincount(which, tf[at] * idf[which] / length[d[at]] * copies[d[at]], len(ch))
                fresh = np.flatnonzero((count > 0) & (seen < 0))
                seen[fresh] = nos[d[low[fresh]]]
        if group is not None:
            yield out()

    return blocks.mapInArrow(run, "seed bigint, h bigint, total double, no bigint")


def _named(found: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """``found(seed, h, text, ...)`` with the n-gram that ``h`` stands for in ``text``."""
    read = _gram_hashes(sizes)
    kept = [c for c in found.columns if c not in ("text", "seed", "h")]
    shape = ", ".join(f"`{c}` {found.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            seeds, wanted, grams = batch.column("seed").to_pylist(), batch.column("h").to_pylist(), []
            for i in range(batch.num_rows):
                h, _, places, lengths, words, codes = read(batch.column("text").slice(i, 1), seeds[i])
                at = np.flatnonzero(h == wanted[i])[0]
                grams.append(" ".join(words[c] for c in codes[places[at] : places[at] + lengths[at]]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(grams, pa.string())], names=[*kept, "ngram"])

    return found.mapInArrow(run, f"{shape}, ngram string")


def top_ngrams(
    df: DataFrame, by: str, text: str, k: int = 25, min_df: int = 5, max_df: float = 0.6,
    sizes: Sequence[int] = (1, 2), sample: int | None = None, seed: int = 13, pairs_per_task: int = 1 << 21, at_once: int = 1 << 14,
) -> DataFrame:
    """The ``k`` n-grams with the highest mean TF-IDF per group.

    Every text is a document of its group. Smoothed idf, rows scaled to unit length,
    mean over all documents of the group. Terms in fewer than ``min_df`` documents or
    in more than the share ``max_df`` are left out.

    Each different text is read once. Its n-grams go by hash, packed in blocks of documents, to tasks that find document
    frequencies and the part that each n-gram adds to its documents' lengths, about ``pairs_per_task`` a task.
    No share exceeds 1, so a mean is at most the frequency over the documents: n-grams are scored from the
    most frequent on, ``at_once`` a group and then eight times as many, until the next ones cannot reach
    the ``k``-th best. Only those that do are looked up as text again, so that ties go by it.
    """
    if sample is not None:
        df = sample_per_group(df, by, sample, [text], seed)
    distinct = distinct_texts(df.where(F.col(by).isNotNull()), by, text).select(by, F.xxhash64(F.lit(seed), by).alias("seed"), "copies", F.lower(text).alias("text"))
    docs = cut_lineage(distinct.sortWithinPartitions("seed").withColumn("no", F.monotonically_increasing_id()))
    groups = cut_lineage(docs.groupBy(by, "seed").agg(F.sum("copies").alias("n"), F.count("*").alias("texts")))
    counted = docs.join(F.broadcast(groups.select("seed", "n")), "seed")
    blocks = cut_lineage(_blocks(counted.select("no", "seed", "n", "copies", "text"), sizes))
    pairs = blocks.agg(F.sum("pairs")).first()[0] or 0
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(pairs / pairs_per_task))
    weighed = cut_lineage(_weighed(_placed(blocks, tasks), min_df, max_df))
    lengths = cut_lineage(_lengths(weighed.where("block is not null").select("block", "n", "squares", "at")))
    small = (groups.agg(F.sum("texts")).first()[0] or 0) * 8 <= 1 << 26
    ready = blocks.join(F.broadcast(lengths) if small else by_shuffle(lengths), "block")

    listed = weighed.where("seed is not null").select("seed", "n", F.explode(F.arrays_zip("h", "df")).alias("t")).select("seed", "n", "t.h", "t.df")
    level = F.floor(F.log2("df") * 16)
    below = Window.partitionBy("seed").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    levels = cut_lineage(listed.groupBy("seed", level.alias("level")).agg(F.count("*").alias("terms"), F.max("df").alias("most"), F.max("n").alias("n")).withColumn("upto", F.sum("terms").over(below)))
    best = Window.partitionBy("seed").orderBy(F.desc("score"))
    scores, open_ = None, levels.groupBy("seed").agg((F.max("level") + 1).alias("done"))
    many = max(at_once, 4 * k)
    while True:
        left = levels.join(open_, "seed").where(F.col("level") < F.col("done"))
        fit = F.when(F.col("upto") <= many, F.col("level"))
        steps = cut_lineage(left.groupBy("seed").agg(F.least(F.coalesce(F.min(fit), F.max("level")), F.max("level")).alias("low"), F.max("done").alias("done")))
        if steps.isEmpty():
            break
        asked = listed.join(F.broadcast(steps), "seed").where((level >= F.col("low")) & (level < F.col("done"))).groupBy("seed").agg(F.array_sort(F.collect_list(F.struct("h", "df"))).alias("t"))
        asked = cut_lineage(asked.select("seed", F.col("t.h").alias("ch"), F.col("t.df").alias("cdf")))
        terms = asked.agg(F.sum(F.size("ch"))).first()[0] or 0
        met = _scored(ready.join(F.broadcast(asked) if terms <= 1 << 22 else by_shuffle(asked), "seed"))
        summed = met.groupBy("seed", "h").agg(F.sum("total").alias("total"), F.min("no").alias("no")).join(F.broadcast(groups), "seed")
        new = summed.select("seed", by, "h", "no", round_half_away(F.col("total") / F.col("n"), 10).alias("score"))
        scores = cut_lineage(new if scores is None else scores.unionByName(new))
        last = scores.withColumn("place", F.row_number().over(best)).where(F.col("place") == k).select("seed", F.col("score").alias("least"))
        last = cut_lineage(last)
        scores = cut_lineage(scores.join(F.broadcast(last), "seed", "left").where("least is null or score >= least").drop("least"))
        after = left.join(steps.select("seed", "low"), "seed").where(F.col("level") < F.col("low")).groupBy("seed", "low").agg(F.max(F.col("most") / F.col("n")).alias("bound"))
        open_ = cut_lineage(after.join(last, "seed", "left").where("least is null or bound + 1e-9 >= least").select("seed", F.col("low").alias("done")))
        many *= 8
    if scores is None:
        scores = df.select(by).limit(0).selectExpr("cast(null as bigint) seed", f"`{by}`", "cast(null as bigint) h", "cast(null as bigint) no", "cast(null as double) score")
    found = scores.join(docs.select("no", "text"), "no").select("seed", "h", "text", by, "score")
    return top_per_group(_named(found, sizes).select(by, "ngram", "score"), [by], ["-score", "ngram"], k, "rank")


def suggest_labels(ranked: DataFrame, by: str, first: int = 15, hints=LABEL_HINTS) -> DataFrame:
    """Per group the label with most hints among its leading n-grams; the earlier label wins a tie."""
    rows = [(i, label, j, hint) for i, (label, words) in enumerate(hints) for j, hint in enumerate(words)]
    hint_frame = ranked.sparkSession.createDataFrame(rows, "label_no int, label string, hint_no int, hint string")
    leading = ranked.filter(F.col("rank") <= first)
    # A few dozen fixed hints against at most ``first`` n-grams per group.
    found = leading.join(F.broadcast(hint_frame), F.contains(F.col("ngram"), F.col("hint")))
    hits = found.groupBy(by, "label_no", "label").agg(
        F.array_sort(F.collect_set(F.struct("hint_no", "hint"))).alias("hits")
    )
    best = hits.groupBy(by).agg(
        F.max_by(F.struct("label", "hits"), F.struct(F.size("hits"), -F.col("label_no"))).alias("best")
    )
    terms = F.array_join(F.transform(F.col("best.hits"), lambda h: h["hint"]), ", ")
    return ranked.select(by).distinct().join(best, by, "left").select(
        by,
        F.coalesce(F.col("best.label"), F.lit("Unclear")).alias("guess_label"),
        F.coalesce(terms, F.lit("")).alias("support_terms"),
    )
