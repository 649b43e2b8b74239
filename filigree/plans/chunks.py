"""Chunks of consecutive sentences that never cross a section: sliding windows, and sizes by density under a word bound.

Sentences are numbered inside their section by ``operators.windows.running``, which splits a hot
section over range partitions, and cut into pieces of ``piece_rows`` by that number. A piece also
carries the first sentences of the next one, as far as a chunk can reach, so each piece makes its
chunks alone and no section is one task, however long it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filigree.operators.joins import null_safe_join
from filigree.operators.windows import running, with_group_aggregates
from filigree.session import cut_lineage

# Mean words of a sentence from which on a chunk takes so many sentences and shares so many with the next.
STEPS = ((26, 3, 1), (18, 4, 1), (0, 5, 2))
_END = 1 << 30


def word_count(text: Column) -> Column:
    """Stretches between blanks; null has none."""
    return F.coalesce(F.size(F.filter(F.split(text, " "), lambda w: w != "")), F.lit(0))


def _in_pieces(df: DataFrame, keys: Sequence[str], order: Sequence[str], text: str, reach: int, piece_rows: int, hot_rows: int) -> DataFrame:
    """Rows with their number ``_p`` from 0, once in the piece they belong to and again in the one before if it reaches them."""
    if piece_rows < reach:
        raise ValueError(f"a piece of {piece_rows} rows is shorter than the {reach} rows a chunk reaches")
    placed = running(df, keys, [*order, text], position="_p", hot_rows=hot_rows).withColumn("_p", F.col("_p") - 1)
    own = F.floor(F.col("_p") / piece_rows)
    before = F.when((F.col("_p") % piece_rows < reach) & (own > 0), own - 1)
    return placed.withColumn("_piece", F.explode(F.array_compact(F.array(own, before))))


def sliding_chunks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], text: str, size: int = 3, stride: int = 1, piece_rows: int = 4096, hot_rows: int = 1_000_000
) -> DataFrame:
    """Windows of ``size`` sentences, one from every ``stride``-th sentence of each section.

    Returns ``(*keys, first, n_sentences, text)``, ``first`` counted from 0 in the section. A window
    that would hold nothing new is left out, so the last one may be shorter and a short section is
    one chunk. Null sentences hold a place and add no text; null keys are a section; sentences tied
    on ``order`` go by their text.
    """
    if not 1 <= stride <= size:
        raise ValueError("stride must lie between 1 and size, else sentences would be lost")
    rows = _in_pieces(df, keys, order, text, size - 1, piece_rows, hot_rows)
    ahead = Window.partitionBy(*keys, "_piece").orderBy("_p").rowsBetween(0, size - 1)
    cut = rows.withColumns({"n_sentences": F.count(F.lit(1)).over(ahead), "_texts": F.collect_list(text).over(ahead)})
    starts = cut.where((F.floor(F.col("_p") / piece_rows) == F.col("_piece")) & (F.col("_p") % stride == 0))
    new = starts.where((F.col("_p") == 0) | (F.col("n_sentences") > size - stride))
    return new.select(*keys, F.col("_p").alias("first"), "n_sentences", F.array_join("_texts", " ").alias("text"))


def _walk(rows: str, at: str) -> str:
    """SQL for the chunk starts met in ``rows(o, step, take)`` from offset ``at`` on."""
    return f"""aggregate({rows}, named_struct('at', {at}, 'seen', cast(array() as array<int>)),
        (acc, x) -> if(acc.at = x.o, named_struct('at', acc.at + x.step, 'seen', concat(acc.seen, array(x.o))), acc))"""


def _entries(maps: DataFrame, keys: Sequence[str], reach: int, fan: int) -> DataFrame:
    """``(*keys, _piece, entry)``: where the walk enters each piece, null if it ended before.

    ``maps(*keys, _piece, exits)`` tells for each entry offset where the next piece is entered, null
    for nowhere. Maps are composed in groups of ``fan`` pieces, their maps in groups again, and so on
    up; the entries then come down the same way. No task holds more than ``fan`` maps of a section.
    """
    up = maps.withColumn("_up", F.floor(F.col("_piece") / fan))
    listed = up.groupBy(*keys, "_up").agg(F.array_sort(F.collect_list(F.struct("_piece", "exits"))).alias("maps"))
    if maps.where(F.col("_piece") >= fan).isEmpty():
        above = listed.withColumn("entry", F.lit(0))
    else:
        listed = cut_lineage(listed)
        same = F.sequence(F.lit(0), F.lit(reach - 1))
        composed = F.aggregate("maps", same, lambda acc, m: F.transform(acc, lambda at: F.get(m["exits"], at)))
        higher = _entries(listed.select(*keys, F.col("_up").alias("_piece"), composed.alias("exits")), keys, reach, fan)
        above = null_safe_join(listed, higher.withColumnRenamed("_piece", "_up"), [*keys, "_up"])
    steps = F.expr("""aggregate(maps, named_struct('at', entry, 'seen', cast(array() as array<int>)),
        (acc, m) -> named_struct('at', get(m.exits, acc.at), 'seen', concat(acc.seen, array(acc.at)))).seen""")
    out = above.select(*keys, F.explode(F.arrays_zip(F.col("maps._piece").alias("_piece"), steps.alias("entry"))).alias("e"))
    return out.select(*keys, "e._piece", "e.entry")


def density_chunks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    text: str,
    by: Sequence[str],
    steps: Sequence[tuple[int, int, int]] = STEPS,
    bound: int = 200,
    piece_rows: int = 256,
    fan: int = 256,
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """Chunks whose size follows the density of their text, of no more than ``bound`` words.

    The mean words of a sentence over each group of ``by`` choose the first of ``steps`` (least mean,
    sentences, overlap) that it reaches; the last one holds for all others. A chunk takes sentences
    from its first on while it stays within both, one at least; the next chunk begins ``overlap``
    sentences before the end, one sentence on at least. The section's last sentence ends the last
    chunk, so every sentence is in a chunk. Returns ``(*keys, first, n_sentences, n_words, oversized,
    text)``; ``oversized`` marks a single sentence beyond the bound, which stays whole. Nulls and ties
    as in ``sliding_chunks``.

    Where a chunk begins depends on all chunks before it. Each piece therefore tells where the walk
    leaves it for every offset at which it could come in, those maps are composed (``_entries``), and
    the pieces then cut their chunks independently.
    """
    if any(not 0 <= overlap < size for _, size, overlap in steps):
        raise ValueError("an overlap must be smaller than its chunk")
    reach = max(size for _, size, _ in steps)
    counted = df.withColumn("_words", word_count(F.col(text)))
    dense = with_group_aggregates(counted, by, {"_sum": F.sum("_words"), "_n": F.count(F.lit(1))})
    size, overlap = F.lit(steps[-1][1]), F.lit(steps[-1][2])
    for least, s, o in reversed(steps[:-1]):
        reached = F.col("_sum") >= F.col("_n") * least
        size, overlap = F.when(reached, s).otherwise(size), F.when(reached, o).otherwise(overlap)
    sized = dense.select(*dict.fromkeys([*keys, *order, text]), "_words", size.alias("_size"), overlap.alias("_overlap"))
    rows = _in_pieces(sized, keys, order, text, reach, piece_rows, hot_rows)
    sentence = F.struct("_p", F.col("_words").alias("words"), F.col("_size").alias("size"), F.col("_overlap").alias("overlap"), F.col(text).alias("text"))
    blocks = rows.groupBy(*keys, "_piece").agg(F.array_sort(F.collect_list(sentence)).alias("rows"))
    fits = f"""filter(sequence(1, least(r.size, size(rows) - i)),
        k -> k = 1 or aggregate(slice(rows, i + 1, k), 0L, (t, x) -> t + x.words) <= {bound})"""
    takes = blocks.withColumn("takes", F.expr(f"transform(slice(rows, 1, {piece_rows}), (r, i) -> size({fits}))"))
    step = f"if(i + t >= size(rows), {_END}, greatest(t - rows[i].overlap, 1))"
    ready = takes.withColumn("jumps", F.expr(f"transform(takes, (t, i) -> named_struct('o', i, 'step', {step}, 'take', t))"))
    ready = cut_lineage(ready)
    long = ready.where("_piece > 0").select(*keys).distinct()
    leave = f"""transform(aggregate(jumps, sequence(0, {reach - 1}), (acc, x) -> transform(acc, at -> if(at = x.o, at + x.step, at))),
        at -> if(at < {_END}, at - {piece_rows}, null))"""
    maps = null_safe_join(ready, long, keys).select(*keys, "_piece", F.expr(leave).alias("exits"))
    entered = ready.where("_piece = 0").select(*keys, "_piece", F.lit(0).alias("entry"))
    if not long.isEmpty():
        entered = entered.unionByName(_entries(cut_lineage(maps), keys, reach, fan).where("_piece > 0 and entry is not null"))
    met = null_safe_join(ready, entered, [*keys, "_piece"])
    starts = met.withColumn("o", F.explode(F.expr(f"{_walk('jumps', 'entry')}.seen")))
    chunk = starts.withColumn("chunk", F.expr("slice(rows, o + 1, takes[o])"))
    words = F.aggregate("chunk", F.lit(0).cast("bigint"), lambda t, x: t + x["words"])
    return chunk.select(
        *keys, F.get("chunk", F.lit(0))["_p"].alias("first"), F.size("chunk").cast("bigint").alias("n_sentences"), words.alias("n_words"),
        (words > bound).alias("oversized"), F.array_join(F.col("chunk.text"), " ").alias("text"),
    )
