"""Mixing sources to target weights by capped water-filling.

DataFrame functions only. A source's target is ``least(cap, level * weight)``: sources that reach
``MAX_EPOCHS`` times their size stop there and the others share the rest by weight. The level is the
largest of ``(total - caps of the sources before) / (weights of this source and those after)`` over
the sources in order of cap for each unit of weight.

A source's target is its size times a whole number of repetitions and a fraction. Every document is
taken the whole number of times. For the fraction, documents stand in the order of a seeded hash and
are taken once more while more than half of them fits. Running sizes over a source, which may hold
most of the rows, come from sums by ``SLICES`` ranges of the hash; only the one range in which a
source's fraction ends is put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filigree.llm.common import free_names, stage

MAX_EPOCHS = 3
SEED = "mix-1"
DIGITS = 3  # hex digits of a range of the hash: 4096 ranges
SPACE = " \t\n\x0b\f\r"
WEIGHTS = (1, 2, 3)


def n_words(text):
    """Number of words; null and blank texts have none."""
    trimmed = F.trim(text, F.lit(SPACE))
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) == 0, 0).otherwise(F.size(F.split(trimmed, "[ \\t-\\r]+"))).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``(key, source_size, target)`` from ``sizes(key, source, source_size)``.

    Sources in order of code point, null last, weigh ``weights``, repeating. There is one row for
    each source, so that the two windows over all of them stay small.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((place - 1) % len(weights) + 1).cast("int"))
    cap = F.col("source_size").cast("double") * float(max_epochs)
    weighed = sizes.select("key", "source", "source_size", weight.alias("weight"), cap.alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.sum(F.col("source_size").cast("double")).over(everything)
    level = (total - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))) / F.sum("weight").over(after)
    filled = weighed.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return filled.select("key", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def source_key(source: Column) -> Column:
    """The name of a source; a null source has one too, which no other source can have."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("null"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """``(id_col, size, source_size, target, repeats, taken)`` for every row of ``docs``.

    ``size`` counts words, ``repeats`` how often the mix takes the document, ``taken`` is their
    product. A null source is a source of its own, a null text has size zero. Rows with the same id
    stand in the order of their sizes; rows alike in both are interchangeable. No document is taken
    more than ``max_epochs`` times. An empty table gives an empty result; other columns are not read.
    """
    return _plan(docs, id_col, text_col, source_col, weights, max_epochs, seed).drop("key")


def _plan(docs: DataFrame, id_col: str, text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The rows of ``mix`` with the ``key`` of their source."""
    key = source_key(F.col(source_col))
    tag = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    rows = stage(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"), key.alias("key"), n_words(F.col(text_col)).alias("size"), tag.alias("tag")))
    part = F.substring("tag", 1, DIGITS)
    sums = stage(rows.groupBy("key", "source", part.alias("part")).agg(F.sum("size").alias("size")))
    goal = stage(targets(sums.groupBy("key", "source").agg(F.sum("size").alias("source_size")), weights, max_epochs))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("whole", whole).withColumn("left_over", F.col("target") - F.col("whole") * F.col("source_size"))
    before = F.sum("size").over(Window.partitionBy("key").orderBy("part")) - F.col("size")
    reached = sums.select("key", "part", before.alias("before")).join(goal, "key").where("before <= left_over")
    ends = reached.groupBy("key").agg(F.max(F.struct("part", "before")).alias("e")).select("key", F.col("e.part").alias("end"), F.col("e.before").alias("before"))
    plan = stage(goal.join(ends, "key", "left"))
    placed = rows.withColumn("part", part).join(plan, "key")
    inside = F.sum("size").over(Window.partitionBy("key", "part").orderBy("tag", "_id", "size").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    at_end = placed.where("part = end").withColumn("start", F.col("before") + inside)
    fits = (2 * F.col("start") + F.col("size") <= 2 * F.col("left_over")).cast("long")
    elsewhere = placed.where("part <> end or end is null")
    columns = ["key", "_id", "size", "source_size", "target", "whole"]
    both = at_end.select(*columns, fits.alias("more")).unionByName(elsewhere.select(*columns, F.coalesce((F.col("part") < F.col("end")).cast("long"), F.lit(0)).cast("long").alias("more")))
    more = F.when((F.col("size") > 0) & (F.col("whole") < max_epochs), F.col("more")).otherwise(0)
    repeats = (F.col("whole") + more).cast("long")
    return both.select("key", F.col("_id").alias(id_col), "size", "source_size", "target", repeats.alias("repeats"), (F.col("size") * repeats).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, all columns kept.

    Rows alike in id, source and size share what the plan takes of them: they are numbered in the
    order of their texts, and the first ones have the repetition that is left over. So rows that
    repeat an id, and rows without one, are each taken their own number of times.
    """
    plan = _plan(docs, id_col, text_col, source_col, **options)
    name, none, key, size, tag, place, count, taken, copy = free_names(docs, "id", "none", "key", "size", "tag", "place", "rows", "taken", "copy")
    alike = [F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias(name), F.col(id_col).isNull().alias(none)]
    names = [name, none, key, size]
    shares = plan.select(*alike, F.col("key").alias(key), F.col("size").alias(size), "repeats")
    shares = shares.groupBy(*names).agg(F.count("*").alias(count), F.sum("repeats").alias(taken)).where(F.col(taken) > 0)
    rows = docs.select("*", *alike, source_key(F.col(source_col)).alias(key), n_words(F.col(text_col)).alias(size), F.xxhash64(F.col(text_col)).alias(tag))
    placed = rows.withColumn(place, F.row_number().over(Window.partitionBy(*names).orderBy(tag)))
    joined = placed.join(shares, names)
    times = F.expr(f"cast({taken} div {count} + if({place} <= {taken} % {count}, 1, 0) as int)")
    return joined.withColumn(copy, F.explode(F.array_repeat(F.lit(1), times))).select(docs.columns)


SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size, md5('{SEED}|' || coalesce(doc_id::VARCHAR, 'null')) AS tag
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight, source_size::DOUBLE * {MAX_EPOCHS} AS cap FROM s),
l AS (SELECT *, (sum(source_size::DOUBLE) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(cap, (max(level) OVER ()) * weight) AS target FROM l),
g AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM t),
c AS (SELECT d.doc_id, d.size, g.source_size, g.target, g.whole, g.target - g.whole * g.source_size AS left_over,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.tag, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS start
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, (whole + more)::BIGINT AS repeats, (size * (whole + more))::BIGINT AS taken
FROM (SELECT *, CASE WHEN size > 0 AND whole < {MAX_EPOCHS} AND 2 * start + size <= 2 * left_over THEN 1 ELSE 0 END AS more FROM c)
"""
