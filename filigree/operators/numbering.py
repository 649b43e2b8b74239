"""Row numbers over a whole table without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filigree.functions.ordering import sort_key
from filigree.session import cut_lineage

_INDEX_BITS = 33  # monotonically_increasing_id keeps the row position in its low 33 bits


def global_row_number(
    df: DataFrame, order: Sequence[str], name: str = "row_id", start: int = 0, partitions: int | None = None
) -> DataFrame:
    """Number all rows 1, 2, 3 … in ``order`` (nulls last), continuing after ``start``.

    The table is range-partitioned on the order, so every task sorts one range; the
    numbers of a range start where the ranges before it end. The range boundaries
    come from sampling and may differ between two evaluations, hence the rows are
    written once between placing and counting them. Rows tied on the whole order are spread
    over ranges by their input position, so a large group of copies is split too.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [sort_key(c) for c in order] + [F.col("_tie").asc()]
    placed = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .drop("_tie")
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    saved = cut_lineage(placed).withColumn("_part", F.shiftright("_pos", _INDEX_BITS))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: its size is bounded by the partition count.
    offsets = (
        saved.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    position = F.col("_pos").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    number = (F.col("_before") + position + F.lit(1 + start)).cast("bigint")
    return saved.join(F.broadcast(offsets), "_part").select(number.alias(name), *df.columns)


def key_ranges(keys: DataFrame, key: str, rows_per_range: int = 1000, most: int = 64) -> Column:
    """The number of the range of ``key`` that a row falls into, from 0 on; null for a null key.

    Ranges hold about ``rows_per_range`` rows of ``keys``, more where that would need more than ``most`` of
    them: a table written by range keeps a bounded number of folders, however many keys it has.
    """
    wanted = min(most, max(1, keys.count() // rows_per_range))
    points = keys.approxQuantile(key, [i / wanted for i in range(1, wanted)], 0.1 / wanted) if wanted > 1 else []
    ahead = [(F.col(key) >= F.lit(int(p))).cast("bigint") for p in sorted(set(points))]
    return F.when(F.col(key).isNotNull(), sum(ahead, F.lit(0).cast("bigint")))


def append_numbers(existing: DataFrame, new: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """Number ``new`` after the highest ``name`` of ``existing``."""
    highest = existing.agg(F.coalesce(F.max(name), F.lit(0)).alias("m")).first()["m"]
    return global_row_number(new, order, name, start=int(highest))
