"""Positions, running values and ranks inside groups of any size.

A window partition is sorted by one task. That is the best plan while groups are
small; a group that holds a large share of the table is handled by range
partitioning instead. The choice is made from the counted size of the largest group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filigree.functions.numbers import percent, round_half_away
from filigree.functions.ordering import sort_key
from filigree.operators.joins import null_safe_join
from filigree.session import cut_lineage

_INDEX_BITS = 33
_EXACT = "_exact"
_REST, _PLACE, _FIRST, _LARGE = "_rest", "_place", ("_first_sum", "_first_previous"), 1e12


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Row count of the largest group; one partial aggregate, one number to the driver."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return int(sizes.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n")).first()["n"])


def with_group_aggregates(df: DataFrame, keys: Sequence[str], aggregates: dict[str, Column]) -> DataFrame:
    """Every row with the aggregates of its group.

    Aggregated and joined back rather than windowed: the aggregate combines on the
    map side, and an uneven join is split at run time, so a large group is no
    single task.
    """
    totals = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    return null_safe_join(df, totals, keys, "left")


def running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str | None = None,
    position: str = "row_num", hot_rows: int = 1_000_000,
) -> DataFrame:
    """Add the 1-based position in the group; with ``value`` also ``running_sum`` and ``previous``.

    ``order`` should be unique inside a group. Doubles below ``_LARGE`` are added as decimals of 14
    places, so that the sum does not depend on the order of the additions or on the plan. What a
    decimal does not hold (smaller digits, larger values, infinities, NaN) is added as doubles in a
    second pass, which only data with such values needs. From a NaN on the sum is NaN.
    """
    if value is not None and df.schema[value].dataType.typeName() in ("double", "float"):
        kind = df.schema[value].dataType.simpleString()
        double = F.col(value).cast("double")
        fits = F.abs(double) < _LARGE  # false for NaN, which counts as larger than any number
        exact = F.when(fits, double.try_cast("decimal(38,14)")).when(double.isNotNull(), F.lit(0).cast("decimal(38,14)"))
        split = df.withColumn(_EXACT, exact).withColumn(_REST, double - F.col(_EXACT).cast("double"))
        summed = running(split, keys, order, _EXACT, position, hot_rows)
        summed = summed.withColumns({c: F.col(c).cast("double") for c in ("running_sum", "previous")})
        if not split.where(F.col(_REST) != 0).isEmpty():
            first = summed.withColumnsRenamed({"running_sum": _FIRST[0], "previous": _FIRST[1]})
            second = running_doubles(first, keys, order, _REST, hot_rows)
            summed = second.withColumns({c: F.col(c) + F.col(f) for c, f in zip(("running_sum", "previous"), _FIRST)}).drop(*_FIRST)
        return summed.withColumns({c: F.col(c).cast(kind) for c in ("running_sum", "previous")}).drop(_EXACT, _REST)
    return _running(df, keys, order, value, position, hot_rows)


def running_doubles(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, hot_rows: int = 1_000_000) -> DataFrame:
    """``running_sum`` and ``previous`` of a double column by plain additions."""
    return _running(df, keys, order, value, _PLACE, hot_rows).drop(_PLACE)


def _running(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str | None, position: str, hot_rows: int) -> DataFrame:
    """One window for groups up to ``hot_rows``, range partitions beyond."""
    if largest_group(df, keys) <= hot_rows:
        ordered = Window.partitionBy(*keys).orderBy(*[sort_key(c) for c in order])
        out = df.withColumn(position, F.row_number().over(ordered).cast("bigint"))
        if value is None:
            return out
        upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return out.withColumns({"running_sum": F.sum(value).over(upto), "previous": F.lag(value).over(ordered)})
    return _running_by_ranges(df, keys, order, value, position)


def _running_by_ranges(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str | None, position: str
) -> DataFrame:
    """The same result from range partitions: local windows plus what earlier ranges of the group contributed."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort = [sort_key(c) for c in (*keys, *order)]
    placed = df.repartitionByRange(n, *sort).sortWithinPartitions(*sort)
    saved = cut_lineage(placed.withColumn("_pos", F.monotonically_increasing_id()))
    saved = saved.withColumn("_part", F.shiftright("_pos", _INDEX_BITS))
    piece = ["_part", *keys]
    facts = [F.count(F.lit(1)).alias("_n")]
    if value is not None:
        facts += [F.sum(value).alias("_sum"), F.max_by(F.struct(value), "_pos").alias("_last")]
    pieces = saved.groupBy(*piece).agg(*facts)
    by_part = Window.partitionBy(*keys).orderBy("_part")  # at most one row per range
    earlier = by_part.rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n_before")]
    if value is not None:
        carried += [
            F.sum("_sum").over(earlier).alias("_sum_before"),
            F.lag("_last").over(by_part).alias("_last_before"),
        ]
    offsets = pieces.select(*piece, *carried)
    local = Window.partitionBy(*piece).orderBy("_pos")
    out = null_safe_join(saved, offsets, piece, "left")
    new = {position: (F.row_number().over(local) + F.col("_n_before")).cast("bigint")}
    if value is not None:
        upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        here = F.sum(value).over(upto)
        before = F.col("_sum_before")
        if value == _EXACT:  # one digit less, so that the addition keeps all places
            here, before = here.cast("decimal(37,14)"), before.cast("decimal(37,14)")
        new["running_sum"] = F.when(before.isNull(), here).otherwise(before + F.coalesce(here, F.lit(0).cast("decimal(37,14)") if value == _EXACT else F.lit(0)))
        first = F.row_number().over(local) == 1
        new["previous"] = F.when(first, F.col(f"_last_before.{value}")).otherwise(F.lag(value).over(local))
    return out.withColumns(new).select(*df.columns, *new)


def average_rank(df: DataFrame, keys: Sequence[str], value: str, name: str = "rank", hot_rows: int = 1_000_000) -> DataFrame:
    """Rank of ``value`` in its group; ties share the mean of their positions."""
    distinct = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_peers"))
    ranked = running(distinct, keys, [value], "_peers", "_i", hot_rows)
    mean = F.col("running_sum") - F.col("_peers") + (F.col("_peers") + 1) / F.lit(2.0)
    ranks = ranked.select(*keys, value, mean.alias(name))
    return null_safe_join(df, ranks, [*keys, value], "left")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int, name: str = "rn") -> DataFrame:
    """The first ``k`` rows of each group with their rank.

    For small ``k`` Spark already drops all but ``k`` rows per group and task before
    the shuffle (window group limit).
    """
    ordered = Window.partitionBy(*keys).orderBy(*[sort_key(c) for c in order])
    return df.withColumn(name, F.row_number().over(ordered)).filter(F.col(name) <= k).withColumn(
        name, F.col(name).cast("bigint")
    )


def share_of_total(df: DataFrame, count: str, name: str, digits: int = 2) -> DataFrame:
    """Percentage of the whole for a small aggregated frame."""
    return df.withColumn(name, percent(F.col(count), F.sum(count).over(Window.partitionBy())))


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, points: dict[str, float], digits: int = 6, hot_rows: int = 1_000_000
) -> DataFrame:
    """Interpolated percentiles per group for a column with very many different values.

    The built-in exact percentile keeps every different value of a group in one task. Here
    values are counted, ranked by running counts, and only the rows around each wanted
    position are kept.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running(counts, keys, [value], "_n", "_i", hot_rows)
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    placed = null_safe_join(ranked.select(*keys, value, "_n", "running_sum"), totals, keys)
    before = F.col("running_sum") - F.col("_n")

    def position(p: float) -> Column:
        return F.lit(float(p)) * (F.col("_total") - 1)

    def holds(index: Column) -> Column:
        return (before <= index) & (index < F.col("running_sum"))

    wanted = F.lit(False)
    sides = {}
    for i, p in enumerate(points.values()):
        low, high = holds(F.floor(position(p))), holds(F.ceil(position(p)))
        wanted = wanted | low | high
        sides[f"_lo{i}"], sides[f"_hi{i}"] = low, high
    x = F.col(value).cast("double")
    kept = placed.filter(wanted).groupBy(*keys).agg(
        F.max("_total").alias("_total"), *[F.max(F.when(c, x)).alias(n) for n, c in sides.items()]
    )

    def between(i: int, p: float) -> Column:
        part = position(p) - F.floor(position(p))
        return round_half_away(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * part, digits)

    return kept.select(*keys, *[between(i, p).alias(name) for i, (name, p) in enumerate(points.items())])
