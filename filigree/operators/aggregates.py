"""Column profiles and labelled aggregate reports."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree.functions.numbers import percent, round_half_away
from filigree.session import cut_lineage


def quantiles(value: str, points: dict[str, float], digits: int = 6) -> list[Column]:
    """Exact interpolated percentiles as named columns, all from one aggregate.

    For lengths and counts, which take few different values; ``exact_quantiles`` is the
    form for columns with very many.
    """
    found = F.percentile(F.col(value).cast("double"), F.array(*[F.lit(float(p)) for p in points.values()]))
    return [round_half_away(found[i], digits).alias(name) for i, name in enumerate(points)]


def value_at_max(value: str, by: str) -> Column:
    """``value`` where ``by`` is largest; the larger value wins a tie."""
    return F.max_by(F.col(value), F.struct(F.col(by), F.col(value)))


def dealt_out(df: DataFrame, *keys: str, rows_per_task: int = 500_000) -> DataFrame:
    """``df`` written once and dealt out by ``keys``, about ``rows_per_task`` rows to a task.

    For aggregates with several distinct counts, which hold each row once for each of them: the number of
    tasks follows the counted rows, so the memory of one task does not grow with the table.
    """
    saved = cut_lineage(df)
    return saved.repartition(max(1, math.ceil(saved.count() / rows_per_task)), *keys)


def grain_counts(df: DataFrame, grain: Sequence[str], rows: str = "n") -> DataFrame:
    """One row per value of ``grain`` with its number of rows; a task holds the values of about as many rows at any size."""
    return dealt_out(df.select(*grain), *grain).groupBy(*grain).agg(F.count(F.lit(1)).alias(rows))


def distinct_by_group(grain: DataFrame, group: str, keys: dict[str, str], rows: str, rows_per_task: int = 500_000) -> DataFrame:
    """Per ``group`` the sum of ``rows`` and the distinct values of each of ``keys``, under its new name.

    For keys of very many values. Each is dealt out on its own, by counted rows; several distinct counts
    in one aggregate would copy every row once for each of them, and merge tasks by their bytes.
    """
    saved = cut_lineage(grain)
    tasks = max(1, math.ceil(saved.count() / rows_per_task))
    names = [*keys.values(), rows]

    def part(df: DataFrame, own: str, value: Column) -> DataFrame:
        return df.select(group, *[(value if c == own else F.lit(0)).cast("bigint").alias(c) for c in names])

    found = [part(saved, rows, F.col(rows))]
    for key, name in keys.items():
        each = saved.select(group, key).where(F.col(key).isNotNull()).repartition(tasks, group, key).distinct()
        found.append(part(each, name, F.lit(1)))
    return reduce(DataFrame.unionByName, found).groupBy(group).agg(*[F.sum(c).alias(c) for c in names])


def count_distinct_grain(df: DataFrame, group: Sequence[str], keys: Sequence[str], rows: str = "n_rows", place: Sequence[str] = ()) -> DataFrame:
    """Row count and distinct counts of ``keys`` per group, from a frame first collapsed to its grain.

    The grain is dealt out to tasks by ``place``, by default by all its columns.
    """
    grain_columns = [*group, *[k for k in keys if k not in group]]
    return dealt_out(grain_counts(df, grain_columns, "_n"), *(place or grain_columns)).groupBy(*group).agg(
        F.sum("_n").alias(rows), *[F.countDistinct(k).alias(f"n_{k}") for k in keys]
    )


def distinct_counts(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row with the exact number of distinct values of each column, under its new name.

    Each column is scanned and shuffled on its own, distinct values only; one aggregate with
    several distinct counts would copy every row once for each column.
    """
    parts = [df.select(c).where(F.col(c).isNotNull()).distinct().agg(F.count(F.lit(1)).alias(name)) for c, name in columns.items()]
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), parts)  # one row each


def long_form(one_row: DataFrame, name: str, value: str, columns: Sequence[str], kind: str) -> DataFrame:
    """One-row aggregate as (name, value) rows."""
    pairs = [F.struct(F.lit(c).alias(name), F.col(c).cast(kind).alias(value)) for c in columns]
    return one_row.select(F.inline(F.array(*pairs)))


def missingness(df: DataFrame, digits: int = 6) -> DataFrame:
    """Share of nulls per column, from one pass."""
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    return long_form(shares, "column", "missing", df.columns, "double").withColumn(
        "missing", round_half_away(F.col("missing"), digits)
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the rows in all and the nulls per column."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    )


def top_values(df: DataFrame, column: str, k: int = 15) -> DataFrame:
    """Most frequent values as text; ties in value order."""
    text = F.col(column).cast("string")
    return df.groupBy(text.alias(column)).agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.desc("count"), F.asc_nulls_last(column)
    ).limit(k)


def profile_columns(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per column: position, type, nulls, null share, distinct values and the smallest value as text.

    Exact distinct counts take a narrow scan per column; ``exact=False`` uses sketches and
    needs one pass without a row-sized shuffle.
    """
    facts = []
    for i, (c, _) in enumerate(df.dtypes):
        facts += [
            F.count_if(F.col(c).isNull()).alias(f"_nulls_{i}"),
            *([] if exact else [F.approx_count_distinct(F.col(c)).alias(f"_unique_{i}")]),
            F.min(F.col(c).cast("string")).alias(f"_sample_{i}"),
        ]
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *facts)
    if exact:
        one = one.crossJoin(F.broadcast(distinct_counts(df, {c: f"_unique_{i}" for i, c in enumerate(df.columns)})))  # one row each
    rows = [
        F.struct(
            F.lit(i + 1).cast("bigint").alias("position"),
            F.lit(c).alias("column"),
            F.lit(kind).alias("type"),
            F.col(f"_nulls_{i}").alias("nulls"),
            percent(F.col(f"_nulls_{i}"), F.col("_rows")).alias("null_pct"),
            F.col(f"_unique_{i}").alias("uniques"),
            F.col(f"_sample_{i}").alias("sample"),
        )
        for i, (c, kind) in enumerate(df.dtypes)
    ]
    return one.select(F.inline(F.array(*rows)))


def grain_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Labelled rows: total rows, then the distinct values of each key."""
    total = df.agg(F.count(F.lit(1)).alias("total_rows"))
    facts = total.crossJoin(F.broadcast(distinct_counts(df, {k: f"unique_{k}" for k in keys})))  # one row each
    return long_form(facts, "metric", "count", facts.columns, "bigint")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)
