"""List-column helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_sorted(list_column: Column) -> Column:
    """Aggregate: merge lists over a group into one sorted list of distinct items."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_set(list_column))))


def merge_lists(df: DataFrame, keys: Sequence[str], list_column: str, name: str) -> DataFrame:
    """Per group one sorted list of the distinct items of all lists; only distinct items are brought together."""
    items = df.select(*keys, F.explode(list_column).alias(name)).distinct()
    return items.groupBy(*keys).agg(F.array_sort(F.collect_list(name)).alias(name))


def joined_values(value: Column, separator: str = ",") -> Column:
    """Aggregate: distinct values in order as one text."""
    return F.array_join(F.array_sort(F.collect_set(value)), separator)


def list_sum(list_column: Column, kind: str = "bigint") -> Column:
    return F.aggregate(list_column, F.lit(0).cast(kind), lambda acc, x: acc + x.cast(kind))


def add_to_each(list_column: Column, number: float) -> Column:
    return F.transform(list_column, lambda x: x + F.lit(number))


def between_each(list_column: Column, low: float, high: float) -> Column:
    """Element-wise range test."""
    return F.transform(list_column, lambda x: (x >= F.lit(low)) & (x <= F.lit(high)))


def multiply_lists(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: a * b)


def first_item(list_column: Column) -> Column:
    return F.try_element_at(list_column, F.lit(1))
