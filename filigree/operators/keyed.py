"""One row per key: first, last, and keyed merges of tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, CalendarIntervalType, DataType, MapType, StructType, VariantType

from filigree.operators.joins import split_by_keys
from filigree.session import cut_lineage


def _pick(df: DataFrame, key: Sequence[str], order: Sequence[str], largest: bool) -> DataFrame:
    # An aggregate keeps one row per key and task before the shuffle, so a key with
    # very many copies never meets in one task; a ranking window would collect it.
    # The order stands first in the struct that is compared, so each column travels once;
    # rows tied on the whole order are told apart by their other columns.
    kept = [c for c in df.columns if c not in key]
    places = {c: f"_v{i}" for i, c in enumerate(dict.fromkeys([*order, *kept]))}
    values = []
    for c, place in places.items():
        if c in order and not largest:
            values.append(F.col(c).isNull().alias(f"_n{place}"))
        values.append(F.col(c).alias(place))
    picked = (F.max if largest else F.min)(F.struct(*values)).alias("_row")
    if not all(_orderable(df.schema[c].dataType) for c in kept):
        ahead = [v for c in order for v in ([F.col(c)] if largest else [F.col(c).isNull(), F.col(c)])]
        picked = (F.max_by if largest else F.min_by)(F.struct(*values), F.struct(*ahead)).alias("_row")
    return df.groupBy(*key).agg(picked).select(*[F.col(c) if c in key else F.col(f"_row.{places[c]}").alias(c) for c in df.columns])


def _orderable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (MapType, VariantType, CalendarIntervalType))


def first_by_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key the row that is smallest in ``order``; nulls come last."""
    return _pick(df, key, order, largest=False)


def first_of_repeated(df: DataFrame, key: Sequence[str], order: Sequence[str], max_broadcast_bytes: int = 32 << 20) -> DataFrame:
    """``first_by_key`` of a wide table in which few keys repeat: rows whose key occurs once are not shuffled.

    Hashes of the keys are counted first; only rows of a hash that occurs more than once meet. Where
    these hashes are too many to broadcast, all rows do. ``df`` is computed several times.
    """
    place = F.xxhash64(*key)
    counted = df.select(place.alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    repeated = cut_lineage(counted.where("_n > 1").select("_hash"))
    many = repeated.count()
    if many * 16 > max_broadcast_bytes:
        return first_by_key(df, key, order)
    if not many:
        return df
    hashed = df.withColumn("_hash", place)
    once = hashed.join(F.broadcast(repeated), "_hash", "left_anti").select(*df.columns)
    again = hashed.join(F.broadcast(repeated), "_hash", "left_semi").select(*df.columns)
    return once.unionByName(first_by_key(again, key, order))


def last_by_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key the row that is largest in ``order``; nulls come last."""
    return _pick(df, key, order, largest=True)


def dedupe_last(inputs: Sequence[DataFrame], key: Sequence[str], tie_break: Sequence[str]) -> DataFrame:
    """Union of ``inputs`` with one row per key; later inputs win, then the largest ``tie_break``."""
    ranked = [df.withColumn("_source", F.lit(i)) for i, df in enumerate(inputs)]
    merged = ranked[0]
    for df in ranked[1:]:
        merged = merged.unionByName(df)
    return last_by_key(merged, key, ["_source", *tie_break]).drop("_source")


def upsert(target: DataFrame, staged: DataFrame, key: str, max_broadcast_bytes: int = 32 << 20, few: int = 1_000_000) -> DataFrame:
    """Target rows whose key is not staged, then all staged rows.

    With more than ``few`` staged rows, target rows whose key cannot be staged are not shuffled (see ``split_by_keys``).
    """
    may, cannot = split_by_keys(target, staged, key, max_broadcast_bytes, few)
    kept = may.join(staged.select(key), key, "left_anti").select(*target.columns)
    return (kept if cannot is None else cannot.unionByName(kept)).unionByName(staged)


def delete_keys(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Target without the rows whose key is listed."""
    return target.join(keys.select(key), key, "left_anti").select(*target.columns)


def update_null_from(target: DataFrame, lookup: DataFrame, key: str, column: str) -> DataFrame:
    """Fill nulls of ``column`` from ``lookup``; of several values per key the smallest is taken."""
    found = lookup.groupBy(key).agg(F.min(column).alias("_found"))
    filled = F.coalesce(F.col(column), F.col("_found")).alias(column)
    return target.join(found, key, "left").select(*[filled if c == column else F.col(c) for c in target.columns])
