"""Join shapes the corpus jobs need beyond ``DataFrame.join``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree.session import cut_lineage

_WHOLE = ("byte", "short", "integer", "long")


def broadcast_up_to(df: DataFrame, max_bytes: int) -> DataFrame:
    """Mark ``df`` for broadcast only when its values take at most ``max_bytes``.

    The size is one combined aggregate; text counts its bytes, any other value 16. A larger
    side is returned unmarked and joins by shuffle.
    """
    sizes = [F.coalesce(F.octet_length(c), F.lit(0)) + 16 if kind == "string" else F.lit(16) for c, kind in df.dtypes]
    total = df.agg(F.sum(reduce(lambda a, b: a + b, sizes).cast("bigint")).alias("n")).first()["n"] or 0
    return F.broadcast(df) if total <= max_bytes else df


def _bitmaps(places: DataFrame, where: str) -> DataFrame:
    """``(_bucket, _bits)``: the whole numbers from 1 on in ``where`` as bitmaps of 32,768, without nulls."""
    bucket = F.bitmap_bucket_number(where).alias("_bucket")
    dealt = places.where(F.col(where).isNotNull()).select(bucket, F.bitmap_bit_position(where).alias("_bit")).repartition("_bucket")
    return cut_lineage(dealt.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits")))


def _marked(df: DataFrame, bitmaps: DataFrame, place: Column, name: str) -> DataFrame:
    """``df`` with ``name``: whether the bitmaps, which are broadcast, hold ``place``; false for a null."""
    placed = df.withColumn("_place", place).withColumn("_bucket", F.bitmap_bucket_number("_place"))
    met = placed.join(F.broadcast(bitmaps), "_bucket", "left")
    at = F.bitmap_bit_position("_place").cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.call_function("shiftright", byte, at % 8).bitwiseAND(1) == 1
    return met.withColumn(name, F.coalesce(hit, F.lit(False))).drop("_place", "_bucket", "_bits")


def split_by_keys(
    df: DataFrame, keys: DataFrame, on: str, max_broadcast_bytes: int = 32 << 20, few: int = 1_000_000
) -> tuple[DataFrame, DataFrame | None]:
    """``df`` as rows whose key may occur in ``keys``, and rows whose key does not, so that a join moves the first only.

    The hashes of the keys are broadcast as bitmaps of eight bits a key, fewer where that exceeds
    ``max_broadcast_bytes``. With up to ``few`` keys, or with too many to tell rows apart, all rows may occur.
    """
    many = keys.count()
    bits = min(8 * many, 8 * max_broadcast_bytes)
    if many <= few or bits < 2 * many:
        return df, None
    place = F.pmod(F.xxhash64(on), F.lit(bits)) + 1
    tagged = _marked(df, _bitmaps(keys.select(place.alias("_at")), "_at"), place, "_may")
    return tagged.where("_may").select(*df.columns), tagged.where("not _may").select(*df.columns)


def tagged_by_keys(df: DataFrame, keys: DataFrame, on: str, name: str, max_broadcast_bytes: int = 32 << 20) -> DataFrame:
    """``df`` with ``name``: whether its key occurs in ``keys``.

    Whole numbers that lie close enough together are broadcast as a bitmap, which is exact; other keys are joined.
    """
    if df.schema[on].dataType.typeName() in _WHOLE and keys.schema[on].dataType.typeName() in _WHOLE:
        low, high = keys.agg(F.min(F.col(on).cast("bigint")), F.max(F.col(on).cast("bigint"))).first()
        if low is not None and high - low < 8 * max_broadcast_bytes:
            own = F.col(on).cast("bigint")
            place = F.when(own.between(low, high), own - F.lit(low) + 1)
            return _marked(df, _bitmaps(keys.select(place.alias("_at")), "_at"), place, name)
    known = keys.select(on).where(F.col(on).isNotNull()).distinct().withColumn(name, F.lit(True))
    return df.join(known, on, "left").select(*df.columns, F.coalesce(name, F.lit(False)).alias(name))


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is shuffled, whatever the planner takes its size to be.

    Files of companies or names compress so well that the planner would send many rows through
    the driver.
    """
    return df.hint("merge")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; keeps the keys once."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def semi(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return df.join(keys.select(on), on, "left_semi")


def anti(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key does not occur in ``keys``; null keys are kept (NOT EXISTS)."""
    return df.join(keys.select(on), on, "left_anti")


def not_in(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """SQL ``NOT IN``: no rows when ``keys`` holds a null, null keys dropped unless ``keys`` is empty.

    Built from a hash anti-join and two one-row facts, so that no null-aware
    nested loop is needed.
    """
    facts = keys.agg(
        F.count(F.lit(1)).alias("_n"), F.coalesce(F.max(F.col(on).isNull()), F.lit(False)).alias("_has_null")
    )
    kept = anti(df, keys.filter(F.col(on).isNotNull()), on).crossJoin(F.broadcast(facts))
    passes = (F.col("_n") == 0) | (~F.col("_has_null") & F.col(on).isNotNull())
    return kept.filter(passes).select(*df.columns)


def left_on_normalised(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column) -> DataFrame:
    """Left join on derived keys; the helper columns are dropped again."""
    a = left.withColumn("_k", left_key)
    b = right.withColumn("_k", right_key)
    return a.join(b, "_k", "left").drop("_k")


def list_contains_join(left: DataFrame, right: DataFrame, key: str, list_column: str, how: str = "inner") -> DataFrame:
    """Join where ``left.key`` is an element of ``right.list_column``, as an equi-join on the items."""
    items = right.withColumn("_item", F.explode(F.array_distinct(F.col(list_column))))
    return left.join(items, left[key] == items["_item"], how).drop("_item")


def _pieces(text: Column, size: Column) -> Column:
    """All different substrings of ``size`` characters."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substring(text, i, size)))


PIECES = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64)


def contains_join(names: DataFrame, patterns: DataFrame, name: str, pattern: str, sizes: Sequence[int] = PIECES) -> DataFrame:
    """Pairs of rows where ``name`` contains ``pattern``, for any number of patterns.

    A pattern is looked up by one of its pieces, the one that the fewest names have. Pieces have the
    largest of ``sizes`` that the pattern holds: short ones would be shared by ever more names as
    the table grows. Names and patterns meet by an equi-join on that piece and are
    then verified, so neither side is compared with the whole other side. An empty pattern is
    contained in every name; a null matches nothing. The column names of both sides must differ.
    """
    texts = patterns.select(pattern).where(F.col(pattern).isNotNull()).distinct()
    own = by_shuffle(names.where(F.col(name).isNotNull()).select(name).distinct())
    fitting = F.array_max(F.filter(F.array(*[F.lit(s) for s in sizes]), lambda s: s <= F.length(pattern)))
    sized = texts.where(F.length(pattern) >= min(sizes)).withColumn("_size", fitting)
    used = [r[0] for r in sized.select("_size").distinct().collect()]  # some of the sizes
    wanted = sized.select(pattern, F.explode(_pieces(F.col(pattern), F.col("_size"))).alias("_piece"))
    none = F.array().cast("array<string>")
    cut = [F.when(F.length(name) >= s, _pieces(F.col(name), F.lit(s))).otherwise(none) for s in used]
    held = own.select(name, F.explode(F.concat(none, *cut)).alias("_piece"))
    usual = held.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n"))
    rarest = wanted.join(by_shuffle(usual), "_piece").groupBy(pattern).agg(F.min(F.struct("_n", "_piece")).alias("_r"))
    met = by_shuffle(held).join(rarest.select(pattern, F.col("_r._piece").alias("_piece")), "_piece")
    found = met.where(F.contains(F.col(name), F.col(pattern))).select(name, pattern)
    found = found.unionByName(own.join(F.broadcast(texts.where(F.length(pattern) == 0)), how="cross"))  # one row
    return by_shuffle(names).join(found.distinct(), name).join(by_shuffle(patterns), pattern)


def any_of_join(
    suspects: DataFrame, dim: DataFrame, suspect_key: str, dim_key: str, id_pair: tuple[str, str],
    name_pair: tuple[str, str], item_pair: tuple[str, str],
) -> DataFrame:
    """Pairs (suspect_key, dim_key) where ids agree, the name contains a pattern, or a list holds an item.

    An OR condition would become a nested loop over everything; each branch is an equi-join.
    """
    pair = [suspect_key, dim_key]
    by_id = suspects.join(by_shuffle(dim), suspects[id_pair[0]] == dim[id_pair[1]]).select(*pair)
    by_item = list_contains_join(by_shuffle(suspects), dim, item_pair[0], item_pair[1]).select(*pair)
    named = dim.select(dim_key, F.upper(F.col(name_pair[1])).alias("_name")).distinct()
    patterns = suspects.select(suspect_key, F.col(name_pair[0]).alias("_pattern")).distinct()
    by_name = contains_join(named, patterns, "_name", "_pattern").select(*pair)
    return by_id.unionByName(by_item).unionByName(by_name).distinct()
