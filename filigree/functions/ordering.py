"""Orderings that put nulls last both ways, and replayable shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_key(name: str) -> Column:
    """``"x"`` sorts ascending, ``"-x"`` descending; nulls last either way."""
    if name.startswith("-"):
        return F.col(name[1:]).desc_nulls_last()
    return F.col(name).asc_nulls_last()


def order_by(df: DataFrame, *names: str) -> DataFrame:
    """Sort with nulls last, the convention of the SQL the results are compared with."""
    return df.orderBy(*[sort_key(n) for n in names])


def top_k(df: DataFrame, k: int, *names: str) -> DataFrame:
    """The first ``k`` rows; end ``names`` with a unique key so that ties cannot move rows."""
    return order_by(df, *names).limit(k)


def replay_hash(seed: int | str, *keys: str) -> Column:
    """Hex digest that orders rows at random but the same way on every run and engine."""
    parts = [F.lit(str(seed))] + [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", *parts))


def unit_interval(digest: Column) -> Column:
    """The leading 32 bits of a hex digest as a number in [0, 1), monotone in the digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
