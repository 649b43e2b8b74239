"""Comparing the schemas of two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.sources.readers import schema_frame

TIME_TYPES = ("timestamp", "timestamp_ntz")


def compare_schemas(
    left: DataFrame, right: DataFrame, renames: dict[str, str] | None = None, derived: Sequence[str] = ()
) -> DataFrame:
    """Per column: types and positions on both sides and a status.

    Right-hand names go through ``renames`` first; names are compared without case and
    blanks. ``derived`` columns may be missing on either side.
    """
    renames = renames or {}
    names = {c: renames.get(c, c) for c in right.columns}
    shadowed = {new for old, new in names.items() if old != new}
    mapped = right.select(
        *[F.col(f"`{c}`").alias(names[c]) for c in right.columns if c == names[c] and c not in shadowed or c != names[c]]
    )

    def normal(df: DataFrame, side: str) -> DataFrame:
        return schema_frame(df).select(
            F.upper(F.trim("column_name")).alias("key"),
            F.col("column_name").alias(f"{side}_name"),
            F.col("data_type").alias(f"{side}_type"),
            F.col("position").alias(f"{side}_position"),
        )

    both = normal(left, "left").join(normal(mapped, "right"), "key", "full_outer")
    computed = F.col("key").isin(*[c.strip().upper() for c in derived]) if derived else F.lit(False)
    missing = F.col("left_type").isNull() | F.col("right_type").isNull()
    status = (
        F.when(missing & computed, "derived")
        .when(F.col("left_type").isNull(), "right_only")
        .when(F.col("right_type").isNull(), "left_only")
        .when(F.col("left_type") == F.col("right_type"), "match")
        .when(F.col("left_type").isin(*TIME_TYPES) & F.col("right_type").isin(*TIME_TYPES), "time_precision")
        .otherwise("type_difference")
    )
    return both.select(
        F.coalesce("left_name", "right_name").alias("column_name"),
        "left_type", "right_type", "left_position", "right_position", status.alias("status"),
    )


def schema_verdict(comparison: DataFrame) -> DataFrame:
    """One row: columns per status and whether the tables can be merged."""

    def n(status: str):
        return F.count_if(F.col("status") == status)

    critical = n("left_only") + n("right_only") + n("type_difference")
    return comparison.agg(
        F.count("left_type").alias("left_columns"),
        F.count("right_type").alias("right_columns"),
        n("match").alias("matching"),
        n("left_only").alias("left_only"),
        n("right_only").alias("right_only"),
        n("derived").alias("derived"),
        (n("type_difference") + n("time_precision")).alias("type_differences"),
        critical.alias("critical_issues"),
        F.when(critical == 0, "compatible").otherwise("needs_attention").alias("verdict"),
    )


def check_required(required: Sequence[str], left: DataFrame, right: DataFrame) -> DataFrame:
    """Per required column: which of two tables has it."""
    spark = left.sparkSession
    wanted = spark.createDataFrame([(c,) for c in required], "column_name string")
    a = schema_frame(left).select("column_name", F.lit(True).alias("a"))
    b = schema_frame(right).select("column_name", F.lit(True).alias("b"))
    found = wanted.join(a, "column_name", "left").join(b, "column_name", "left")
    in_left, in_right = F.coalesce("a", F.lit(False)), F.coalesce("b", F.lit(False))
    status = F.when(in_left & in_right, "both").when(in_left | in_right, "one").otherwise("none")
    return found.select("column_name", in_left.alias("in_left"), in_right.alias("in_right"), status.alias("status"))
