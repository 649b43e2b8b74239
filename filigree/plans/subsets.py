"""Declarative subset tables: a company list and a temporal filter per table."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filigree.functions.bins import Bin
from filigree.operators.joins import tagged_by_keys
from filigree.session import cut_lineage, drop_stage
from filigree.sinks.writers import write_parquet


class Subset(NamedTuple):
    """One subset job. ``temporal_filter`` is ALL_BINS, MODERN_ONLY, HISTORICAL_ONLY or a year pair."""

    name: str
    companies: str
    temporal_filter: str | tuple[int, int]
    description: str = ""
    enabled: bool = True


def temporal_condition(wanted: str | tuple[int, int], bins: Sequence[Bin]) -> Column:
    newest, older = bins[-1].label, [b.label for b in bins[:-1]]
    if wanted == "ALL_BINS":
        return F.lit(True)
    if wanted == "MODERN_ONLY":
        return F.col("temporal_bin") == newest
    if wanted == "HISTORICAL_ONLY":
        return F.col("temporal_bin").isin(older)
    if isinstance(wanted, tuple):
        return F.col("report_year").between(*wanted)
    raise ValueError(f"unknown temporal filter {wanted!r}")


def run_subsets(
    fact: DataFrame, companies: dict[str, DataFrame], subsets: Sequence[Subset], folder: str, bins: Sequence[Bin],
    rows_at_once: int = 1 << 26,
) -> dict[str, DataFrame]:
    """Write every enabled subset, clustered by company and year, and return the written tables.

    What any subset needs is dealt out and sorted once, ``rows_at_once`` by ranges of companies, so that the disk
    for shuffles is bounded; the subsets are read from that and not shuffled again.
    """
    chosen = [s for s in subsets if s.enabled]
    spark, marks = fact.sparkSession, {}
    tagged = fact
    for name in dict.fromkeys(s.companies for s in chosen):
        marks[name] = f"_listed_{len(marks)}"
        tagged = tagged_by_keys(tagged, companies[name], "cik_int", marks[name])
    wanted = {s.name: F.col(marks[s.companies]) & temporal_condition(s.temporal_filter, bins) for s in chosen}
    needed = cut_lineage(tagged.where(reduce(lambda a, b: a | b, wanted.values(), F.lit(False))))
    order = [F.col("cik_int"), F.col("report_year").desc(), F.col("section"), F.col("sentenceID")]
    passes = max(1, math.ceil(needed.count() / rows_at_once))
    edges = sorted(set(needed.approxQuantile("cik_int", [i / passes for i in range(1, passes)], 0.1 / passes))) if passes > 1 else []
    turn = sum(((F.col("cik_int") >= F.lit(int(e))).cast("int") for e in edges), F.lit(0))
    parts = []
    for i in range(len(edges) + 1):
        part = needed.where(F.coalesce(turn, F.lit(0)) == i) if edges else needed
        parts.append(cut_lineage(part.repartitionByRange("cik_int", "report_year", "sentenceID").sortWithinPartitions(*order)))
    drop_stage(needed)
    placed = reduce(DataFrame.unionByName, parts)
    out = {}
    for name, condition in wanted.items():
        rows = placed.where(condition).select(*fact.columns).sortWithinPartitions(*order)
        out[name] = spark.read.parquet(write_parquet(rows, f"{folder}/{name}"))
    drop_stage(placed)
    return out


def share_bucket(key: Column, modulus: int = 100) -> Column:
    """The bucket of a key, 0 to ``modulus - 1``, from its MD5; a null key counts as empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % modulus).cast("int")


def write_shares(df: DataFrame, key: str, folder: str, modulus: int = 100) -> str:
    """Store ``df`` by hash buckets of ``key``, so that a share reads only its own files.

    All rows of a key lie in one bucket. Buckets are dealt out by ranges of bucket and digest, and a
    frequent key's rows by their position too, so a large bucket is written by several tasks.
    """
    if "share_bucket" in df.columns:
        raise ValueError("the column name share_bucket is taken")
    placed = df.withColumn("share_bucket", share_bucket(F.col(key), modulus)).withColumn("_tie", F.monotonically_increasing_id())
    dealt = placed.repartitionByRange("share_bucket", F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), "_tie").drop("_tie")
    dealt.sortWithinPartitions("share_bucket").write.mode("errorifexists").partitionBy("share_bucket").parquet(folder)
    return folder


def read_share(spark: SparkSession, folder: str, keep: int) -> DataFrame:
    """The rows of the buckets below ``keep``; a larger share holds every row of a smaller one."""
    return spark.read.parquet(folder).where(F.col("share_bucket") < keep)
