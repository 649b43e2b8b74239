"""Reading the corpus' input formats."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Banner and header cells of the exported holdings sheet.
SHEET_BANNERS = ("Fund Name:", "Ticker Symbol:", "Holdings:", "Name", "[NULL]")
SHEET_MARKS = ("-", "SPY", "Ticker")
SHEET_DATE_MARK = "As of "


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """One or several Parquet locations (local, ``hdfs://`` or ``s3a://``) as one frame."""
    return spark.read.parquet(*paths)


def spread(df: DataFrame) -> DataFrame:
    """A scan with fewer splits than cores, dealt out to all of them; larger scans are left alone.

    A Parquet file is read by at most one task per row group. That only matters for a
    table of a few row groups whose rows are expensive to process.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() <= cores else df


def spread_by_key(
    df: DataFrame, key: str, other: DataFrame, other_key: str, rows_per_task: int = 500_000
) -> tuple[DataFrame, DataFrame]:
    """Both sides of an equi-join, dealt out by its keys so that a task holds about ``rows_per_task`` rows of ``df``.

    The number of tasks follows the counted rows; with a fixed number, or tasks merged by their compressed
    bytes, the memory of one task would grow with the table. Few rows are only dealt out to all cores.
    """
    tasks = math.ceil(df.count() / rows_per_task)
    if tasks <= df.sparkSession.sparkContext.defaultParallelism:
        return spread(df), other
    return df.repartition(tasks, key), other.repartition(tasks, other_key)


def union_splits(frames: Sequence[DataFrame]) -> DataFrame:
    """Splits stacked by column name."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def read_json_objects(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """A JSON file holding one object of objects, as one row per inner object."""
    whole = spark.read.text(path, wholetext=True)
    parsed = whole.select(F.explode(F.from_json("value", f"map<string,struct<{fields}>>")).alias("key", "item"))
    return parsed.select("key", "item.*")


def read_ticker_map(spark: SparkSession, path: str) -> DataFrame:
    """The public company ticker file: company key, ticker and name."""
    raw = read_json_objects(spark, path, "cik_str:string,ticker:string,title:string")
    return raw.select(F.col("cik_str").cast("int").alias("cik"), "ticker", F.col("title").alias("company_name"))


def read_holdings(spark: SparkSession, path: str) -> DataFrame:
    """An exported holdings sheet (CSV without header): banner rows dropped, cells trimmed, numbers cleaned."""
    names = ["company_name", "ticker", "identifier", "sedol", "weight_pct", "sector", "shares_held", "local_currency"]
    raw = spark.read.csv(path, header=False, schema=", ".join(f"{n} string" for n in names))
    return clean_holdings(raw)


def clean_holdings(raw: DataFrame) -> DataFrame:
    name, ticker = F.col("company_name"), F.col("ticker")
    kept = raw.filter(
        ~name.isin(*SHEET_BANNERS)
        & ticker.isNotNull()
        & ~ticker.isin(*SHEET_MARKS)
        & ~ticker.startswith(SHEET_DATE_MARK)
    )

    def number(c: str, kind: str):
        return F.regexp_replace(F.trim(F.col(c)), ",", "").try_cast(kind).alias(c)

    numeric = {"weight_pct": "double", "shares_held": "bigint"}
    return kept.select(*[number(c, numeric[c]) if c in numeric else F.trim(F.col(c)).alias(c) for c in kept.columns])


def read_csv_log(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A CSV log with header; the schema is given, so the file is read once."""
    return spark.read.csv(path, header=True, schema=schema)


def schema_frame(df: DataFrame) -> DataFrame:
    """Column name, type and 1-based position of ``df``."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes, 1)]
    return df.sparkSession.createDataFrame(rows, "position bigint, column_name string, data_type string")


def catalog_columns(spark: SparkSession, table: str) -> DataFrame:
    """Columns of a registered table or view, from the session catalog."""
    rows = [(table, i, c.name, c.dataType) for i, c in enumerate(spark.catalog.listColumns(table), 1)]
    return spark.createDataFrame(rows, "table_name string, position bigint, column_name string, data_type string")


def file_inventory(spark: SparkSession, *paths: str) -> DataFrame:
    """Per data file: rows, bytes, mean bytes of a row and time of the last change, from Spark's file metadata.

    Only the row count is read from the files, not their columns. Spark does not expose single
    row groups; the splits it plans stand in for them: their number and mean rows.
    """
    scanned = spark.read.parquet(*paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_modification_time").alias("changed"), F.col("_metadata.file_block_start").alias("split"),
    )
    return scanned.groupBy("path").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("bytes").alias("bytes"), F.max("changed").alias("changed"),
        (F.max("bytes") / F.count(F.lit(1))).alias("bytes_per_row"), F.min("split").alias("first_split"), F.max("split").alias("last_split"),
    )


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows met; which ones they are depends on the source order."""
    return df.limit(n)
