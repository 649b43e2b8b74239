"""Writing tables, artifacts and logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(
    df: DataFrame, path: str, codec: str = "zstd", block_bytes: int | None = None, partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
) -> str:
    """Parquet export; row groups are set in bytes, the unit the writer knows."""
    writer = df.write.mode(mode).option("compression", codec)
    if block_bytes:
        writer = writer.option("parquet.block.size", block_bytes)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def export_dimensions(tables: dict[str, DataFrame], folder: str, codec: str = "zstd") -> DataFrame:
    """Write every table below ``folder``; the manifest lists name, location and rows written."""
    first = next(iter(tables.values()))
    manifest = None
    for name, df in tables.items():
        path = write_parquet(df, f"{folder}/{name}", codec)
        row = first.sparkSession.read.parquet(path).agg(
            F.lit(name).alias("table_name"), F.lit(path).alias("location"), F.count(F.lit(1)).alias("rows_exported")
        )
        manifest = row if manifest is None else manifest.unionByName(row)
    return manifest


def create_table(df: DataFrame, name: str, path: str | None = None, temporary: bool = False) -> DataFrame:
    """Create or replace a session view or a catalog table and return it."""
    if temporary:
        df.createOrReplaceTempView(name)
    else:
        writer = df.write.mode("overwrite")
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(name)
    return df.sparkSession.table(name)


def safe_name(name: str) -> str:
    """A dataset name usable as one path segment."""
    return name.replace("/", "__").replace(":", "__")


def snapshot_path(folder: str, dataset: str, split: str, tag: str = "sample", config: str | None = None) -> str:
    parts = [safe_name(dataset)] + ([safe_name(config)] if config else []) + [split, tag]
    return f"{folder.rstrip('/')}/{'__'.join(parts)}.parquet"


def write_snapshot(
    df: DataFrame, folder: str, dataset: str, split: str, tag: str = "sample", config: str | None = None
) -> str:
    """Parquet snapshot under a name made of dataset, configuration, split and tag."""
    return write_parquet(df, snapshot_path(folder, dataset, split, tag, config), mode="overwrite")


def write_csv(df: DataFrame, path: str) -> str:
    """CSV artifact with header."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def kpi_export(df: DataFrame, dataset: str) -> DataFrame:
    """Sentences as nested records with the export's header fields on each line."""
    meta = F.struct(
        F.col("name").alias("company_name"), "cik", F.col("docID").alias("document_id"), "section", "report_year",
        F.col("filingDate").alias("filing_date"),
    )
    criteria = F.struct(F.lit(True).alias("likely_kpi"), F.lit(True).alias("has_numbers"))
    return df.select(
        F.lit(dataset).alias("dataset"), criteria.alias("filter_criteria"),
        F.struct(F.col("sentenceID").alias("sentence_id"), F.col("sentence").alias("sentence_text"), meta.alias("metadata")).alias("sentence"),
    )


def write_json(df: DataFrame, path: str) -> str:
    """One JSON object per line."""
    df.write.mode("overwrite").json(path)
    return path


def append_log(row: DataFrame, path: str) -> None:
    """Append run-log rows as CSV; each run adds files and rewrites nothing."""
    row.coalesce(1).write.mode("append").option("header", True).csv(path)
