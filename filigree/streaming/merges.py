"""Streaming forms of the first-rows read, the keyed merge and the ingest dedupe."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from filigree.plans.merge import merge_parts, merged_rows
from filigree.sinks.versions import VersionedTable


def file_stream(
    spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1000, names: str = "*.parquet"
) -> DataFrame:
    """Parquet files of a folder, by default all of them, as a stream."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.option("pathGlobFilter", names).parquet(folder)


def first_rows_of_stream(stream: DataFrame, n: int, out: str, checkpoint: str) -> DataFrame:
    """The first ``n`` rows a stream delivers, stored below ``out``.

    Batches are stored until ``n`` rows are there; later batches are skipped. What is stored is
    counted in ``out`` itself, so a restarted or repeated batch does not overshoot.
    """
    spark = stream.sparkSession
    schema = stream.schema

    def keep(batch: DataFrame, batch_id: int) -> None:
        path = f"{out}/batch={batch_id}"
        # A repeated batch overwrites its own folder, so its own rows do not count.
        batch.limit(0).write.mode("overwrite").parquet(path)
        missing = n - spark.read.schema(schema).parquet(out).count()
        if missing > 0:
            batch.limit(missing).write.mode("overwrite").parquet(path)

    query = (
        stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/batch=*")


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gives a stream at its first start and keeps in its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()[0])["id"]


def merge_stream(
    stream: DataFrame, base: DataFrame, out: VersionedTable, key: str, tie_break: Sequence[str], checkpoint: str
) -> DataFrame:
    """Merge every batch into the newest version of ``out``, starting from ``base``, each exactly once.

    A version names the last batch it holds of each stream, and becomes current together with that
    note. A batch that is repeated after a failure finds itself there and writes nothing; one that
    was staged and not published is written anew. The stream is known by the id that Spark keeps in
    ``checkpoint``, so a restart goes on and a new checkpoint begins again. Readers see whole versions
    only. A table with partitions rewrites only those that a batch falls into. One stream at a time
    may write to a table.
    """
    spark = stream.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        name = _stream_id(spark, checkpoint)
        if out.last_batch(spark, name) >= batch_id:
            return
        out.discard_unpublished(spark, name, batch_id)
        current = out.read(spark)
        rows = batch.persist()  # read several times below
        try:
            if current is None:
                version = out.stage(merged_rows(base, rows, key, tie_break))
            elif out.by:
                version = merge_parts(spark, rows, out, key, tie_break)[0]
            else:
                version = out.stage(merged_rows(current, rows, key, tie_break, base_is_unique=True))
        finally:
            rows.unpersist()
        out.record(spark, version, name, batch_id)
        out.publish(spark, version)

    query = (
        stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    merged = out.read(spark)
    return base if merged is None else merged


def unique_on_ingest(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Drop repeated keys that arrive within ``delay`` of each other; state older than that is forgotten."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def run_to_parquet(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Run a stream over all data that is there, append to Parquet, and read the result."""
    query = (
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)
