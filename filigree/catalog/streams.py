"""Registered queries: streaming reads and merges, run over all data that is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from filigree.catalog.registry import Catalog
from filigree.operators.numbering import key_ranges
from filigree.session import fresh_path
from filigree.sinks.versions import VersionedTable
from filigree.sinks.writers import write_parquet
from filigree.sources.fixture_sql import EVENTS_SPLIT, with_views
from filigree.streaming import merges as st

catalog = Catalog()


@catalog.query("src9_first_rows_of_stream", "SELECT least(count(*), 1000) AS n_rows, least(count(*), 1000) AS n_of_table FROM events")
def _(t):
    """Which rows come first is up to the stream; how many, and that all are rows of the table, is not."""
    stream = st.file_stream(t.spark, t.folder, t.events.schema, names="events.parquet")
    got = st.first_rows_of_stream(stream, 1000, fresh_path(t.spark, "first"), fresh_path(t.spark, "cp"))
    known = t.events.select("event_id", F.lit(1).alias("known")).distinct()
    return got.join(known, "event_id", "left").agg(F.count(F.lit(1)).alias("n_rows"), F.count("known").alias("n_of_table"))


@catalog.query(
    "st1_streaming_merge",
    with_views(
        """
SELECT event_id, user_id, value FROM (SELECT *, 0 AS src FROM base UNION ALL SELECT *, 1 FROM incr)
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY src DESC, ts DESC) = 1""",
        EVENTS_SPLIT,
    ),
)
def _(t):
    """The increment arrives in several batches and is merged into a versioned table."""
    part = key_ranges(t.events, "event_id").alias("part")
    base = t.base_events.withColumn("ts", F.col("ts").cast("timestamp")).select("*", part)
    increment = t.increment_events.select("*", part)
    landing = write_parquet(increment.repartition(3), fresh_path(t.spark, "landing"))
    stream = st.file_stream(t.spark, landing, increment.schema, files_per_batch=1)
    out = VersionedTable(fresh_path(t.spark, "stream-merge"), by="part")
    merged = st.merge_stream(stream, base, out, "event_id", ["ts"], fresh_path(t.spark, "cp"))
    return merged.select("event_id", "user_id", "value")


@catalog.query(
    "st2_unique_on_ingest",
    "SELECT event_id, user_id, event_type FROM events",
)
def _(t):
    """All events twice in the landing folder; every key comes out once."""
    landing = fresh_path(t.spark, "landing")
    write_parquet(t.events, landing)
    write_parquet(t.events, landing, mode="append")
    stream = st.file_stream(t.spark, landing, t.events.schema)
    unique = st.unique_on_ingest(stream, "event_id", "ts", "40 days")
    out = st.run_to_parquet(unique, fresh_path(t.spark, "unique"), fresh_path(t.spark, "cp"))
    return out.select("event_id", "user_id", "event_type")
