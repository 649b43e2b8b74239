"""Exact duplicates by digest, with frequent digests split off before the shuffle.

DataFrame functions only. A Misra-Gries style sketch (Spark's ``approx_top_k``) of a hash of each
digest names the candidates for frequent digests. It is kept for each of ``BUCKETS`` ranges of the
hash, so that no task gathers the sketches of all partitions. The candidates are counted exactly;
these verified winners, at most ``BUCKETS * TOP`` rows whatever the input, are broadcast and their
documents are settled where they are read. The remaining digests go through an ordinary shuffle in
which no group holds more than the sketch's error, a 96th of its bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filigree.llm.common import ascii_lower, stage

BUCKETS, TOP, TRACKED = 32, 16, 128


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_id, digest)``: SHA-256 of the text with A-Z lower-cased, in hex; null counts as empty."""
    text = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return docs.select(F.col(id_col).alias("_id"), F.sha2(text.cast("binary"), 256).alias("digest"))


def frequent(table: DataFrame) -> DataFrame:
    """Verified frequent digests with their size and winner: ``(digest, keep_id, group_size)``."""
    hashed = table.select(F.xxhash64("digest").alias("h"))
    sketch = hashed.groupBy(F.pmod("h", F.lit(BUCKETS)).alias("bucket")).agg(F.expr(f"approx_top_k(h, {TOP}, {TRACKED})").alias("top"))
    candidates = sketch.select(F.explode("top.item").alias("h"))
    counted = table.withColumn("h", F.xxhash64("digest")).join(F.broadcast(candidates), "h", "left_semi")
    exact = counted.groupBy("digest").agg(F.max("_id").alias("keep_id"), F.count("*").alias("group_size"))
    return exact.where("group_size > 1").orderBy(F.desc("group_size"), "digest").limit(BUCKETS * TOP)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, keep_id, group_size, kept, text_sha256)`` for every row of ``docs``.

    Rows with equal text form a group, of which the largest id stays. Null and empty texts are one
    group. Null ids are never the largest; in a group of null ids only, every row is ``kept``, and so
    is every row that repeats the winner's id, since nothing tells such rows apart. An empty table
    gives an empty result; other columns are not read.
    """
    table = stage(digests(docs, id_col, text_col))
    winners = stage(frequent(table))
    hot = table.join(F.broadcast(winners), "digest")
    rest = table.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    group = Window.partitionBy("digest")
    cold = rest.select("digest", "_id", F.max("_id").over(group).alias("keep_id"), F.count("*").over(group).alias("group_size"))
    both = hot.select(cold.columns).unionByName(cold)
    return both.select(F.col("_id").alias(id_col), "keep_id", "group_size", F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"))


SQL = """
WITH n AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS s FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, s AS text_sha256
FROM n WINDOW g AS (PARTITION BY s)
"""
