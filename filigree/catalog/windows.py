"""Registered queries: window functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from filigree.catalog.registry import Catalog
from filigree.functions.numbers import percent, ratio, round_half_away
from filigree.functions.ordering import replay_hash
from filigree.operators import windows as w
from filigree.operators.keyed import last_by_key
from filigree.operators.numbering import append_numbers
from filigree.sources.fixture_sql import EVENTS_SPLIT, TARGETS, on_sentences, with_views

catalog = Catalog()

YEARLY = "yearly AS (SELECT year(o_orderdate) AS y, count(*) AS n, count(DISTINCT o_custkey) AS n_companies FROM orders GROUP BY 1)"


def yearly(t):
    return t.orders.groupBy(F.year("o_orderdate").cast("bigint").alias("y")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("n_companies")
    )


@catalog.query(
    "w1_random_rank_in_stratum",
    """SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus
  ORDER BY md5('7|' || o_orderkey), o_orderkey) AS rn FROM orders""",
)
def _(t):
    hashed = t.orders.withColumn("h", replay_hash(7, "o_orderkey"))
    return w.running(hashed, ["o_orderpriority", "o_orderstatus"], ["h", "o_orderkey"], position="rn").select(
        "o_orderkey", "o_orderpriority", "rn"
    )


@catalog.query(
    "w3_count_over_partition",
    on_sentences("SELECT sentenceID, name, count(*) OVER (PARTITION BY name) AS company_total FROM sentences"),
)
def _(t):
    rows = t.sentences.select("sentenceID", "name")
    return w.with_group_aggregates(rows, ["name"], {"company_total": F.count(F.lit(1))})


@catalog.query(
    "w4_share_and_mean_of_counts",
    on_sentences("""SELECT section, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct,
  round(avg(count(*)) OVER (), 2) AS mean_per_section FROM sentences GROUP BY section"""),
)
def _(t):
    whole = Window.partitionBy()
    counts = t.sentences.groupBy("section").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        "section", "n",
        percent(F.col("n"), F.sum("n").over(whole)).alias("pct"),
        round_half_away(F.avg("n").over(whole), 2).alias("mean_per_section"),
    )


@catalog.query(
    "w5_w6_running_sum_and_growth",
    with_views(
        """
SELECT y, n, n_companies, CAST(sum(n) OVER (ORDER BY y) AS BIGINT) AS cumulative, n - lag(n) OVER (ORDER BY y) AS growth,
  round((n - lag(n) OVER (ORDER BY y)) * 100.0 / nullif(lag(n) OVER (ORDER BY y), 0), 1) AS growth_pct FROM yearly""",
        YEARLY,
    ),
)
def _(t):
    by_year = Window.orderBy("y")  # one row per year
    before = F.lag("n").over(by_year)
    return yearly(t).select(
        "y", "n", "n_companies",
        F.sum("n").over(by_year).alias("cumulative"),
        (F.col("n") - before).alias("growth"),
        percent(F.col("n") - before, before, 1).alias("growth_pct"),
    )


@catalog.query(
    "w7_top_one_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey DESC) = 1""",
)
def _(t):
    latest = last_by_key(t.orders, ["o_custkey"], ["o_orderdate", "o_totalprice", "o_orderkey"])
    return latest.select("o_custkey", "o_orderkey", "o_totalprice")


@catalog.query(
    "w8_rank_in_source_cut",
    with_views(
        """
SELECT source, company_name, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY coalesce(weight_pct, quality_score) DESC, company_name) AS rn
  FROM targets) WHERE rn <= 20""",
        TARGETS,
    ),
)
def _(t):
    scored = t.targets.withColumn("score", F.coalesce("weight_pct", "quality_score"))
    return w.top_per_group(scored, ["source"], ["-score", "company_name"], 20).select("source", "company_name", "rn")


@catalog.query(
    "w9_numbers_after_maximum",
    with_views(
        """
SELECT (SELECT coalesce(max(event_id), 0) FROM base) + row_number() OVER (ORDER BY ts, event_id) AS row_id, event_id
FROM incr""",
        EVENTS_SPLIT,
    ),
)
def _(t):
    existing = t.base_events.select(F.col("event_id").alias("row_id"))
    new = t.increment_events.select("ts", "event_id")
    return append_numbers(existing, new, "row_id", ["ts", "event_id"]).select("row_id", "event_id")


@catalog.query(
    "w10_group_total_share_and_best",
    """SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id), 4) AS total,
  round(value / sum(value) OVER (PARTITION BY user_id) * 100, 1) AS pct_of_user,
  value = max(value) OVER (PARTITION BY user_id) AS is_best FROM events""",
)
def _(t):
    totals = {"user_total": F.sum("value"), "user_max": F.max("value")}
    return w.with_group_aggregates(t.events, ["user_id"], totals).select(
        "event_id", "user_id",
        round_half_away(F.col("user_total"), 4).alias("total"),
        round_half_away(F.col("value") / F.col("user_total") * 100, 1).alias("pct_of_user"),
        (F.col("value") == F.col("user_max")).alias("is_best"),
    )


AVERAGE_RANK = """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity, l_suppkey, rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity)
  + (count(*) OVER (PARTITION BY l_suppkey, l_quantity) - 1) / 2.0::DOUBLE AS avg_rank FROM lineitem"""


@catalog.query("w11_average_tie_rank", AVERAGE_RANK)
def _(t):
    line = F.col("l_linenumber").cast("bigint").alias("l_linenumber")
    rows = t.lineitem.select("l_orderkey", line, "l_quantity", "l_suppkey")
    return w.average_rank(rows, ["l_suppkey"], "l_quantity", "avg_rank")


CUMULATIVE = """SELECT event_id, user_id, CAST(row_number() OVER u AS BIGINT) AS row_num,
  (sum(value) OVER u)::DOUBLE AS running_sum, round((sum(value) OVER u)::DOUBLE / row_number() OVER u, 4) AS running_mean,
  (lag(value) OVER u)::DOUBLE AS previous, (value - lag(value) OVER u)::DOUBLE AS delta
FROM (SELECT event_id, user_id, ts, CAST(value AS DECIMAL(18,2)) AS value FROM events) WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"""


def cumulative(t, hot_rows):
    exact = t.events.withColumn("value", F.col("value").cast("decimal(18,2)"))
    out = w.running(exact, ["user_id"], ["ts", "event_id"], "value", hot_rows=hot_rows)
    return out.select(
        "event_id", "user_id", "row_num",
        F.col("running_sum").cast("double").alias("running_sum"),
        ratio(F.col("running_sum"), F.col("row_num"), 4).alias("running_mean"),
        F.col("previous").cast("double").alias("previous"),
        (F.col("value") - F.col("previous")).cast("double").alias("delta"),
    )


@catalog.query("w12_cumulative_statistics", CUMULATIVE)
def _(t):
    return cumulative(t, hot_rows=1_000_000)


@catalog.query("w12_cumulative_by_ranges", CUMULATIVE)
def _(t):
    """The same values when every group counts as hot."""
    return cumulative(t, hot_rows=0)


DOUBLES = """SELECT event_id, CAST(row_number() OVER u AS BIGINT) AS row_num, (sum(CAST(value AS DECIMAL(38,10))) OVER u)::DOUBLE AS running_sum,
  lag(value) OVER u AS previous FROM events WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"""


@catalog.query("w12_cumulative_doubles", DOUBLES)
def _(t):
    return w.running(t.events, ["user_id"], ["ts", "event_id"], "value").select("event_id", "row_num", "running_sum", "previous")


@catalog.query("w12_cumulative_doubles_by_ranges", DOUBLES)
def _(t):
    return w.running(t.events, ["user_id"], ["ts", "event_id"], "value", hot_rows=0).select("event_id", "row_num", "running_sum", "previous")


@catalog.query(
    "w13_position_in_document",
    on_sentences("""SELECT sentenceID, sentence, d - 1 AS pos_in_doc, row_number() OVER (PARTITION BY docID, section ORDER BY d) - 1 AS pos_in_sect,
  count(*) OVER (PARTITION BY docID) AS doc_total, count(*) OVER (PARTITION BY docID, section) AS sect_total
FROM (SELECT *, row_number() OVER (PARTITION BY docID ORDER BY sentenceID, sentence) AS d FROM sentences)"""),
)
def _(t):
    rows = t.sentences.select("docID", "section", "sentenceID", "sentence")
    in_doc = w.running(rows, ["docID"], ["sentenceID", "sentence"], position="d")
    in_sect = w.running(in_doc, ["docID", "section"], ["d"], position="s")
    sized = w.with_group_aggregates(in_sect, ["docID", "section"], {"sect_total": F.count(F.lit(1))})
    sized = w.with_group_aggregates(sized, ["docID"], {"doc_total": F.count(F.lit(1))})
    return sized.select(
        "sentenceID", "sentence", (F.col("d") - 1).alias("pos_in_doc"), (F.col("s") - 1).alias("pos_in_sect"),
        "doc_total", "sect_total",
    )
