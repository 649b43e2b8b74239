"""Registered queries: aggregates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from filigree.catalog.registry import Catalog
from filigree.functions.arrays import joined_values
from filigree.functions.numbers import percent, ratio, round_half_away
from filigree.operators import aggregates as a
from filigree.operators.windows import exact_quantiles
from filigree.sources.fixture_sql import SENTENCES, TARGETS, on_sentences, with_views

catalog = Catalog()

YEAR_COUNTS = "SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1"


@catalog.query(
    "a1_group_statistics",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS sum_qty, round(avg(l_quantity), 6) AS avg_qty,
  min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price, round(stddev(l_quantity), 6) AS std_qty
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def _(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_quantity").alias("sum_qty"),
        round_half_away(F.avg("l_quantity"), 6).alias("avg_qty"),
        F.min("l_extendedprice").alias("min_price"),
        F.max("l_extendedprice").alias("max_price"),
        round_half_away(F.stddev("l_quantity"), 6).alias("std_qty"),
    )


@catalog.query(
    "a2_distinct_counts",
    on_sentences("""SELECT section, count(*) AS n_rows, count(DISTINCT cik) AS n_cik, count(DISTINCT docID) AS n_docID,
  count(DISTINCT report_year) AS n_report_year FROM sentences GROUP BY section"""),
)
def _(t):
    return a.count_distinct_grain(t.sentences, ["section"], ["cik", "docID", "report_year"], place=["cik"])


@catalog.query(
    "a2_composite_distinct",
    on_sentences("""SELECT count(DISTINCT cik || '-' || section) AS company_sections, count(DISTINCT cik || '-' || report_year) AS filings
FROM sentences"""),
)
def _(t):
    return t.sentences.agg(
        F.countDistinct("cik", "section").alias("company_sections"),
        F.countDistinct("cik", "report_year").alias("filings"),
    )


@catalog.query(
    "a3_conditional_aggregates",
    on_sentences("""SELECT name, count(CASE WHEN section IN (1, 8, 10) THEN 1 END) AS n_priority,
  CAST(sum(CASE WHEN report_year >= 1999 THEN 1 ELSE 0 END) AS BIGINT) AS n_recent,
  count(DISTINCT CASE WHEN report_year >= 1999 THEN docID END) AS recent_filings FROM sentences GROUP BY name"""),
)
def _(t):
    recent = F.col("report_year") >= 1999
    return t.sentences.groupBy("name").agg(
        F.count(F.when(F.col("section").isin(1, 8, 10), 1)).alias("n_priority"),
        F.sum(F.when(recent, 1).otherwise(0)).alias("n_recent"),
        F.countDistinct(F.when(recent, F.col("docID"))).alias("recent_filings"),
    )


@catalog.query(
    "a4_percentiles",
    """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 6) AS p25, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
  round(quantile_cont(l_extendedprice, 0.95), 6) AS p95,
  round(round(quantile_cont(l_extendedprice, 0.95), 6) / round(quantile_cont(l_extendedprice, 0.5), 6), 2) AS p95_to_median
FROM lineitem GROUP BY l_returnflag""",
)
def _(t):
    points = {"p25": 0.25, "p50": 0.5, "p95": 0.95}
    stats = exact_quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", points)
    return stats.withColumn("p95_to_median", ratio(F.col("p95"), F.col("p50")))


@catalog.query(
    "a4_percentiles_of_counts",
    """SELECT o_orderstatus, round(quantile_cont(n, 0.25), 6) AS p25, round(quantile_cont(n, 0.9), 6) AS p90
FROM (SELECT o_orderstatus, o_custkey, count(*) AS n FROM orders GROUP BY ALL) GROUP BY o_orderstatus""",
)
def _(t):
    counts = t.orders.groupBy("o_orderstatus", "o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("o_orderstatus").agg(*a.quantiles("n", {"p25": 0.25, "p90": 0.9}))


@catalog.query(
    "a5_value_at_maximum",
    """SELECT o_custkey, arg_max(o_orderpriority, (o_totalprice, o_orderpriority)) AS priority_of_largest, max(o_totalprice) AS largest
FROM orders GROUP BY o_custkey""",
)
def _(t):
    return t.orders.groupBy("o_custkey").agg(
        a.value_at_max("o_orderpriority", "o_totalprice").alias("priority_of_largest"),
        F.max("o_totalprice").alias("largest"),
    )


@catalog.query(
    "a6_collect_distinct_sorted",
    on_sentences("""SELECT name, array_to_string(list_sort(list(DISTINCT report_year)), ',') AS years,
  array_to_string(list_sort(list(DISTINCT section)), ',') AS sections FROM sentences GROUP BY name"""),
)
def _(t):
    return t.sentences.groupBy("name").agg(
        F.array_join(F.array_sort(F.collect_set("report_year")), ",").alias("years"),
        F.array_join(F.array_sort(F.collect_set("section")), ",").alias("sections"),
    )


@catalog.query(
    "a7_string_aggregation",
    """SELECT o_orderpriority, string_agg(DISTINCT CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, ', '
  ORDER BY CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END) AS statuses,
  string_agg(DISTINCT CAST(year(o_orderdate) AS VARCHAR), ', ' ORDER BY CAST(year(o_orderdate) AS VARCHAR)) AS years
FROM orders GROUP BY o_orderpriority""",
)
def _(t):
    return t.orders.groupBy("o_orderpriority").agg(
        joined_values(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")), ", ").alias("statuses"),
        joined_values(F.year("o_orderdate").cast("string"), ", ").alias("years"),
    )


@catalog.query(
    "a8_having_on_aliases",
    on_sentences("""SELECT cik, count(DISTINCT report_year) AS filing_years, count(DISTINCT section) AS section_coverage, count(*) AS total_sentences
FROM sentences GROUP BY cik HAVING count(DISTINCT report_year) >= 6 AND count(DISTINCT section) >= 12 AND count(*) >= 30"""),
)
def _(t):
    per_company = a.count_distinct_grain(t.sentences, ["cik"], ["report_year", "section"], "total_sentences", place=["cik"])
    return per_company.select(
        "cik", F.col("n_report_year").alias("filing_years"), F.col("n_section").alias("section_coverage"), "total_sentences"
    ).filter("filing_years >= 6 AND section_coverage >= 12 AND total_sentences >= 30")


@catalog.query(
    "a9_grouping_sets_total",
    with_views(
        """
SELECT coalesce(source, 'TOTAL') AS source, count(*) AS n_companies, count(DISTINCT cik) AS unique_ciks,
  round(avg(coalesce(weight_pct, 0)), 4) AS avg_weight FROM targets GROUP BY GROUPING SETS (source, ())""",
        TARGETS,
    ),
)
def _(t):
    return t.targets.groupingSets([["source"], []], "source").agg(
        F.count(F.lit(1)).alias("n_companies"),
        F.countDistinct("cik").alias("unique_ciks"),
        round_half_away(F.avg(F.coalesce(F.col("weight_pct"), F.lit(0.0))), 4).alias("avg_weight"),
    ).withColumn("source", F.coalesce("source", F.lit("TOTAL")))


@catalog.query(
    "a10_pivot_zero_fill",
    """SELECT c_mktsegment, """
    + ", ".join(f"""count(CASE WHEN year(o_orderdate) = {y} THEN 1 END) AS "{y}" """ for y in range(1995, 2002))
    + "FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment",
)
def _(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    by_segment = joined.withColumn("y", F.year("o_orderdate")).groupBy("c_mktsegment")
    return by_segment.pivot("y", list(range(1995, 2002))).count().fillna(0)


@catalog.query(
    "a12_aggregate_of_aggregates",
    on_sentences("""SELECT min(n) AS min_sentences, max(n) AS max_sentences, round(avg(n), 4) AS mean_sentences,
  round(quantile_cont(n, 0.5), 6) AS median, round(quantile_cont(n, 0.9), 6) AS p90, count(*) AS n_filings
FROM (SELECT docID, count(*) AS n FROM sentences GROUP BY docID)"""),
)
def _(t):
    sizes = t.sentences.groupBy("docID").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.min("n").alias("min_sentences"),
        F.max("n").alias("max_sentences"),
        round_half_away(F.avg("n"), 4).alias("mean_sentences"),
        *a.quantiles("n", {"median": 0.5, "p90": 0.9}),
        F.count(F.lit(1)).alias("n_filings"),
    )


@catalog.query(
    "a13_top_values",
    'SELECT source, count(*) AS "count" FROM documents GROUP BY source ORDER BY 2 DESC, 1 LIMIT 5',
)
def _(t):
    return a.top_values(t.documents, "source", 5)


@catalog.query(
    "a14_missingness",
    on_sentences("""SELECT * FROM (SELECT unnest(['cik', 'tickers', 'sentence']) AS "column",
  unnest([round(avg(CASE WHEN cik IS NULL THEN 1.0 ELSE 0 END), 6), round(avg(CASE WHEN tickers IS NULL THEN 1.0 ELSE 0 END), 6),
          round(avg(CASE WHEN sentence IS NULL THEN 1.0 ELSE 0 END), 6)]) AS missing FROM sentences)"""),
)
def _(t):
    return a.missingness(t.sentences.select("cik", "tickers", "sentence"))


def profile_sql(table: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT CAST({i} AS BIGINT) AS position, '{c}' AS "column", '{kind}' AS "type", count(*) - count({c}) AS nulls,
  round((count(*) - count({c})) * 100.0 / count(*), 2) AS null_pct, count(DISTINCT {c}) AS uniques, min(CAST({c} AS VARCHAR)) AS sample FROM {table}"""
        for i, (c, kind) in enumerate(columns.items(), 1)
    )


@catalog.query(
    "a15_src2_column_profile",
    profile_sql(
        "orders",
        {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_orderpriority": "string"},
    ),
)
def _(t):
    return a.profile_columns(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))


@catalog.query(
    "a16_first_per_group",
    "SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS first_status, min(o_orderkey) AS first_order FROM orders GROUP BY o_custkey",
)
def _(t):
    return t.orders.groupBy("o_custkey").agg(
        F.min_by("o_orderstatus", "o_orderkey").alias("first_status"), F.min("o_orderkey").alias("first_order")
    )


@catalog.query(
    "a17_representative_by_min",
    "SELECT n_regionkey::BIGINT AS regionkey, min(c_name) AS company_name, min(c_mktsegment) AS segment FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1",
)
def _(t):
    joined = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 rows
    return joined.groupBy(F.col("n_regionkey").cast("bigint").alias("regionkey")).agg(
        F.min("c_name").alias("company_name"), F.min("c_mktsegment").alias("segment")
    )


@catalog.query(
    "a18_grain_check",
    on_sentences("""SELECT 'total_rows' AS metric, count(*) AS "count" FROM sentences
UNION ALL SELECT 'unique_sentenceID', count(DISTINCT sentenceID) FROM sentences
UNION ALL SELECT 'unique_docID', count(DISTINCT docID) FROM sentences"""),
)
def _(t):
    return a.grain_check(t.sentences, ["sentenceID", "docID"])


@catalog.query(
    "a14_null_counts",
    with_views(
        "\nSELECT count(*) AS total_rows, count(*) - count(cik) AS null_cik, count(*) - count(ticker) AS null_ticker, "
        "count(*) - count(weight_pct) AS null_weight_pct FROM targets",
        TARGETS,
    ),
)
def _(t):
    return a.null_counts(t.targets, ["cik", "ticker", "weight_pct"])


@catalog.query(
    "a6_duplicate_key_lists",
    with_views(
        """
SELECT sentenceID, count(*) AS occurrences, array_to_string(list_sort(list(DISTINCT sic)), ',') AS segments
FROM sentences GROUP BY sentenceID HAVING count(*) > 1""",
        SENTENCES,
    ),
)
def _(t):
    return t.sentences.groupBy("sentenceID").agg(
        F.count(F.lit(1)).alias("occurrences"), joined_values(F.col("sic")).alias("segments")
    ).filter(F.col("occurrences") > 1)


@catalog.query(
    "a1_share_by_year",
    f"SELECT y, n, round(n * 100.0 / sum(n) OVER (), 2) AS pct FROM ({YEAR_COUNTS})",
)
def _(t):
    years = t.orders.groupBy(F.year("o_orderdate").cast("bigint").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    return years.withColumn("pct", percent(F.col("n"), F.sum("n").over(Window.partitionBy())))
