"""Registered queries: joins, sorting, limits and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from filigree.catalog.registry import Catalog
from filigree.functions.numbers import round_half_away
from filigree.functions.ordering import order_by, top_k
from filigree.operators import joins as j
from filigree.operators.aggregates import repeated_keys
from filigree.sources.fixture_sql import EVENTS_SPLIT, SENTENCES, TARGETS, on_sentences, with_views

catalog = Catalog()


@catalog.query(
    "j1_inner_orders_customers",
    """SELECT c_mktsegment, count(*) AS n_orders, round(sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE, 2) AS total_price
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
)
def _(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_orders"),
        round_half_away(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double"), 2).alias("total_price"),
    )


@catalog.query(
    "j2_left_dimension_lookup",
    """SELECT c_custkey, c_name, n_name, r_name
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 20 LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def _(t):
    # nation and region are fixed tables of 25 and 5 rows
    nation = t.nation.filter(F.col("n_nationkey") < 20).join(
        F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    return t.customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "c_custkey", "c_name", "n_name", "r_name"
    )


@catalog.query(
    "j3_left_normalised_key",
    with_views(
        """
SELECT t.cik, t.company_name, c.c_custkey AS matched_key
FROM targets t LEFT JOIN customer c ON upper(trim(t.company_name)) = upper(trim('  ' || lower(c.c_name) || ' '))
  AND c.c_mktsegment <> 'FURNITURE'""",
        TARGETS,
    ),
)
def _(t):
    spelled = t.customer.filter(F.col("c_mktsegment") != "FURNITURE").select(
        F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")).alias("spelling"), F.col("c_custkey").alias("matched_key")
    )
    joined = j.left_on_normalised(
        t.targets, spelled, F.upper(F.trim("company_name")), F.upper(F.trim("spelling"))
    )
    return joined.select("cik", "company_name", "matched_key")


@catalog.query(
    "j4_left_with_range_keep_zero",
    """SELECT c_custkey, c_name, count(o_orderkey) AS n_orders
FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND year(o_orderdate) BETWEEN 1999 AND 1999
  AND o_orderstatus IS NOT NULL
GROUP BY c_custkey, c_name HAVING count(o_orderkey) = 0""",
)
def _(t):
    in_window = (
        (F.col("c_custkey") == F.col("o_custkey"))
        & F.year("o_orderdate").between(1999, 1999)
        & F.col("o_orderstatus").isNotNull()
    )
    joined = t.customer.join(t.orders, in_window, "left")
    return joined.groupBy("c_custkey", "c_name").agg(F.count("o_orderkey").alias("n_orders")).filter(
        F.col("n_orders") == 0
    )


@catalog.query(
    "j5_semi_join",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)",
)
def _(t):
    rich = t.customer.filter(F.col("c_acctbal") > 9000).select(F.col("c_custkey").alias("o_custkey"))
    return j.semi(t.orders, rich, "o_custkey").select("o_orderkey", "o_custkey")


@catalog.query(
    "j6_anti_join_is_null",
    """SELECT c.c_custkey, c.c_mktsegment FROM customer c
LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P') o ON c.c_custkey = o.o_custkey
WHERE o.o_custkey IS NULL""",
)
def _(t):
    pending = t.orders.filter(F.col("o_orderstatus") == "P")
    return t.customer.join(pending, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select(
        "c_custkey", "c_mktsegment"
    )


@catalog.query(
    "j7_anti_join_not_exists",
    """SELECT p_partkey FROM part WHERE NOT EXISTS (
  SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity > 45)""",
)
def _(t):
    returned = t.lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45))
    return t.part.join(returned, F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey")


@catalog.query(
    "j8_null_aware_not_in",
    with_views(
        """
SELECT 'clean' AS list, cik, company_name FROM targets
WHERE ticker NOT IN (SELECT 't' || l_suppkey FROM lineitem)
UNION ALL
SELECT 'with null', cik, company_name FROM targets WHERE ticker NOT IN (SELECT ticker FROM targets WHERE source = 'sp500')""",
        TARGETS,
    ),
)
def _(t):
    used = t.lineitem.select(F.concat(F.lit("t"), F.col("l_suppkey")).alias("ticker")).distinct()
    held = t.targets.filter(F.col("source") == "sp500").select("ticker")
    clean = j.not_in(t.targets, used, "ticker").select(F.lit("clean").alias("list"), "cik", "company_name")
    with_null = j.not_in(t.targets, held, "ticker").select(F.lit("with null").alias("list"), "cik", "company_name")
    return clean.unionByName(with_null)


@catalog.query(
    "j9_full_outer_key_diff",
    """SELECT coalesce(a.k, b.k) AS custkey, coalesce(a.n, 0) AS n_1996, coalesce(b.n, 0) AS n_1997,
  CASE WHEN a.k IS NULL THEN 'right_only' WHEN b.k IS NULL THEN 'left_only' ELSE 'both' END AS presence
FROM (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE year(o_orderdate) = 1996 GROUP BY 1) a
FULL OUTER JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1) b ON a.k = b.k""",
)
def _(t):
    def per_customer(year, name):
        return t.orders.filter(F.year("o_orderdate") == year).groupBy(F.col("o_custkey").alias("custkey")).agg(
            F.count(F.lit(1)).alias(name)
        )

    both = per_customer(1996, "a").join(per_customer(1997, "b"), "custkey", "full_outer")
    presence = F.when(F.col("a").isNull(), "right_only").when(F.col("b").isNull(), "left_only").otherwise("both")
    return both.select(
        "custkey",
        F.coalesce("a", F.lit(0)).alias("n_1996"),
        F.coalesce("b", F.lit(0)).alias("n_1997"),
        presence.alias("presence"),
    )


@catalog.query(
    "j10_cross_join_one_row",
    """SELECT o_orderpriority, count(*) AS n_orders, round(count(*) * 100.0 / p.total, 2) AS pct, p.total
FROM orders CROSS JOIN (SELECT count(*) AS total FROM orders) p GROUP BY o_orderpriority, p.total""",
)
def _(t):
    from filigree.functions.numbers import percent

    counts = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"))
    total = t.orders.agg(F.count(F.lit(1)).alias("total"))  # one row
    return counts.crossJoin(F.broadcast(total)).withColumn("pct", percent(F.col("n_orders"), F.col("total")))


SUSPECTS_SQL = """suspects AS (
  SELECT s_suppkey AS sid, s_suppkey * 3 AS cik, '#' || lpad(CAST(s_suppkey * 5 AS VARCHAR), 9, '0') AS name_pattern,
         'T' || (s_suppkey * 2) AS ticker FROM supplier),
dim AS (SELECT DISTINCT cik_int, name, tickers FROM sentences)"""


def suspects(t):
    key = F.col("s_suppkey")
    return t.supplier.select(
        key.alias("sid"),
        (key * 3).alias("suspect_cik"),
        F.concat(F.lit("#"), F.lpad((key * 5).cast("string"), 9, "0")).alias("name_pattern"),
        F.concat(F.lit("T"), key * 2).alias("ticker"),
    )


@catalog.query(
    "j11_theta_or_match",
    with_views(
        f""",
{SUSPECTS_SQL}
SELECT DISTINCT sid, cik_int FROM suspects JOIN dim
  ON cik = cik_int OR contains(upper(name), name_pattern) OR list_contains(tickers, ticker)""",
        SENTENCES,
    ),
)
def _(t):
    dim = t.sentences.select("cik_int", "name", "tickers").distinct()
    return j.any_of_join(
        suspects(t), dim, "sid", "cik_int", ("suspect_cik", "cik_int"), ("name_pattern", "name"), ("ticker", "tickers")
    )


@catalog.query(
    "j12_list_contains_join",
    with_views(
        f""",
{SUSPECTS_SQL}
SELECT sid, cik_int, name FROM suspects JOIN dim ON list_contains(tickers, ticker)""",
        SENTENCES,
    ),
)
def _(t):
    dim = t.sentences.select("cik_int", "name", "tickers").distinct()
    return j.list_contains_join(suspects(t), dim, "ticker", "tickers").select("sid", "cik_int", "name")


@catalog.query(
    "j13_lateral_unnest",
    on_sentences("""SELECT ticker, count(*) AS n_sentences FROM (SELECT unnest(tickers) AS ticker FROM sentences) GROUP BY ticker"""),
)
def _(t):
    return t.sentences.select(F.explode("tickers").alias("ticker")).groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_sentences")
    )


@catalog.query(
    "j14_scalar_subqueries",
    """SELECT o_custkey, count(*) AS n_orders, (SELECT max(o_orderkey) FROM orders) AS max_key,
  (SELECT c_name FROM customer WHERE c_custkey = o_custkey) AS name,
  count(*) - (SELECT count(*) FROM orders i WHERE i.o_custkey = o.o_custkey AND i.o_orderstatus = 'F') AS n_open
FROM orders o GROUP BY o_custkey""",
)
def _(t):
    per = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.count_if(F.col("o_orderstatus") != "F").alias("n_open")
    )
    highest = t.orders.agg(F.max("o_orderkey").alias("max_key"))  # one row
    names = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"))
    return per.join(names, "o_custkey", "left").crossJoin(F.broadcast(highest))


@catalog.query(
    "j15_in_grouped_subquery",
    on_sentences("""SELECT sentenceID, max(sentence) AS last_text, min(sentence) AS first_text FROM sentences
WHERE sentenceID IN (SELECT sentenceID FROM sentences GROUP BY sentenceID HAVING count(*) > 1) GROUP BY sentenceID"""),
)
def _(t):
    repeated = repeated_keys(t.sentences, "sentenceID")
    return j.semi(t.sentences, repeated, "sentenceID").groupBy("sentenceID").agg(
        F.max("sentence").alias("last_text"), F.min("sentence").alias("first_text")
    )


@catalog.query(
    "j16_join_key_diagnosis",
    with_views(
        """,
ids AS (SELECT DISTINCT cik FROM sentences)
SELECT source, count(DISTINCT t.cik) AS n_companies,
  count(DISTINCT CASE WHEN s.cik IS NOT NULL THEN t.cik END) AS matched_as_text,
  count(DISTINCT CASE WHEN i.cik IS NOT NULL THEN t.cik END) AS matched_as_number
FROM targets t LEFT JOIN ids s ON t.cik = s.cik
LEFT JOIN ids i ON CAST(t.cik AS BIGINT) = CAST(i.cik AS BIGINT) GROUP BY source""",
        SENTENCES,
        TARGETS,
    ),
)
def _(t):
    ids = t.sentences.select("cik").distinct()
    as_text = ids.select("cik", F.lit(True).alias("by_text"))
    as_number = ids.select(F.col("cik").cast("bigint").alias("n"), F.lit(True).alias("by_number"))
    marked = t.targets.join(as_text, "cik", "left").join(as_number, F.col("cik").cast("bigint") == F.col("n"), "left")
    return marked.groupBy("source").agg(
        F.countDistinct("cik").alias("n_companies"),
        F.countDistinct(F.when(F.col("by_text"), F.col("cik"))).alias("matched_as_text"),
        F.countDistinct(F.when(F.col("by_number"), F.col("cik"))).alias("matched_as_number"),
    )


RANKED_TARGETS = with_views(
    """
SELECT row_number() OVER (ORDER BY CASE source WHEN 'sp500' THEN 1 ELSE 2 END, weight_pct DESC NULLS LAST,
                          ticker ASC NULLS LAST, company_name) AS position, company_name FROM targets""",
    TARGETS,
)


@catalog.query("so1_multi_key_sort_nulls_last", RANKED_TARGETS)
def _(t):
    from filigree.operators.numbering import global_row_number

    keyed = t.targets.withColumn("source_rank", F.when(F.col("source") == "sp500", 1).otherwise(2))
    order = ["source_rank", "-weight_pct", "ticker", "company_name"]
    return global_row_number(keyed, order, "position").select("position", "company_name")


@catalog.query("so2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def _(t):
    return top_k(t.orders.select("o_orderkey", "o_totalprice"), 100, "-o_totalprice", "o_orderkey")


@catalog.query(
    "so3_union_of_top_k",
    with_views(
        """
(SELECT company_name, source, coalesce(weight_pct, quality_score / 1000) AS score_proxy FROM targets
 WHERE source = 'sp500' ORDER BY weight_pct DESC NULLS LAST, company_name LIMIT 10)
UNION ALL
(SELECT company_name, source, coalesce(weight_pct, quality_score / 1000) FROM targets
 WHERE source = 'notable' ORDER BY quality_score DESC NULLS LAST, company_name LIMIT 10)""",
        TARGETS,
    ),
)
def _(t):
    proxy = F.coalesce(F.col("weight_pct"), F.col("quality_score") / 1000).alias("score_proxy")
    first = top_k(t.targets.filter(F.col("source") == "sp500"), 10, "-weight_pct", "company_name")
    second = top_k(t.targets.filter(F.col("source") == "notable"), 10, "-quality_score", "company_name")
    return first.unionByName(second).select("company_name", "source", proxy)


@catalog.query(
    "u1_u4_union_all",
    with_views(
        "\nSELECT event_id, value, 'base' AS part FROM base UNION ALL SELECT event_id, value, 'increment' FROM incr",
        EVENTS_SPLIT,
    ),
)
def _(t):
    def part(df, label):
        return df.select("event_id", "value", F.lit(label).alias("part"))

    return part(t.base_events, "base").unionByName(part(t.increment_events, "increment"))


@catalog.query(
    "u2_union_distinct",
    "SELECT c_nationkey::BIGINT AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier UNION SELECT n_nationkey FROM nation",
)
def _(t):
    parts = [t.customer.select(F.col("c_nationkey").cast("bigint").alias("nationkey")),
             t.supplier.select(F.col("s_nationkey").cast("bigint").alias("nationkey")),
             t.nation.select(F.col("n_nationkey").cast("bigint").alias("nationkey"))]
    return parts[0].union(parts[1]).union(parts[2]).distinct()


@catalog.query(
    "u3_union_order_limit",
    """SELECT * FROM (SELECT o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
  UNION SELECT o_custkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT')
ORDER BY o_totalprice DESC, o_custkey LIMIT 200""",
)
def _(t):
    done = t.orders.filter(F.col("o_orderstatus") == "F").select("o_custkey", "o_totalprice")
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select("o_custkey", "o_totalprice")
    return order_by(done.union(urgent).distinct(), "-o_totalprice", "o_custkey").limit(200)


@catalog.query(
    "u5_key_set_overlap",
    with_views(
        """
SELECT (SELECT count(DISTINCT user_id) FROM base WHERE event_type = 'error') AS n_left,
  (SELECT count(DISTINCT user_id) FROM incr WHERE event_type = 'purchase') AS n_right,
  (SELECT count(*) FROM (SELECT user_id FROM base WHERE event_type = 'error' INTERSECT
                         SELECT user_id FROM incr WHERE event_type = 'purchase')) AS n_both,
  (SELECT count(*) FROM (SELECT user_id FROM base WHERE event_type = 'error' UNION
                         SELECT user_id FROM incr WHERE event_type = 'purchase')) AS n_union""",
        EVENTS_SPLIT,
    ),
)
def _(t):
    left = t.base_events.filter(F.col("event_type") == "error").select("user_id", F.lit(1).alias("l"), F.lit(0).alias("r"))
    right = t.increment_events.filter(F.col("event_type") == "purchase").select(
        "user_id", F.lit(0).alias("l"), F.lit(1).alias("r")
    )
    # One pass over both key sets instead of an intersect and a union.
    sides = left.unionByName(right).groupBy("user_id").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return sides.agg(
        F.sum("l").cast("bigint").alias("n_left"),
        F.sum("r").cast("bigint").alias("n_right"),
        F.sum(F.col("l") * F.col("r")).cast("bigint").alias("n_both"),
        F.count(F.lit(1)).alias("n_union"),
    )
