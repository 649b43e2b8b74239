"""Registered queries: company dimension, scoring, selection and entity resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from filigree.catalog.registry import Catalog
from filigree.functions.numbers import round_half_away
from filigree.operators import joins as j
from filigree.plans import companies as c
from filigree.session import cut_lineage
from filigree.sources.fixture_sql import SENTENCES, TARGETS, with_views
from filigree.catalog.relational import suspects

catalog = Catalog()

DIM = """dim AS (
  SELECT cik_int, arg_max(name, (reportDate, name)) AS company_name, min(reportDate) AS earliest_filing_date,
    max(reportDate) AS latest_filing_date, count(DISTINCT docID) AS n_filings, count(DISTINCT report_year) AS n_years_covered,
    count(DISTINCT section) AS n_sections_covered, count(DISTINCT sentenceID) AS n_sentences,
    round(avg(length(sentence)), 1) AS avg_char_length, lpad(CAST(cik_int AS VARCHAR), 10, '0') AS cik10,
    min(report_year) AS earliest_year, max(report_year) AS latest_year,
    upper(trim(regexp_replace(arg_max(name, (reportDate, name)), ' INC\\.?$| CORP\\.?$', '', 'g'))) AS name_normalized,
    list_sort(list_distinct(flatten(list(tickers) FILTER (tickers IS NOT NULL)))) AS all_tickers
  FROM sentences GROUP BY cik_int)"""
DIM_COLUMNS = (
    "cik_int", "company_name", "earliest_filing_date", "latest_filing_date", "n_filings", "n_years_covered",
    "n_sections_covered", "n_sentences", "avg_char_length", "cik10", "earliest_year", "latest_year", "name_normalized",
)


@catalog.query(
    "p19_company_dimension",
    with_views(
        f"\nSELECT {', '.join(DIM_COLUMNS)}, coalesce(array_to_string(all_tickers, ','), '') AS tickers FROM dim", SENTENCES, DIM
    ),
)
def _(t):
    dim = c.company_dim(t.sentences)
    return dim.select(*DIM_COLUMNS, F.array_join("all_tickers", ",").alias("tickers"))


SCORED = """scored AS (
  SELECT *, filing_years * 5 + section_coverage * 10 + recent_sentences / 100 + priority_section_sentences / 50 AS quality_score,
    CASE WHEN upper(name) LIKE '%BANCORP%' OR upper(name) LIKE '%BANK%' OR upper(name) LIKE '%FINANCIAL CORP%'
         THEN 'regional_bank' ELSE 'normal' END AS company_type
  FROM (SELECT cik, name, count(DISTINCT report_year) AS filing_years, count(DISTINCT section) AS section_coverage,
          count(*) AS total_sentences, CAST(sum(CASE WHEN report_year >= 2000 THEN 1 ELSE 0 END) AS BIGINT) AS recent_sentences,
          CAST(sum(CASE WHEN section IN (1, 8, 10) THEN 1 ELSE 0 END) AS BIGINT) AS priority_section_sentences,
          max(report_year) AS latest_filing_year FROM sentences GROUP BY cik, name)
  WHERE filing_years >= 4 AND section_coverage >= 10 AND total_sentences >= 20 AND latest_filing_year >= 2000
    AND priority_section_sentences >= 3)"""


def scored(t):
    return c.score_companies(t.sentences, 4, 10, 20, 2000, 3)


@catalog.query(
    "p14_company_scores",
    with_views("\nSELECT * REPLACE (round(quality_score, 6) AS quality_score) FROM scored", SENTENCES, SCORED),
)
def _(t):
    return scored(t).withColumn("quality_score", round_half_away(F.col("quality_score"), 6))


NOTABLE = """held AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik FROM customer WHERE c_acctbal >= 9000),
excl AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik FROM customer WHERE c_nationkey = 3),
gems AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik FROM customer WHERE c_nationkey IN (3, 5)),
pool AS (SELECT * FROM scored WHERE cik NOT IN (SELECT cik FROM held) AND cik NOT IN (SELECT cik FROM excl)),
best AS (SELECT * FROM pool ORDER BY quality_score DESC, cik LIMIT 30),
chosen AS (SELECT *, 'automatic' AS selection_method FROM best UNION ALL
  SELECT *, 'listed' FROM pool WHERE cik IN (SELECT cik FROM gems) AND cik NOT IN (SELECT cik FROM best)),
notable AS (
  SELECT row_number() OVER (ORDER BY quality_score DESC, cik) AS company_rank, cik, name AS company_name, filing_years, section_coverage,
    total_sentences, recent_sentences, priority_section_sentences, latest_filing_year, round(quality_score, 2) AS quality_score, company_type,
    selection_method, round(priority_section_sentences * 1.0 / total_sentences, 3) AS priority_ratio,
    round(recent_sentences * 1.0 / total_sentences, 3) AS recency_ratio, round(total_sentences * 1.0 / filing_years, 1) AS avg_sentences_per_year
  FROM (SELECT * FROM chosen ORDER BY quality_score DESC, cik LIMIT 50))"""


def notable(t):
    # Keys arrive unpadded, as numbers; the selection pads them.
    def keys(condition):
        return t.customer.filter(condition).select(F.col("c_custkey").alias("cik"))

    return c.select_notable(
        scored(t), keys(F.col("c_nationkey").isin(3, 5)), keys(F.col("c_nationkey") == 3), keys(F.col("c_acctbal") >= 9000), 30, 50
    )


@catalog.query("p15_notable_selection", with_views("\nSELECT * FROM notable", SENTENCES, SCORED, NOTABLE))
def _(t):
    return notable(t)


UNIVERSE = """holdings AS (
  SELECT c_custkey % 500 AS cik, c_name AS company_name, 'T' || c_custkey AS ticker, c_mktsegment AS sector, c_acctbal / 2000 AS weight_pct
  FROM customer WHERE c_acctbal >= 9000),
universe AS (
  SELECT row_number() OVER (ORDER BY src, coalesce(weight_pct, quality_score / 1000) DESC, cik, ticker NULLS LAST, company_name) AS company_id,
    cik, company_name, ticker, sector, source, tier, round(coalesce(weight_pct, 0.0), 4) AS weight_pct, filing_years, total_sentences,
    round(coalesce(quality_score, 0.0), 2) AS quality_score, latest_filing_year, CAST(source = 'sp500' AS BIGINT) AS is_sp500,
    CAST(tier LIKE '%mega%' OR tier LIKE '%tier1%' AS BIGINT) AS is_premium
  FROM (SELECT 1 AS src, CAST(cik AS VARCHAR) AS cik, company_name, ticker, sector, weight_pct, 'sp500' AS source,
          CASE WHEN weight_pct >= 2 THEN 'sp500_mega' WHEN weight_pct >= 0.5 THEN 'sp500_large' WHEN weight_pct >= 0.2 THEN 'sp500_mid'
               ELSE 'sp500_small' END AS tier, NULL::BIGINT AS filing_years, NULL::BIGINT AS total_sentences, NULL::DOUBLE AS quality_score,
          NULL::BIGINT AS latest_filing_year FROM holdings
        UNION ALL SELECT 2, cik, company_name, NULL, NULL, NULL, 'notable', CASE WHEN quality_score >= 1200 THEN 'notable_tier1'
          WHEN quality_score >= 1000 THEN 'notable_tier2' WHEN quality_score >= 900 THEN 'notable_tier3' ELSE 'notable_tier4' END,
          filing_years, total_sentences, quality_score, latest_filing_year FROM notable))"""


def universe(t):
    held = t.customer.filter(F.col("c_acctbal") >= 9000).select(
        (F.col("c_custkey") % 500).alias("cik"), F.col("c_name").alias("company_name"),
        F.concat(F.lit("T"), "c_custkey").alias("ticker"), F.col("c_mktsegment").alias("sector"),
        (F.col("c_acctbal") / 2000).alias("weight_pct"),
    )
    return c.build_universe(held, notable(t))


@catalog.query("p16_universe", with_views("\nSELECT * FROM universe", SENTENCES, SCORED, NOTABLE, UNIVERSE))
def _(t):
    return universe(t)


@catalog.query(
    "p16_drop_share_classes",
    with_views(
        "\nSELECT cik, company_id, company_name FROM universe QUALIFY row_number() OVER (PARTITION BY cik ORDER BY weight_pct DESC, quality_score DESC, company_id) = 1",
        SENTENCES, SCORED, NOTABLE, UNIVERSE,
    ),
)
def _(t):
    return c.drop_share_classes(universe(t)).select("cik", "company_id", "company_name")


RESOLVED = """tier1 AS (
  SELECT t.cik AS target_cik, d.cik_int AS final_cik_int, t.company_name, t.ticker, t.source, t.tier, t.weight_pct, t.quality_score,
    'CIK_MATCH' AS match_method FROM targets t JOIN dim d ON CAST(t.cik AS BIGINT) = d.cik_int),
tier2 AS (
  SELECT t.cik AS target_cik, d.cik_int AS final_cik_int, t.company_name, t.ticker, t.source, t.tier, t.weight_pct, t.quality_score,
    'TICKER_MATCH' AS match_method
  FROM targets t JOIN dim d ON list_contains(d.all_tickers, upper(coalesce(t.ticker, '')))
  WHERE NOT EXISTS (SELECT 1 FROM tier1 x WHERE x.target_cik = t.cik) AND t.ticker IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY t.cik ORDER BY d.latest_filing_date DESC NULLS LAST, d.n_filings DESC, d.cik_int) = 1),
resolved AS (
  SELECT row_number() OVER (ORDER BY src, coalesce(weight_pct, quality_score / 1000) DESC, final_cik_int) AS company_id,
    lpad(CAST(final_cik_int AS VARCHAR), 10, '0') AS cik, final_cik_int AS cik_int, company_name, ticker, source, tier, weight_pct,
    quality_score, match_method
  FROM (SELECT *, CASE source WHEN 'sp500' THEN 1 ELSE 2 END AS src FROM (SELECT * FROM tier1 UNION ALL SELECT * FROM tier2)
        QUALIFY row_number() OVER (PARTITION BY final_cik_int ORDER BY CASE source WHEN 'sp500' THEN 1 ELSE 2 END,
                                   coalesce(weight_pct, quality_score / 1000) DESC, company_name) = 1))"""


def dim_once(t):
    return cut_lineage(c.company_dim(t.sentences))


@catalog.query("p17_resolved_entities", with_views("\nSELECT * FROM resolved", SENTENCES, TARGETS, DIM, RESOLVED))
def _(t):
    return c.resolve_entities(t.targets, dim_once(t))


@catalog.query(
    "p17_resolution_steps",
    with_views(
        """
SELECT 'id_matches' AS step, count(*) AS n_companies FROM tier1 UNION ALL
SELECT 'tried_by_ticker', count(*) FROM targets WHERE cik NOT IN (SELECT target_cik FROM tier1) AND ticker IS NOT NULL UNION ALL
SELECT 'ticker_matches', count(*) FROM tier2 UNION ALL
SELECT 'matched', count(*) FROM (SELECT target_cik FROM tier1 UNION SELECT target_cik FROM tier2) UNION ALL
SELECT 'unmatched', count(*) FROM targets WHERE cik NOT IN (SELECT target_cik FROM tier1) AND cik NOT IN (SELECT target_cik FROM tier2)""",
        SENTENCES, TARGETS, DIM, RESOLVED,
    ),
)
def _(t):
    return c.resolution_summary(t.targets, dim_once(t))


@catalog.query(
    "p40_match_status",
    with_views(
        """
SELECT cik, company_name, source, CASE WHEN k IS NULL THEN 'UNMATCHED' ELSE 'MATCHED' END AS match_status,
  upper(company_name) AS name_normalized, upper(coalesce(ticker, '')) AS ticker_normalized
FROM targets LEFT JOIN (SELECT DISTINCT cik_int AS k FROM sentences) ON CAST(cik AS BIGINT) = k""",
        SENTENCES, TARGETS,
    ),
)
def _(t):
    return c.match_status(t.targets, t.sentences).select(
        "cik", "company_name", "source", "match_status", "name_normalized", "ticker_normalized"
    )


@catalog.query(
    "p40_match_status_by_source",
    with_views(
        """
SELECT source, CASE WHEN k IS NULL THEN 'UNMATCHED' ELSE 'MATCHED' END AS match_status, count(*) AS n_companies
FROM targets LEFT JOIN (SELECT DISTINCT cik_int AS k FROM sentences) ON CAST(cik AS BIGINT) = k GROUP BY 1, 2""",
        SENTENCES, TARGETS,
    ),
)
def _(t):
    return c.match_status(t.targets, t.sentences).groupBy("source", "match_status").agg(F.count(F.lit(1)).alias("n_companies"))


PAIRS = """suspects AS (
  SELECT s_suppkey AS sid, s_suppkey * 3 AS sus_cik, '#' || lpad(CAST(s_suppkey * 5 AS VARCHAR), 9, '0') AS name_pattern,
    'T' || (s_suppkey * 2) AS ticker FROM supplier WHERE s_suppkey >= 5
  UNION ALL SELECT 999999, 8888888, 'NOBODY', 'NONE'),
pairs AS (SELECT DISTINCT sid, cik_int FROM suspects JOIN dim ON sus_cik = cik_int OR contains(name_normalized, name_pattern)
  OR list_contains(all_tickers, ticker)),
detail AS (SELECT s.sid, d.cik_int, d.company_name AS found_name, d.n_sentences, d.n_filings, d.earliest_year, d.latest_year,
  CASE WHEN d.cik_int IS NULL THEN 'MISSING' ELSE 'PRESENT' END AS status
  FROM suspects s LEFT JOIN pairs p ON s.sid = p.sid LEFT JOIN dim d ON p.cik_int = d.cik_int)"""


def coverage_detail(t):
    listed = suspects(t).filter(F.col("sid") >= 5)
    nobody = [(999999, 8888888, "NOBODY", "NONE")]
    listed = listed.unionByName(t.spark.createDataFrame(nobody, listed.schema))
    dim = dim_once(t)
    pairs = j.any_of_join(
        listed, dim, "sid", "cik_int", ("suspect_cik", "cik_int"), ("name_pattern", "name_normalized"), ("ticker", "all_tickers")
    )
    return c.coverage(listed, dim, pairs, "sid")


@catalog.query("p20_coverage_detail", with_views("\nSELECT * FROM detail", SENTENCES, DIM, PAIRS))
def _(t):
    return coverage_detail(t).select(
        "sid", "cik_int", "found_name", "n_sentences", "n_filings", "earliest_year", "latest_year", "status"
    )


@catalog.query(
    "p20_coverage_summary",
    with_views(
        "\nSELECT status, count(DISTINCT sid) AS n_companies, CAST(coalesce(sum(n_sentences), 0) AS BIGINT) AS n_sentences FROM detail GROUP BY status",
        SENTENCES, DIM, PAIRS,
    ),
)
def _(t):
    return c.coverage_summary(coverage_detail(t), "sid")


TOP = """chosen AS (
  (SELECT cik_int, cik, company_name, source, weight_pct, quality_score, 'sp500_top40' AS selection_reason FROM resolved
   WHERE source = 'sp500' ORDER BY weight_pct DESC, cik_int LIMIT 40)
  UNION ALL
  (SELECT cik_int, cik, company_name, source, weight_pct, quality_score, 'notable_top20' FROM resolved
   WHERE source = 'notable' ORDER BY quality_score DESC, cik_int LIMIT 20))"""


@catalog.query(
    "p21_top_subset",
    with_views(
        """
SELECT row_number() OVER (ORDER BY CASE source WHEN 'sp500' THEN 1 ELSE 2 END, coalesce(weight_pct, quality_score / 1000) DESC, cik_int) AS company_id,
  cik, company_name, source, selection_reason FROM chosen""",
        SENTENCES, TARGETS, DIM, RESOLVED, TOP,
    ),
)
def _(t):
    chosen = c.select_top(c.resolve_entities(t.targets, dim_once(t)), 40, 20)
    return chosen.select("company_id", "cik", "company_name", "source", "selection_reason")


SELECT_N = """picked AS (
  SELECT 1 AS g, cik_int, cik, company_name, source, 999999.0::DOUBLE AS score, 'MANUAL' AS selection_source, 0 AS rank_within_group
  FROM (SELECT cik_int, cik, company_name, 'MANUAL' AS source FROM resolved WHERE cik_int = 1)
  UNION ALL
  SELECT * FROM (SELECT 2, cik_int, cik, company_name, source, weight_pct * 1000, 'SNP500_TOP15', row_number() OVER (ORDER BY weight_pct DESC, cik_int) AS rn
    FROM resolved WHERE source = 'sp500' AND cik_int <> 1) WHERE rn <= 15
  UNION ALL
  SELECT * FROM (SELECT 3, cik_int, cik, company_name, source, quality_score, 'QUALITY_TOP5', row_number() OVER (ORDER BY quality_score DESC, cik_int) AS rn
    FROM resolved WHERE source <> 'sp500' AND cik_int <> 1) WHERE rn <= 5)"""


@catalog.query(
    "p21_udf2_select_n_with_manual",
    with_views(
        """
SELECT row_number() OVER (ORDER BY g, rank_within_group, cik_int) AS company_id, cik, company_name, source, score, selection_source,
  rank_within_group, 'v2.0_prod_21companies' AS version FROM picked""",
        SENTENCES, TARGETS, DIM, RESOLVED, SELECT_N,
    ),
)
def _(t):
    resolved = cut_lineage(c.resolve_entities(t.targets, dim_once(t)))
    manual = resolved.filter(F.col("cik_int") == 1).select("cik_int", "cik", "company_name", "ticker")
    picked = c.select_n(resolved, 15, 5, manual)
    return picked.select(
        "company_id", "cik", "company_name", "source", "score", "selection_source", "rank_within_group", "version"
    )


@catalog.query(
    "p21_selection_check",
    with_views(
        "\nSELECT count(*) AS total_companies, count(DISTINCT cik_int) AS unique_ciks, 20::BIGINT AS expected_count, 'as_expected' AS status FROM picked WHERE g > 1",
        SENTENCES, TARGETS, DIM, RESOLVED, SELECT_N,
    ),
)
def _(t):
    return c.check_selection(c.select_n(c.resolve_entities(t.targets, dim_once(t)), 15, 5), 20)


HOLDINGS = """h AS (SELECT c_name AS company_name, 't' || c_custkey AS ticker, c_acctbal AS weight_pct FROM customer),
m AS (SELECT o_custkey AS cik, ' T' || o_custkey || ' ' AS ticker, 'ORDERS OF ' || o_custkey AS sec_company_name
      FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey),
enriched AS (
  SELECT h.*, CASE WHEN h.ticker = 't7' THEN 700007 ELSE m.cik END AS cik,
    CASE WHEN h.ticker = 't7' THEN 'PATCHED' ELSE m.sec_company_name END AS sec_company_name
  FROM h LEFT JOIN m ON upper(trim(h.ticker)) = upper(trim(m.ticker)))"""


def enriched(t):
    holdings = t.customer.select(
        F.col("c_name").alias("company_name"), F.concat(F.lit("t"), "c_custkey").alias("ticker"), F.col("c_acctbal").alias("weight_pct")
    )
    ticker_map = t.orders.filter(F.col("o_orderstatus") == "P").select(
        F.col("o_custkey").alias("cik"), F.concat(F.lit(" T"), "o_custkey", F.lit(" ")).alias("ticker"),
        F.concat(F.lit("ORDERS OF "), "o_custkey").alias("company_name"),
    ).distinct()
    patches = t.spark.createDataFrame([("T7", 700007, "PATCHED")], "ticker string, cik bigint, sec_company_name string")
    return c.enrich_ids(holdings, ticker_map, patches)


@catalog.query("p37_enriched_holdings", with_views("\nSELECT * FROM enriched", HOLDINGS))
def _(t):
    return enriched(t)


@catalog.query(
    "p37_enrichment_checks",
    with_views(
        """
SELECT count(*) AS total_companies, count(DISTINCT cik) AS unique_ciks, count(*) - count(cik) AS failed_matches,
  round(sum(weight_pct), 4) AS total_weight, round(sum(CASE WHEN cik IS NOT NULL THEN weight_pct END), 4) AS matched_weight,
  (SELECT count(*) FROM (SELECT ticker FROM enriched GROUP BY ticker HAVING count(*) > 1)) AS repeated_tickers FROM enriched""",
        HOLDINGS,
    ),
)
def _(t):
    return c.enrichment_checks(enriched(t))


BACKFILL = """s1 AS (SELECT o_custkey AS cik_int, min('P' || o_orderkey) AS ticker FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
s2 AS (SELECT cik_int, min(tickers[1]) AS ticker FROM sentences WHERE len(tickers) > 0 GROUP BY cik_int),
comp AS (SELECT c_custkey AS cik_int, CASE WHEN c_acctbal > 5000 THEN 'own' || c_custkey END AS ticker FROM customer),
filled AS (SELECT comp.cik_int, coalesce(comp.ticker, s1.ticker, s2.ticker) AS ticker
  FROM comp LEFT JOIN s1 ON comp.cik_int = s1.cik_int LEFT JOIN s2 ON comp.cik_int = s2.cik_int)"""


def before_and_after(t):
    own = F.when(F.col("c_acctbal") > 5000, F.concat(F.lit("own"), "c_custkey"))
    companies = t.customer.select(F.col("c_custkey").alias("cik_int"), own.alias("ticker"))
    pending = t.orders.filter(F.col("o_orderstatus") == "P").select(
        F.col("o_custkey").alias("cik_int"), F.concat(F.lit("P"), "o_orderkey").alias("ticker")
    )
    corpus = t.sentences.filter(F.size("tickers") > 0).select("cik_int", F.col("tickers")[0].alias("ticker"))
    return companies, c.backfill_tickers(companies, pending, corpus)


@catalog.query("p24_ticker_backfill", with_views("\nSELECT * FROM filled", SENTENCES, BACKFILL))
def _(t):
    return before_and_after(t)[1]


@catalog.query(
    "p24_completeness",
    with_views(
        "".join(
            f"""{u}
SELECT '{stage}' AS stage, count(*) AS total, count(ticker) AS filled, count(*) - count(ticker) AS missing,
  round(count(ticker) * 100.0 / count(*), 1) AS pct_complete, CASE WHEN count(*) = count(ticker) THEN 'complete' ELSE 'missing_left' END AS status FROM {rel}"""
            for u, stage, rel in (("", "before", "comp"), (" UNION ALL ", "after", "filled"))
        ),
        SENTENCES,
        BACKFILL,
    ),
)
def _(t):
    return c.completeness(*before_and_after(t))


def _picked(t):
    """The selection without its manual row."""
    resolved = cut_lineage(c.resolve_entities(t.targets, dim_once(t)))
    return c.select_n(resolved.filter(F.col("cik_int") != 1), 15, 5)


@catalog.query(
    "p26_selection_breakdown",
    with_views(
        """
SELECT selection_source, count(*) AS n_companies, min(score) AS min_score, max(score) AS max_score, round(avg(score), 2) AS avg_score
FROM picked WHERE g > 1 GROUP BY selection_source""",
        SENTENCES, TARGETS, DIM, RESOLVED, SELECT_N,
    ),
)
def _(t):
    return c.selection_breakdown(_picked(t))


@catalog.query(
    "p16_tier_summary",
    with_views(
        """
SELECT source, tier, count(*) AS n_companies, round(avg(CASE WHEN is_sp500 = 1 THEN weight_pct ELSE quality_score / 1000 END), 3) AS avg_score_proxy
FROM universe GROUP BY source, tier""",
        SENTENCES, SCORED, NOTABLE, UNIVERSE,
    ),
)
def _(t):
    return c.tier_summary(universe(t))


@catalog.query(
    "p19_dimension_spread",
    with_views(
        """
SELECT count(*) AS total_companies, min(n_filings) AS min_filings, round(quantile_cont(n_filings, 0.5), 6) AS median_filings,
  max(n_filings) AS max_filings, round(avg(n_filings), 1) AS avg_filings FROM dim""",
        SENTENCES, DIM,
    ),
)
def _(t):
    return c.dimension_spread(c.company_dim(t.sentences))
