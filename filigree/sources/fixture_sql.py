"""The same derived views as SQL text, for the comparison engine."""

from __future__ import annotations

from collections.abc import Sequence

from filigree.functions.bins import Bin

SENTENCES = """sentences AS (
  SELECT cik, cik_int, name, tickers, docID,
         docID || '_section_' || section || '_' || l_orderkey || '_' || l_linenumber AS sentenceID,
         section, '10-K' AS form, c_mktsegment AS sic, sentence, filingDate, reportDate, report_year
  FROM (
    SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, o_custkey AS cik_int, c_name AS name,
           CASE WHEN o_custkey % 11 = 0 THEN NULL
                WHEN o_custkey % 13 = 0 THEN CAST([] AS VARCHAR[])
                ELSE ['T' || o_custkey, 'T' || o_custkey || '.A'] END AS tickers,
           lpad(CAST(o_custkey AS VARCHAR), 10, '0') || '_10-K_' || year(o_orderdate) AS docID,
           l_partkey % 20 AS section, l_orderkey, l_linenumber, c_mktsegment,
           CASE l_suppkey % 8
             WHEN 0 THEN 'Net sales were $' || CAST(floor(l_extendedprice) AS BIGINT) || ' million in '
                         || year(o_orderdate) || ' versus the prior year.'
             WHEN 1 THEN 'We expect significant volatility and other risks to our operations.'
             WHEN 2 THEN 'Operating margin improved to ' || CAST(floor(l_quantity) AS BIGINT) || '.5% of revenue.'
             WHEN 3 THEN 'Item 1B. None.'
             WHEN 4 THEN 'This forward-looking statement is subject to the safe harbor and actual results may differ.'
             WHEN 5 THEN 'The Company leased ' || CAST(floor(l_quantity) AS BIGINT)
                         || ' facilities  under long term agreements.'
             WHEN 6 THEN 'Total debt declined by ' || CAST(floor(l_quantity) AS BIGINT) || ','
                         || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') || ' (in thousands).'
             ELSE 'See Exhibit 10.' || CAST(floor(l_quantity) AS BIGINT) || ' filed herewith.' END AS sentence,
           strftime(o_orderdate + INTERVAL 45 DAY, '%Y-%m-%d') AS filingDate,
           strftime(o_orderdate, '%Y-%m-%d') AS reportDate, year(o_orderdate) AS report_year
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
)"""

TARGETS = """targets AS (
  SELECT CAST(CASE WHEN c_custkey % 7 = 0 THEN c_custkey + 10000000 ELSE c_custkey END AS VARCHAR) AS cik,
         c_name AS company_name,
         CASE WHEN c_custkey % 5 <> 0 THEN 't' || c_custkey END AS ticker,
         CASE WHEN c_acctbal >= 5000 THEN 'sp500' ELSE 'notable' END AS source,
         c_mktsegment AS tier,
         CASE WHEN c_acctbal >= 5000 THEN c_acctbal END AS weight_pct,
         CASE WHEN c_acctbal < 5000 THEN c_acctbal END AS quality_score
  FROM customer
)"""

PASSAGES = """passages AS (
  SELECT o_orderkey AS passage_id, CAST(CASE WHEN vec_id % 3 = 0 THEN 0 ELSE vec_id % 10 END AS BIGINT) AS cik,
         CAST(o_orderkey % 5 AS BIGINT) AS section, CAST(floor(year(o_orderdate) / 10) * 10 AS BIGINT) AS decade,
         list_transform(embedding, lambda x, i: CAST(x AS DOUBLE) + CASE WHEN i - 1 = o_orderkey % 64 THEN CAST(o_orderkey % 9 AS DOUBLE) / 16 ELSE 0 END) AS vector
  FROM orders JOIN embeddings ON vec_id = o_custkey % (SELECT count(*) FROM embeddings)
)"""

SPLIT_SENTENCES = """cut_lines AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line, unnest(string_split(text, chr(10))) AS whole FROM documents
), split_sentences AS (
  SELECT doc_id, CAST(line // 20 AS BIGINT) AS section, line, generate_subscripts(string_split(whole, '. '), 1) - 1 AS place,
         unnest(string_split(whole, '. ')) AS sentence FROM cut_lines
)"""

EVENTS_SPLIT = """base AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-24'),
incr AS (SELECT event_id, ts, user_id, event_type, value + 1 AS value, props
         FROM events WHERE ts >= TIMESTAMP '2024-01-18')"""


def with_views(body: str, *views: str) -> str:
    """``WITH`` clause over ``views`` followed by ``body``, which may add more names."""
    return "WITH " + ",\n".join(views) + body


def on_sentences(body: str) -> str:
    return with_views("\n" + body, SENTENCES)


def bin_case(year: str, bins: Sequence[Bin]) -> str:
    arms = " ".join(f"WHEN {year} BETWEEN {b.first} AND {b.last} THEN '{b.label}'" for b in bins)
    return f"CASE {arms} END"
