"""Registered queries: KPI extraction, typing, reports and packing."""

from __future__ import annotations

from pyspark.sql import functions as F

from filigree.catalog.features import FLAG_SQL
from filigree.catalog.registry import Catalog
from filigree.plans import kpi as k
from filigree.plans.features import add_flags, kpi_prefilter
from filigree.sources.fixture_sql import SENTENCES, on_sentences, with_views

catalog = Catalog()

TYPE_SQL = """CASE WHEN regexp_matches(lower(sentence), 'revenue|sales|turnover') THEN 'revenue'
  WHEN regexp_matches(lower(sentence), 'income|earnings|profit') THEN CASE WHEN contains(lower(sentence), 'net') THEN 'net_income'
    WHEN contains(lower(sentence), 'operating') THEN 'operating_income' ELSE 'income' END
  WHEN contains(lower(sentence), 'ebitda') THEN 'ebitda'
  WHEN contains(lower(sentence), 'margin') THEN CASE WHEN contains(lower(sentence), 'gross') THEN 'gross_margin'
    WHEN contains(lower(sentence), 'operating') THEN 'operating_margin' ELSE 'margin' END
  WHEN regexp_matches(lower(sentence), 'eps|per share') THEN 'eps' ELSE 'financial_metric' END"""
RECORDS = f"""raws AS (SELECT *, unnest(regexp_extract_all(sentence, '{k.CURRENCY}', 0)) AS value_raw FROM sentences),
records AS (
  SELECT {TYPE_SQL} AS kpi_type, TRY_CAST(replace(regexp_extract(value_raw, '{k.CURRENCY}', 1), ',', '') AS DOUBLE)
      * CASE WHEN upper(regexp_extract(value_raw, '{k.CURRENCY}', 2)) IN ('BILLION', 'BN', 'B') THEN 1e9
             WHEN upper(regexp_extract(value_raw, '{k.CURRENCY}', 2)) IN ('MILLION', 'MN', 'M') THEN 1e6 ELSE 1.0 END AS value,
    value_raw, coalesce(nullif(regexp_extract(sentence, '{k.YEAR}', 1), ''), left(reportDate, 4), '') AS year, 0.5::DOUBLE AS confidence,
    sentence AS source_answer, sentence AS original_sentence, sentenceID, cik, tickers[1] AS ticker, name AS company,
    section, docID, reportDate FROM raws),
valid AS (SELECT * FROM records WHERE value IS NOT NULL)"""


@catalog.query("k1_kpi_records", with_views("\nSELECT * FROM valid", SENTENCES, RECORDS))
def _(t):
    return k.extract_kpis(t.sentences)


@catalog.query(
    "k1_percent_and_quarter_marks",
    on_sentences(f"""SELECT sentenceID, sentence, array_to_string(regexp_extract_all(sentence, '{k.PERCENT}', 1), ',') AS percents,
  upper(array_to_string(regexp_extract_all(sentence, '{k.QUARTER}', 1), ',')) AS quarters FROM sentences"""),
)
def _(t):
    marks = k.extract_marks(t.sentences)
    return marks.select("sentenceID", "sentence", F.array_join("percents", ",").alias("percents"), F.array_join("quarters", ",").alias("quarters"))


@catalog.query(
    "k2_kpi_types",
    on_sentences(f"SELECT {TYPE_SQL} AS kpi_type, section, count(*) AS n FROM sentences GROUP BY 1, 2"),
)
def _(t):
    return t.sentences.groupBy(k.kpi_type(F.col("sentence")).alias("kpi_type"), "section").agg(F.count(F.lit(1)).alias("n"))


@catalog.query(
    "k3_deduped_kpi_records",
    with_views("\nSELECT DISTINCT kpi_type, value, year, ticker, sentenceID FROM valid", SENTENCES, RECORDS),
)
def _(t):
    return k.dedupe_kpis(k.extract_kpis(t.sentences)).select("kpi_type", "value", "year", "ticker", "sentenceID")


@catalog.query(
    "k3_kpi_report",
    with_views(
        """
SELECT kpi_type, count(*) AS n_records, 0.5::DOUBLE AS mean_confidence, 0.5::DOUBLE AS min_confidence, 0.5::DOUBLE AS max_confidence
FROM (SELECT DISTINCT kpi_type, value, year, ticker, sentenceID FROM valid) GROUP BY kpi_type""",
        SENTENCES, RECORDS,
    ),
)
def _(t):
    return k.kpi_distribution(k.dedupe_kpis(k.extract_kpis(t.sentences)))


@catalog.query(
    "k4_sentence_packs",
    with_views(
        """,
numbered AS (SELECT *, row_number() OVER (ORDER BY sentenceID, sentence) AS n FROM flagged WHERE likely_kpi AND has_numbers)
SELECT (n - 1) // 12 AS pack, count(*) AS n_sentences, string_agg('<<' || sentenceID || '>> (Company: ' || name || ', Ticker: '
  || coalesce(tickers[1], '') || ') ' || trim(replace(sentence, chr(10), ' ')), chr(10) || chr(10) ORDER BY n) AS block
FROM numbered GROUP BY 1""",
        SENTENCES, FLAG_SQL,
    ),
)
def _(t):
    chosen = kpi_prefilter(add_flags(t.sentences, recent_year=2000), both=True)
    return k.pack(chosen, ["sentenceID", "sentence"])
