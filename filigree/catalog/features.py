"""Registered queries: flags, pattern scans and text filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from filigree.catalog.registry import Catalog
from filigree.plans import features as f
from filigree.sources.fixture_sql import on_sentences, with_views, SENTENCES

catalog = Catalog()


def matches(pattern: str, column: str = "sentence") -> str:
    return f"regexp_matches({column}, '{pattern}')"


NUMBERS_SQL = f"({matches(f.SCALED_NUMBER)} OR {matches(f.COMMA_NUMBER)} OR {matches(f.DOLLAR_NUMBER)})"
FLAG_SQL = f"""flagged AS (
  SELECT *, CAST(likely_kpi AS BIGINT) * 3 + CAST(has_numbers AS BIGINT) * 2 + CAST(has_comparison AS BIGINT) * 2
            + CAST(is_material AS BIGINT) + CAST(has_forward_looking AS BIGINT) + CAST(is_recent AS BIGINT)
            - CAST(is_safe_harbor AS BIGINT) * 2 AS retrieval_signal_score
  FROM (SELECT *, {matches(f.LIKELY_KPI)} AS likely_kpi, {NUMBERS_SQL} AS has_numbers,
               (length(sentence) > 1000 OR {matches(f.WIDE_BLANK)} OR {matches(f.NUMBER_RUN)}) AS is_table_like,
               {matches(f.FORWARD_LOOKING)} AS has_forward_looking, {matches(f.COMPARISON)} AS has_comparison,
               {matches(f.MATERIAL)} AS is_material, {matches(f.YEAR_MENTION)} AS mentions_years,
               report_year >= 2000 AS is_recent, {matches(f.RISK)} AS has_risk_language,
               {matches(f.SAFE_HARBOR)} AS is_safe_harbor
        FROM sentences))"""
RECENT = 2000


def flagged(t):
    return f.add_flags(t.sentences, recent_year=RECENT)


def on_flagged(body: str) -> str:
    return with_views("\n" + body, SENTENCES, FLAG_SQL)


@catalog.query(
    "p5_feature_flags",
    on_flagged(f"SELECT sentenceID, {', '.join(f.FLAG_COLUMNS)}, retrieval_signal_score FROM flagged"),
)
def _(t):
    return flagged(t).select("sentenceID", *f.FLAG_COLUMNS, "retrieval_signal_score")


@catalog.query(
    "p5_flag_counts_by_section",
    on_flagged(
        "SELECT section, "
        + ", ".join(f"CAST(sum(CAST({c} AS BIGINT)) AS BIGINT) AS n_{c}" for c in f.FLAG_COLUMNS)
        + " FROM flagged GROUP BY section"
    ),
)
def _(t):
    return flagged(t).groupBy("section").agg(*[F.count_if(F.col(c)).alias(f"n_{c}") for c in f.FLAG_COLUMNS])


@catalog.query(
    "p5_fixed_stem_flags",
    on_sentences(
        f"SELECT sentenceID, {matches(f.COMPARISON_STEMS)} AS has_comparison, {matches(f.RISK_STEMS)} AS has_risk_language FROM sentences"
    ),
)
def _(t):
    return f.add_flags(t.sentences, recent_year=RECENT, fixed=True).select("sentenceID", "has_comparison", "has_risk_language")


@catalog.query(
    "fil3_kpi_prefilter",
    on_flagged("SELECT sentenceID, sentence FROM flagged WHERE likely_kpi OR has_numbers OR regexp_matches(sentence, '\\d')"),
)
def _(t):
    return f.kpi_prefilter(flagged(t)).select("sentenceID", "sentence")


@catalog.query("fil3_both_flags", on_flagged("SELECT sentenceID FROM flagged WHERE likely_kpi AND has_numbers"))
def _(t):
    return f.kpi_prefilter(flagged(t), both=True).select("sentenceID")


@catalog.query(
    "fil4_kpi_sentences",
    on_sentences(f"""SELECT f.name, f.sentenceID, f.year, f.sentence_length, f.likely_kpi, f.has_numbers, c.n AS company_total_sentences
FROM (SELECT *, length(sentence) AS sentence_length, substring(reportDate, 1, 4) AS year,
             {matches(f.KPI_WORDS)} AS likely_kpi, {matches(f.KPI_NUMBERS)} AS has_numbers
      FROM sentences WHERE substring(reportDate, 1, 4) IN ('1999', '2000') AND section IN (0, 1, 8, 9, 10, 11)) f
JOIN (SELECT name, count(*) AS n FROM sentences
      WHERE substring(reportDate, 1, 4) IN ('1999', '2000') AND section IN (0, 1, 8, 9, 10, 11) GROUP BY name) c ON f.name = c.name
WHERE (likely_kpi OR has_numbers) AND sentence_length > 40"""),
)
def _(t):
    found = f.kpi_sentences(t.sentences, ["1999", "2000"], min_chars=40)
    return found.select(
        "name", "sentenceID", "year", "sentence_length", "likely_kpi", "has_numbers", "company_total_sentences"
    )


@catalog.query(
    "fil5_noise_filter",
    on_sentences("""SELECT sentenceID FROM sentences
WHERE section NOT IN (2, 7, 11, 13, 17) AND length(sentence) <= 60 AND reportDate >= '1996-06-01'"""),
)
def _(t):
    return f.clean_filter(t.sentences, max_chars=60, since="1996-06-01").select("sentenceID")


@catalog.query(
    "fil5_long_text_outliers",
    "SELECT doc_id, length(text) AS char_count FROM documents WHERE length(text) > 1000",
)
def _(t):
    return f.outliers(t.documents.select("doc_id", F.col("text").alias("sentence"))).select("doc_id", "char_count")
