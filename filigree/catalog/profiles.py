"""Registered queries: corpus profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from filigree.catalog.registry import Catalog
from filigree.plans import profiles as p
from filigree.plans.sections import dim_sections, join_quality, map_sections, section_preview
from filigree.sources.fixture_sql import SENTENCES, bin_case, on_sentences, with_views
from filigree.sources.fixtures import FIVE, THREE
from filigree.catalog.sampling import KEYS, company_keys, section_values

catalog = Catalog()

SPREAD = """min(n) AS smallest, round(quantile_cont(n, 0.25), 6) AS p25, round(quantile_cont(n, 0.5), 6) AS median,
  round(quantile_cont(n, 0.75), 6) AS p75, round(quantile_cont(n, 0.9), 6) AS p90, round(quantile_cont(n, 0.95), 6) AS p95, max(n) AS largest,
  round(avg(n), 1) AS mean, round(stddev(n), 1) AS stddev, round(quantile_cont(n, 0.95) / quantile_cont(n, 0.5), 2) AS p95_to_median,
  round(max(n) * 1.0 / min(n), 2) AS max_to_min"""


@catalog.query(
    "p30_corpus_scale",
    on_sentences("""SELECT count(*) AS total_sentences, count(DISTINCT sentenceID) AS unique_sentences, count(DISTINCT cik) AS total_companies,
  count(DISTINCT docID) AS total_filings, count(DISTINCT report_year) AS years_covered, round(count(*) / 1000000.0, 2) AS millions,
  round(count(*) / 10000.0, 1) AS hours_at_10k FROM sentences WHERE report_year BETWEEN 1996 AND 2000"""),
)
def _(t):
    return p.corpus_scale(t.sentences, 1996, 2000)


FIVE_SQL = """SELECT temporal_bin, count(*) AS n_sentences, count(DISTINCT cik) AS n_companies, count(DISTINCT docID) AS n_filings,
  min(report_year) AS first_year, max(report_year) AS last_year, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct_of_total,
  round(count(*) / count(DISTINCT cik), 0) AS per_company, round(count(*) / count(DISTINCT docID), 0) AS per_filing
FROM (SELECT *, {bins} AS temporal_bin FROM sentences{where}) GROUP BY temporal_bin"""


@catalog.query("p30_five_bin_density", on_sentences(FIVE_SQL.format(bins=bin_case("report_year", FIVE), where="")))
def _(t):
    return p.bin_profile(t.sentences, FIVE)


@catalog.query(
    "p30_selected_company_bins",
    with_views(
        "\n" + FIVE_SQL.format(bins=bin_case("report_year", FIVE), where=" WHERE cik_int IN (SELECT cik_int FROM keys)"),
        SENTENCES, KEYS,
    ),
)
def _(t):
    return p.bin_profile(t.sentences, FIVE, company_keys(t))


@catalog.query(
    "p30_company_density",
    on_sentences(f"SELECT count(*) AS total_companies, {SPREAD} FROM (SELECT cik, count(*) AS n FROM sentences GROUP BY cik)"),
)
def _(t):
    return p.company_density(t.sentences)


@catalog.query(
    "p30_p31_yearly_growth",
    on_sentences("""SELECT report_year, n_sentences, n_companies, n_filings, n_sentences - lag(n_sentences) OVER (ORDER BY report_year) AS yoy_growth,
  round((n_sentences - lag(n_sentences) OVER (ORDER BY report_year)) * 100.0 / nullif(lag(n_sentences) OVER (ORDER BY report_year), 0), 1) AS yoy_growth_pct,
  CAST(sum(n_sentences) OVER (ORDER BY report_year) AS BIGINT) AS cumulative_sentences, round(n_sentences * 100.0 / sum(n_sentences) OVER (), 2) AS pct_of_corpus
FROM (SELECT report_year, count(*) AS n_sentences, count(DISTINCT cik) AS n_companies, count(DISTINCT docID) AS n_filings FROM sentences GROUP BY 1)"""),
)
def _(t):
    return p.yearly_growth(t.sentences)


@catalog.query(
    "p31_grain_report",
    on_sentences("""SELECT *, round(n_sentences / n_filings, 1) AS avg_sentences_per_filing, round(n_sentences / n_filing_sections, 1) AS avg_sentences_per_section,
  round(n_filing_sections / n_filings, 2) AS avg_sections_per_filing FROM (
  SELECT count(DISTINCT cik) AS n_companies, count(DISTINCT docID) AS n_filings, count(DISTINCT concat(cik, '-', report_year, '-', section)) AS n_filing_sections,
    count(DISTINCT report_year) AS n_years, count(*) AS n_sentences FROM sentences)"""),
)
def _(t):
    return p.grain_report(t.sentences)


@catalog.query(
    "p31_filing_sizes",
    on_sentences(f"SELECT count(*) AS n_filings, {SPREAD} FROM (SELECT docID, cik, report_year, count(*) AS n FROM sentences GROUP BY ALL)"),
)
def _(t):
    return p.filing_sizes(t.sentences)


@catalog.query(
    "p31_section_overview",
    on_sentences("""SELECT section, count(DISTINCT cik) AS companies_with_section, count(DISTINCT docID) AS filings_with_section, count(*) AS n_sentences,
  round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct_of_corpus, round(count(*) / count(DISTINCT docID), 1) AS avg_sentences_per_filing,
  round(avg(count(*)) OVER (), 1) AS overall_avg_per_section FROM sentences GROUP BY section"""),
)
def _(t):
    return p.section_overview(t.sentences)


@catalog.query(
    "p31_section_sizes",
    on_sentences("""SELECT section, count(*) AS n_filings_with_section, round(avg(n), 1) AS avg_sentences, round(quantile_cont(n, 0.5), 6) AS median_sentences,
  round(quantile_cont(n, 0.9), 6) AS p90_sentences, max(n) AS max_sentences, round(stddev(n), 1) AS stddev
FROM (SELECT section, docID, count(*) AS n FROM sentences GROUP BY ALL) GROUP BY section"""),
)
def _(t):
    return p.section_sizes(t.sentences)


KEPT = f"""kept AS (SELECT *, {bin_case("report_year", THREE)} AS temporal_bin FROM sentences
  WHERE cik_int IN (SELECT cik_int FROM keys) AND report_year BETWEEN 1995 AND 2001 AND section IS NOT NULL AND length(sentence) > 10)"""
INVENTORY = """count(*) AS n_sentences, count(DISTINCT cik) AS n_companies, count(DISTINCT docID) AS n_filings, count(DISTINCT section) AS n_sections,
  round(avg(length(sentence)), 1) AS avg_char_length, min(length(sentence)) AS min_char_length, max(length(sentence)) AS max_char_length,
  round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct_of_total, round(count(*) * 1.0 / count(DISTINCT cik), 0) AS per_company,
  round(count(DISTINCT docID) * 1.0 / count(DISTINCT cik), 1) AS filings_per_company"""


@catalog.query(
    "p32_inventory_by_bin",
    with_views(f"\nSELECT temporal_bin, {INVENTORY} FROM kept GROUP BY temporal_bin", SENTENCES, KEYS, KEPT),
)
def _(t):
    return p.inventory(t.sentences, company_keys(t), THREE)


@catalog.query(
    "p32_inventory_by_year",
    with_views(f"\nSELECT report_year, temporal_bin, {INVENTORY} FROM kept GROUP BY report_year, temporal_bin", SENTENCES, KEYS, KEPT),
)
def _(t):
    return p.inventory(t.sentences, company_keys(t), THREE, by_year=True)


@catalog.query(
    "p32_window_total",
    with_views(
        """
SELECT count(*) AS total_sentences, count(DISTINCT cik) AS n_companies, count(DISTINCT docID) AS n_filings, count(DISTINCT report_year) AS n_years,
  count(DISTINCT section) AS n_sections, min(reportDate) AS earliest_report_date, max(reportDate) AS latest_report_date,
  round(avg(length(sentence)), 1) AS avg_char_length, round(40000.0::DOUBLE / count(*) * 100, 2) AS sampling_rate_pct FROM kept""",
        SENTENCES, KEYS, KEPT,
    ),
)
def _(t):
    return p.window_total(t.sentences, company_keys(t), THREE, 40_000)


@catalog.query(
    "p33_company_probe",
    with_views(
        """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY cik_int ORDER BY reportDate DESC, sentenceID, sentence) AS rn FROM sentences
  WHERE cik_int IN (SELECT cik_int FROM keys))
SELECT cik_int, count(*) AS total_sentences, count(DISTINCT docID) AS n_filings, array_to_string(list_sort(list(DISTINCT report_year)), ',') AS years_present,
  min(reportDate) AS earliest_filing, max(reportDate) AS latest_filing,
  string_agg(left(sentence, 100), ' | ' ORDER BY rn) FILTER (rn <= 3) AS preview FROM ranked GROUP BY cik_int""",
        SENTENCES, KEYS,
    ),
)
def _(t):
    return p.probe(t.sentences, company_keys(t))


@catalog.query(
    "p34_section_preview",
    on_sentences("""SELECT section, count(*) AS sentences_in_section, max(name) AS company_name, max(reportDate) AS reportDate, max(docID) AS docID,
  string_agg('| ' || sentence, chr(10) ORDER BY rn) FILTER (rn <= 3) AS preview
FROM (SELECT *, row_number() OVER (PARTITION BY section ORDER BY sentenceID, sentence) AS rn FROM sentences) GROUP BY section"""),
)
def _(t):
    return section_preview(t.sentences)


NESTED = """nested AS (SELECT *, CASE WHEN report_year >= 1997 THEN {'1d': section} END AS labels,
  CASE WHEN section > 5 THEN {'1d': {'ret': 1.0}} END AS returns FROM sentences)"""


@catalog.query(
    "p35_nested_fill_rates",
    with_views(
        "".join(
            f"""{u}
SELECT '{c}' AS "column", count(*) AS total_rows, count({c}) AS non_null, count(*) - count({c}) AS nulls, round(count({c}) * 100.0 / count(*), 2) AS populated_pct FROM nested"""
            for u, c in (("", "labels"), (" UNION ALL ", "returns"))
        ),
        SENTENCES, NESTED,
    ),
)
def _(t):
    labels = F.when(F.col("report_year") >= 1997, F.struct(F.col("section").alias("1d")))
    returns = F.when(F.col("section") > 5, F.struct(F.struct(F.lit(1.0).alias("ret")).alias("1d")))
    return p.inspect_nested(t.sentences.select(labels.alias("labels"), returns.alias("returns")), ["labels", "returns"])


@catalog.query(
    "p35_company_cardinalities",
    on_sentences("""SELECT cik_int, name, count(*) AS n_sentences, count(DISTINCT docID) AS n_filings, count(DISTINCT report_year) AS n_years,
  min(report_year) AS earliest_year, max(report_year) AS latest_year, count(DISTINCT array_to_string(tickers, ',')) AS n_ticker_lists
FROM sentences GROUP BY cik_int, name"""),
)
def _(t):
    return p.company_cardinalities(t.sentences)


@catalog.query(
    "p36_corpus_comparison",
    on_sentences("""SELECT coalesce(a.section, b.section) AS section, coalesce(n_a, 0) AS n_a, coalesce(n_b, 0) AS n_b, coalesce(pct_a, 0) AS pct_a, coalesce(pct_b, 0) AS pct_b,
  round(coalesce(pct_b, 0) - coalesce(pct_a, 0), 2) AS pct_difference FROM
(SELECT section, count(*) AS n_a, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct_a FROM sentences WHERE report_year < 1998 GROUP BY 1) a FULL JOIN
(SELECT section, count(*) AS n_b, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct_b FROM sentences WHERE report_year >= 1998 GROUP BY 1) b ON a.section = b.section"""),
)
def _(t):
    s = t.sentences
    return p.compare_corpora(s.filter(F.col("report_year") < 1998), s.filter(F.col("report_year") >= 1998))


@catalog.query(
    "p36_corpora_summary",
    on_sentences("""SELECT CASE WHEN report_year < 1998 THEN 'a' ELSE 'b' END AS corpus, count(*) AS rows, count(DISTINCT cik) AS companies,
  count(DISTINCT section) AS sections, min(reportDate) AS date_start, max(reportDate) AS date_end FROM sentences GROUP BY 1"""),
)
def _(t):
    s = t.sentences
    return p.corpora_summary(s.filter(F.col("report_year") < 1998), s.filter(F.col("report_year") >= 1998))


@catalog.query(
    "p22_section_mapping",
    with_views(
        """
SELECT item, title, category, priority, count(*) AS n_sentences, count(DISTINCT cik) AS n_companies
FROM sentences LEFT JOIN dim ON section = code GROUP BY ALL""",
        SENTENCES, section_values(),
    ),
)
def _(t):
    mapped = map_sections(t.sentences, dim_sections(t.spark))
    return mapped.groupBy(
        F.col("sec_item_canonical").alias("item"), F.col("section_name").alias("title"),
        F.col("section_category").alias("category"), "priority",
    ).agg(F.count(F.lit(1)).alias("n_sentences"), F.countDistinct("cik").alias("n_companies"))


@catalog.query(
    "p39_join_quality",
    with_views(
        """
SELECT source_item, item AS matched_item, category AS section_category, priority, CASE WHEN item IS NULL THEN 'unmatched' ELSE 'matched' END AS join_status, count(*) AS n_rows
FROM (SELECT CASE WHEN section < 15 THEN ' item_' || section ELSE 'PART_' || section END AS source_item FROM sentences)
LEFT JOIN dim ON upper(trim(source_item)) = upper(trim(item)) GROUP BY ALL""",
        SENTENCES, section_values(),
    ),
)
def _(t):
    code = F.col("section")
    item = F.when(code < 15, F.concat(F.lit(" item_"), code)).otherwise(F.concat(F.lit("PART_"), code))
    return join_quality(t.sentences.select(item.alias("item")), dim_sections(t.spark), "item")


DENSITY = """count(*) AS n_rows, round(avg(c), 4) AS avg_chars, round(avg(k), 4) AS avg_tokens, round(quantile_cont(c, 0.5), 6) AS median_chars,
  round(quantile_cont(k, 0.5), 6) AS median_tokens, round(quantile_cont(k, 0.95), 6) AS p95_tokens, max(c) AS max_chars, max(k) AS max_tokens, min(k) AS min_tokens"""


@catalog.query(
    "t9_text_density_overall",
    f"SELECT {DENSITY} FROM (SELECT length(text) AS c, len(string_split(text, ' ')) AS k FROM documents)",
)
def _(t):
    return p.text_density(t.documents, "text")


@catalog.query(
    "t9_text_density_by_language",
    f"SELECT lang, {DENSITY} FROM (SELECT lang, length(text) AS c, len(string_split(text, ' ')) AS k FROM documents) GROUP BY lang",
)
def _(t):
    return p.text_density(t.documents, "text", "lang")


@catalog.query(
    "t10_company_balance",
    on_sentences("""SELECT cik, name, count(*) AS sentence_count, count(DISTINCT docID) AS num_filings, min(reportDate) AS earliest_report,
  max(reportDate) AS latest_report FROM sentences GROUP BY cik, name"""),
)
def _(t):
    return p.company_balance(t.sentences).drop("tickers")


@catalog.query(
    "t10_balance_summary",
    on_sentences("""SELECT CAST(sum(n) AS BIGINT) AS total_sentences, round(avg(n), 2) AS mean, round(stddev(n), 2) AS stddev, round(max(n) * 1.0 / min(n), 2) AS imbalance_ratio
FROM (SELECT cik, count(*) AS n FROM sentences GROUP BY cik)"""),
)
def _(t):
    return p.balance_summary(p.company_balance(t.sentences))


@catalog.query(
    "a10_company_section_usage",
    on_sentences("SELECT name, " + ", ".join(f'count(CASE WHEN section = {i} THEN 1 END) AS "{i}"' for i in range(20)) + " FROM sentences GROUP BY name"),
)
def _(t):
    return p.section_usage(t.sentences, range(20))
