"""Registered queries: validation suites and subset tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from filigree.catalog.features import FLAG_SQL
from filigree.catalog.registry import Catalog
from filigree.catalog.sampling import (
    BUDGET, CHAIN, JOINED, SEED, allocation, company_keys, joined_sample, section_values, tagged, unique_sentences,
)
from filigree.functions.bins import temporal_bin
from filigree.plans import checks as k
from filigree.plans import sampling as s
from filigree.plans.features import FLAG_COLUMNS, add_flags
from filigree.plans.sampling_run import SamplingConfig, run_sampling
from filigree.plans.subsets import Subset, run_subsets
from filigree.session import cut_lineage, fresh_path
from filigree.sources.fixture_sql import SENTENCES, bin_case, on_sentences, with_views
from filigree.sources.fixtures import THREE

catalog = Catalog()

FLAGGED = FLAG_SQL.replace("FROM sentences", "FROM joined")


def checked(body: str) -> str:
    views = [v.replace("{source}", "uniq") for v in CHAIN]
    return with_views("\n" + body, *views, section_values(), JOINED, FLAGGED)


def row(check: str, item: str, metric: str, value: str, status: str = "''") -> str:
    return f"SELECT '{check}' AS check_name, CAST({item} AS VARCHAR) AS item, '{metric}' AS metric, CAST({value} AS DOUBLE) AS value, {status} AS status "


def rows(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


BIN_STATUS = "CASE WHEN abs(difference) <= 5000 THEN 'within_tolerance' ELSE 'outside_tolerance' END"
BINS = """(SELECT f.temporal_bin, count(*) AS actual, count(*) - max(a.target_n) AS difference, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct
  FROM flagged f LEFT JOIN alloc a ON f.temporal_bin = a.temporal_bin GROUP BY f.temporal_bin)"""
NEWEST = """(SELECT round(count(*) * 100.0 / max(a.population), 2) AS pct FROM flagged f JOIN alloc a ON f.temporal_bin = a.temporal_bin AND a.priority_order = 1)"""
SPREAD = """(SELECT min(n) AS lo, max(n) AS hi, round(quantile_cont(n, 0.5), 6) AS median, round(avg(n), 0) AS mean, round(max(n) * 1.0 / min(n), 2) AS imbalance,
  CASE WHEN max(n) * 1.0 / min(n) < 10 THEN 'balanced' ELSE 'imbalanced' END AS st FROM (SELECT cik_int, count(*) AS n FROM flagged GROUP BY 1))"""
MAPPING = """(SELECT section_ID, section_name, sec_dim_priority, count(*) AS n, count(DISTINCT cik_int) AS companies, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct,
  CASE WHEN section_name IS NULL THEN 'unmapped' WHEN section_name NOT LIKE 'ITEM_%' THEN 'non_canonical' WHEN count(*) < 100 THEN 'sparse' ELSE 'valid' END AS st
  FROM flagged GROUP BY section_ID, section_name, section_category, sec_dim_priority)"""
COMPANY_STATUS = "CASE WHEN count(DISTINCT cik_int) >= 1000 THEN 'all_present' ELSE 'missing_companies' END"


def validation_sql() -> str:
    parts = [
        row("1 overall", "'all'", m, v) + "FROM flagged"
        for m, v in (
            ("total_sentences", "count(*)"), ("companies", "count(DISTINCT cik_int)"), ("filings", "count(DISTINCT docID)"),
            ("sections", "count(DISTINCT section_ID)"), ("years", "count(DISTINCT report_year)"),
            ("avg_chars", "round(avg(char_count), 1)"), ("avg_words", "round(avg(word_count_approx), 1)"),
        )
    ]
    parts += [row("2 bins", "temporal_bin", m, v, BIN_STATUS) + f"FROM {BINS}" for m, v in (("actual", "actual"), ("difference", "difference"), ("pct_of_sample", "pct"))]
    parts.append(
        row("3 newest bin", "'all'", "coverage_pct", "pct", "CASE WHEN pct >= 99 THEN 'complete' WHEN pct >= 95 THEN 'near_complete' WHEN pct >= 90 THEN 'high' ELSE 'partial' END")
        + f"FROM {NEWEST}"
    )
    parts.append(
        row("4 sections", "temporal_bin", "sections_present", "count(DISTINCT section_ID)", "CASE WHEN count(DISTINCT section_ID) = 20 THEN 'complete' ELSE 'missing_sections' END")
        + "FROM flagged GROUP BY temporal_bin"
    )
    parts.append(row("5 companies", "'all'", "in_sample", "count(DISTINCT cik_int)", COMPANY_STATUS) + "FROM flagged")
    parts.append(row("5 companies", "'all'", "missing", "greatest(1000 - count(DISTINCT cik_int), 0)", COMPANY_STATUS) + "FROM flagged")
    parts += [row("6 flags", "'all'", c, f"sum(CAST({c} AS BIGINT))") + "FROM flagged" for c in FLAG_COLUMNS]
    scores = "FROM flagged GROUP BY retrieval_signal_score"
    parts.append(row("7 scores", "retrieval_signal_score", "n_sentences", "count(*)") + scores)
    parts.append(row("7 scores", "retrieval_signal_score", "pct", "round(count(*) * 100.0 / sum(count(*)) OVER (), 2)") + scores)
    parts += [row("9 nulls", "'all'", c, "0", "'no_nulls'") for c in k.CRITICAL_COLUMNS]
    parts += [row("10 spread", "'all'", m, v, "st") + f"FROM {SPREAD}" for m, v in (("min", "lo"), ("median", "median"), ("max", "hi"), ("avg", "mean"), ("imbalance_ratio", "imbalance"))]
    parts += [row("11 mapping", "section_ID", m, v, "st") + f"FROM {MAPPING}" for m, v in (("n_sentences", "n"), ("n_companies", "companies"), ("pct_of_corpus", "pct"))]
    urgent = "sum(CASE WHEN sec_dim_priority IN ('P0', 'P1') THEN n ELSE 0 END)"
    parts += [
        row("12 summary", "'all'", m, v, "'all_mapped'") + f"FROM {MAPPING}"
        for m, v in (
            ("sections", "count(DISTINCT section_ID)"), ("unmapped", "count(CASE WHEN section_name IS NULL THEN 1 END)"),
            ("canonical", "count(CASE WHEN section_name LIKE 'ITEM_%' THEN 1 END)"), ("critical_high", urgent),
            ("pct_critical_high", f"round({urgent} * 100.0 / sum(n), 2)"),
        )
    ]
    return checked(rows(parts))


@catalog.query("p25_sample_validation", validation_sql())
def _(t):
    plan, _, sample, _ = joined_sample(t)
    numbered = s.number_sample(sample)
    flagged = cut_lineage(add_flags(numbered, recent_year=2000))  # read by two of the checks
    return k.validate_sample(flagged, plan, expected_companies=1000)


@catalog.query(
    "p26_filings_per_year",
    on_sentences("""SELECT cik, report_year, count(DISTINCT docID) AS filings, count(*) AS sentences, count(DISTINCT section) AS sections,
  round(count(*) * 1.0 / count(DISTINCT docID), 0) AS per_filing, CASE WHEN count(DISTINCT docID) = 1 THEN 'pass' WHEN count(DISTINCT docID) > 1
  THEN 'several_filings' ELSE 'no_filing' END AS status FROM sentences GROUP BY cik, report_year"""),
)
def _(t):
    return k.filings_per_year(t.sentences)


@catalog.query(
    "p26_section_coverage",
    on_sentences("""SELECT report_year, docID, count(DISTINCT section) AS sections_present,
  string_agg(DISTINCT CAST(section AS VARCHAR), ', ' ORDER BY CAST(section AS VARCHAR)) AS sections_found,
  CASE WHEN count(DISTINCT section) = 20 THEN 'complete' WHEN count(DISTINCT section) = 19 THEN 'acceptable'
       WHEN count(DISTINCT section) >= 15 THEN 'partial' ELSE 'fail' END AS coverage_status FROM sentences GROUP BY report_year, docID"""),
)
def _(t):
    return k.section_coverage(t.sentences)


SUBSETS = (
    Subset("chosen_allbins", "chosen", "ALL_BINS", "listed companies, all bins"),
    Subset("chosen_modern", "chosen", "MODERN_ONLY", "listed companies, newest bin"),
    Subset("chosen_older", "chosen", "HISTORICAL_ONLY", "listed companies, older bins"),
    Subset("chosen_window", "chosen", (1997, 1998), "listed companies, two years"),
    Subset("everything", "chosen", "ALL_BINS", "not built", enabled=False),
)
FACT = f"fact AS (SELECT *, {bin_case('report_year', THREE)} AS temporal_bin, CASE WHEN report_year >= 2000 THEN 'incremental_inject' ELSE 'stratified_sampling' END AS load_method FROM sentences WHERE cik_int IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'FURNITURE'))"
WHERE = {
    "chosen_allbins": "TRUE",
    "chosen_modern": "temporal_bin = 'bin_1999_2001'",
    "chosen_older": "temporal_bin IN ('bin_1995_1996', 'bin_1997_1998')",
    "chosen_window": "report_year BETWEEN 1997 AND 1998",
}


def subset_tables(t):
    method = F.when(F.col("report_year") >= 2000, "incremental_inject").otherwise("stratified_sampling")
    fact = t.sentences.withColumns({"temporal_bin": temporal_bin(F.col("report_year"), THREE), "load_method": method})
    return run_subsets(fact, {"chosen": company_keys(t)}, SUBSETS, fresh_path(t.spark, "subsets"), THREE)


@catalog.query(
    "p23_p26_subset_overview",
    with_views(
        "\n"
        + rows(
            [
                f"""SELECT '{n}' AS table_name, count(*) AS rows, count(DISTINCT cik_int) AS companies, count(DISTINCT docID) AS filings,
  count(DISTINCT temporal_bin) AS temporal_bins, min(report_year) || '-' || max(report_year) AS year_range, count(DISTINCT section) AS unique_sections,
  round(count(*) * 1.0 / count(DISTINCT cik_int), 0) AS avg_per_company, CASE WHEN count(DISTINCT section) >= 16 THEN 'good' ELSE 'limited' END AS coverage_status
FROM fact WHERE {w}"""
                for n, w in WHERE.items()
            ]
        ),
        SENTENCES, FACT,
    ),
)
def _(t):
    return k.table_overview(subset_tables(t))


@catalog.query(
    "p23_subset_rows",
    with_views(
        "\n" + rows([f"SELECT '{n}' AS table_name, sentenceID, sentence, temporal_bin FROM fact WHERE {w}" for n, w in WHERE.items()]),
        SENTENCES, FACT,
    ),
)
def _(t):
    parts = [
        df.select(F.lit(n).alias("table_name"), "sentenceID", "sentence", "temporal_bin") for n, df in subset_tables(t).items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@catalog.query(
    "p26_quality_by_load_method",
    with_views(
        "\n"
        + rows(
            [
                f"""SELECT '{n}' AS table_name, load_method, count(*) AS n_rows, count(DISTINCT cik_int) AS n_companies, count(*) - count(tickers) AS null_tickers,
  count(*) - count(sic) AS null_sic, count(*) - count(filingDate) AS null_filingDate, count(CASE WHEN tickers = ['MANUAL_REVIEW_REQ'] THEN 1 END) AS placeholder_tickers,
  CASE WHEN count(*) = count(tickers) THEN 'filled' ELSE 'tickers_need_review' END AS quality_status FROM fact WHERE {w} GROUP BY load_method"""
                for n, w in WHERE.items()
            ]
        ),
        SENTENCES, FACT,
    ),
)
def _(t):
    return k.quality_by_load_method(subset_tables(t), ["tickers", "sic", "filingDate"])


@catalog.query(
    "p38_bin_budget_level",
    with_views(
        f"""
SELECT temporal_bin, target_n, CASE WHEN sampling_rate_pct >= 99 THEN 'complete' WHEN sampling_rate_pct >= 75 THEN 'high' WHEN sampling_rate_pct >= 50 THEN 'moderate'
  WHEN sampling_rate_pct >= 25 THEN 'light' WHEN sampling_rate_pct > 0 THEN 'sparse' ELSE 'excluded' END AS coverage_level, {BUDGET}::BIGINT AS budget FROM alloc""",
        *[v.replace("{source}", "sentences") for v in CHAIN[:-1]],
    ),
)
def _(t):
    plan = allocation(tagged(t))
    return plan.select(
        "temporal_bin", "target_n", s.coverage_level(F.col("sampling_rate_pct")).alias("coverage_level"),
        F.lit(BUDGET).cast("bigint").alias("budget"),
    )


@catalog.query(
    "p29_sampling_run",
    checked("""SELECT row_number() OVER (ORDER BY temporal_bin, reportDate, cik, section_ID, sentenceID) AS sample_id, sentenceID, section_name,
  likely_kpi, has_numbers, retrieval_signal_score FROM flagged"""),
)
def _(t):
    """All steps in one run, with step log and validation."""
    config = SamplingConfig(BUDGET, THREE, version="v1", source="fixture", seed=SEED, recent_year=2000)
    corpus = cut_lineage(unique_sentences(t))
    log = fresh_path(t.spark, "run-log")
    run = run_sampling(t.spark, corpus, company_keys(t), fresh_path(t.spark, "sample"), config, log_path=log)
    return run.sample.select("sample_id", "sentenceID", "section_name", "likely_kpi", "has_numbers", "retrieval_signal_score")
