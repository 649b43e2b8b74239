"""Validation suites: labelled rows with a value and a status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filigree.functions.bins import label_by_threshold
from filigree.functions.numbers import percent, ratio, round_half_away
from filigree.plans.features import FLAG_COLUMNS
from filigree.session import cut_lineage

COMPLETENESS = ((99.0, "complete"), (95.0, "near_complete"), (90.0, "high"))
CRITICAL_COLUMNS = ("cik", "sentence", "section_ID", "temporal_bin", "sample_id", "row_hash")


def _row(check: str, item: Column | str, metric: str, value: Column, status: Column | str = "") -> Column:
    """One report row as a struct."""
    return F.struct(
        F.lit(check).alias("check_name"),
        (F.lit(item) if isinstance(item, str) else item.cast("string")).alias("item"),
        F.lit(metric).alias("metric"),
        value.cast("double").alias("value"),
        (F.lit(status) if isinstance(status, str) else status).alias("status"),
    )


def _report(df: DataFrame, *rows: Column) -> DataFrame:
    return df.select(F.inline(F.array(*rows)))


def sample_grain(sample: DataFrame) -> DataFrame:
    """The sample collapsed to filing and section; most checks read this table only."""
    flags = [F.count_if(F.col(c)).alias(c) for c in FLAG_COLUMNS]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in CRITICAL_COLUMNS]
    return sample.groupBy(
        "temporal_bin", "cik_int", "docID", "report_year", "section_ID", "section_name", "section_category", "sec_dim_priority"
    ).agg(
        F.count(F.lit(1)).alias("n"), F.sum("char_count").alias("chars"), F.sum("word_count_approx").alias("words"), *flags, *nulls
    )


def validate_sample(
    sample: DataFrame, allocation: DataFrame, expected_companies: int, expected_sections: int = 20, tolerance: int = 5000
) -> DataFrame:
    """All checks of a flagged, joined-back sample as (check_name, item, metric, value, status) rows."""
    grain = cut_lineage(sample_grain(sample))
    parts = [
        overall(grain),
        bin_targets(grain, allocation, tolerance),
        newest_bin(grain, allocation),
        sections_per_bin(grain, expected_sections),
        company_coverage(grain, expected_companies),
        flag_counts(grain),
        score_histogram(sample),
        critical_nulls(grain),
        company_spread(grain),
        section_mapping(grain),
        mapping_summary(grain),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def overall(grain: DataFrame) -> DataFrame:
    facts = grain.agg(
        F.sum("n").alias("total_sentences"),
        F.countDistinct("cik_int").alias("companies"),
        F.countDistinct("docID").alias("filings"),
        F.countDistinct("section_ID").alias("sections"),
        F.countDistinct("report_year").alias("years"),
        round_half_away(F.sum("chars").cast("double") / F.sum("n"), 1).alias("avg_chars"),
        round_half_away(F.sum("words").cast("double") / F.sum("n"), 1).alias("avg_words"),
    )
    return _report(facts, *[_row("1 overall", "all", c, F.col(c)) for c in facts.columns])


def bin_targets(grain: DataFrame, allocation: DataFrame, tolerance: int) -> DataFrame:
    actual = grain.groupBy("temporal_bin").agg(F.sum("n").alias("actual"))
    joined = actual.join(allocation.select("temporal_bin", "target_n"), "temporal_bin", "left")
    joined = joined.withColumns(
        {
            "difference": F.col("actual") - F.col("target_n"),
            "pct": percent(F.col("actual"), F.sum("actual").over(Window.partitionBy())),  # one row per bin
        }
    )
    status = F.when(F.abs("difference") <= tolerance, "within_tolerance").otherwise("outside_tolerance")
    item = F.col("temporal_bin")
    return _report(
        joined,
        _row("2 bins", item, "actual", F.col("actual"), status),
        _row("2 bins", item, "difference", F.col("difference"), status),
        _row("2 bins", item, "pct_of_sample", F.col("pct"), status),
    )


def newest_bin(grain: DataFrame, allocation: DataFrame) -> DataFrame:
    newest = allocation.filter(F.col("priority_order") == 1).select("temporal_bin", "population")
    facts = grain.join(F.broadcast(newest), "temporal_bin").agg(  # one row
        F.sum("n").alias("sampled"), F.max("population").alias("population")
    )
    pct = percent(F.col("sampled"), F.col("population"))
    status = label_by_threshold(pct, COMPLETENESS, "partial")
    return _report(facts, _row("3 newest bin", "all", "coverage_pct", pct, status))


def sections_per_bin(grain: DataFrame, expected: int) -> DataFrame:
    facts = grain.groupBy("temporal_bin").agg(F.countDistinct("section_ID").alias("n"))
    status = F.when(F.col("n") == expected, "complete").otherwise("missing_sections")
    return _report(facts, _row("4 sections", F.col("temporal_bin"), "sections_present", F.col("n"), status))


def company_coverage(grain: DataFrame, expected: int) -> DataFrame:
    facts = grain.agg(F.countDistinct("cik_int").alias("n"))
    missing = F.greatest(F.lit(expected) - F.col("n"), F.lit(0))
    status = F.when(missing == 0, "all_present").otherwise("missing_companies")
    return _report(
        facts,
        _row("5 companies", "all", "in_sample", F.col("n"), status),
        _row("5 companies", "all", "missing", missing, status),
    )


def flag_counts(grain: DataFrame) -> DataFrame:
    facts = grain.agg(*[F.sum(c).alias(c) for c in FLAG_COLUMNS])
    return _report(facts, *[_row("6 flags", "all", c, F.col(c)) for c in FLAG_COLUMNS])


def score_histogram(sample: DataFrame) -> DataFrame:
    facts = sample.groupBy(F.col("retrieval_signal_score").alias("score")).agg(F.count(F.lit(1)).alias("n"))
    facts = facts.withColumn("pct", percent(F.col("n"), F.sum("n").over(Window.partitionBy())))  # few scores
    item = F.col("score")
    return _report(facts, _row("7 scores", item, "n_sentences", F.col("n")), _row("7 scores", item, "pct", F.col("pct")))


def critical_nulls(grain: DataFrame) -> DataFrame:
    facts = grain.agg(*[F.sum(f"null_{c}").alias(c) for c in CRITICAL_COLUMNS])
    clean = (F.col("cik") == 0) & (F.col("sentence") == 0)
    status = F.when(clean, "no_nulls").otherwise("nulls_found")
    return _report(facts, *[_row("9 nulls", "all", c, F.col(c), status) for c in CRITICAL_COLUMNS])


def company_spread(grain: DataFrame, balanced_below: float = 10.0) -> DataFrame:
    sizes = grain.groupBy("cik_int").agg(F.sum("n").alias("n"))
    facts = sizes.agg(
        F.min("n").alias("min"),
        round_half_away(F.percentile(F.col("n").cast("double"), F.lit(0.5)), 6).alias("median"),
        F.max("n").alias("max"),
        round_half_away(F.avg("n"), 0).alias("avg"),
        ratio(F.max("n"), F.min("n")).alias("imbalance_ratio"),
    )
    status = F.when(F.col("max") / F.col("min") < balanced_below, "balanced").otherwise("imbalanced")
    return _report(facts, *[_row("10 spread", "all", c, F.col(c), status) for c in facts.columns])


def _mapping(grain: DataFrame) -> DataFrame:
    return grain.groupBy("section_ID", "section_name", "section_category", "sec_dim_priority").agg(
        F.sum("n").alias("n"), F.countDistinct("cik_int").alias("companies")
    )


def section_mapping(grain: DataFrame, sparse_below: int = 100) -> DataFrame:
    facts = _mapping(grain)
    facts = facts.withColumn("pct", percent(F.col("n"), F.sum("n").over(Window.partitionBy())))  # one row per section
    status = (
        F.when(F.col("section_name").isNull(), "unmapped")
        .when(~F.col("section_name").startswith("ITEM_"), "non_canonical")
        .when(F.col("n") < sparse_below, "sparse")
        .otherwise("valid")
    )
    item = F.col("section_ID")
    return _report(
        facts,
        _row("11 mapping", item, "n_sentences", F.col("n"), status),
        _row("11 mapping", item, "n_companies", F.col("companies"), status),
        _row("11 mapping", item, "pct_of_corpus", F.col("pct"), status),
    )


def mapping_summary(grain: DataFrame) -> DataFrame:
    urgent = F.col("sec_dim_priority").isin("P0", "P1")
    facts = _mapping(grain).agg(
        F.countDistinct("section_ID").alias("sections"),
        F.count_if(F.col("section_name").isNull()).alias("unmapped"),
        F.count_if(F.col("section_name").startswith("ITEM_")).alias("canonical"),
        F.coalesce(F.sum(F.when(urgent, F.col("n"))), F.lit(0)).alias("critical_high"),
        percent(F.coalesce(F.sum(F.when(urgent, F.col("n"))), F.lit(0)), F.sum("n")).alias("pct_critical_high"),
    )
    status = F.when(F.col("unmapped") == 0, "all_mapped").otherwise("unmapped_sections")
    return _report(facts, *[_row("12 summary", "all", c, F.col(c), status) for c in facts.columns])


def filings_per_year(df: DataFrame) -> DataFrame:
    """Per year of one company's delivery: filings, sentences and whether exactly one filing came."""
    facts = df.groupBy("cik", "report_year").agg(
        F.countDistinct("docID").alias("filings"), F.count(F.lit(1)).alias("sentences"), F.countDistinct("section").alias("sections")
    )
    status = F.when(F.col("filings") == 1, "pass").when(F.col("filings") > 1, "several_filings").otherwise("no_filing")
    return facts.withColumns({"per_filing": ratio(F.col("sentences"), F.col("filings"), 0), "status": status})


def section_coverage(df: DataFrame, expected: int = 20) -> DataFrame:
    """Per filing: sections present, their list and a grade."""
    facts = df.groupBy("report_year", "docID").agg(
        F.countDistinct("section").alias("sections_present"),
        F.array_join(F.array_sort(F.collect_set(F.col("section").cast("string"))), ", ").alias("sections_found"),
    )
    n = F.col("sections_present")
    grade = F.when(n == expected, "complete").when(n == expected - 1, "acceptable").when(n >= 15, "partial").otherwise("fail")
    return facts.withColumn("coverage_status", grade)


def table_overview(tables: dict[str, DataFrame], good_sections: int = 16) -> DataFrame:
    """Per table: rows, companies, filings, bins, years and section coverage."""
    out = None
    for name, df in tables.items():
        grain = df.groupBy("cik_int", "docID", "temporal_bin", "report_year", "section").agg(F.count(F.lit(1)).alias("n"))
        facts = grain.agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.countDistinct("cik_int").alias("companies"),
            F.countDistinct("docID").alias("filings"),
            F.countDistinct("temporal_bin").alias("temporal_bins"),
            F.concat_ws("-", F.min("report_year"), F.max("report_year")).alias("year_range"),
            F.countDistinct("section").alias("unique_sections"),
        )
        out = facts if out is None else out.unionByName(facts)
    return out.withColumns(
        {
            "avg_per_company": ratio(F.col("rows"), F.col("companies"), 0),
            "coverage_status": F.when(F.col("unique_sections") >= good_sections, "good").otherwise("limited"),
        }
    )


def quality_by_load_method(tables: dict[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """Per table and load method: rows, companies, nulls per column, ticker placeholders and a grade."""
    out = None
    for name, df in tables.items():
        facts = df.groupBy(F.lit(name).alias("table_name"), "load_method").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.countDistinct("cik_int").alias("n_companies"),
            *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
            F.count_if(F.col("tickers") == F.array(F.lit("MANUAL_REVIEW_REQ"))).alias("placeholder_tickers"),
        )
        out = facts if out is None else out.unionByName(facts)
    clean = F.lit(True)
    for c in columns:
        clean = clean & (F.col(f"null_{c}") == 0)
    grade = F.when(clean & (F.col("placeholder_tickers") == 0), "filled").when(
        (F.col("null_tickers") > 0) | (F.col("placeholder_tickers") > 0), "tickers_need_review"
    )
    return out.withColumn("quality_status", grade.otherwise("columns_missing"))
