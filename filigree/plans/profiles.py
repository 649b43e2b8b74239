"""Corpus profiles: scale, grain, density, growth, inventories and comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filigree.functions.bins import FIVE_BINS, THREE_BINS, Bin, temporal_bin, year_span
from filigree.functions.numbers import percent, ratio, round_half_away
from filigree.functions.text import split_count
from filigree.operators.aggregates import dealt_out, distinct_by_group, distinct_counts, grain_counts, quantiles
from filigree.operators.joins import semi
from filigree.plans.sampling import quality_predicate

GRAIN = ("cik", "docID", "report_year", "section")


def grain_table(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """One row per company, filing, year and section, with sizes and dates.

    The reports below aggregate this table; it is smaller than the corpus by the
    number of sentences in a section.
    """
    chars = F.length("sentence")
    return df.groupBy(*GRAIN, *extra).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(chars).alias("chars"),
        F.min(chars).cast("bigint").alias("min_chars"),
        F.max(chars).cast("bigint").alias("max_chars"),
        F.min("reportDate").alias("first_date"),
        F.max("reportDate").alias("last_date"),
    )


def _share(count: str) -> Column:
    # Only used on frames with one row per section, bin or year.
    return percent(F.col(count), F.sum(count).over(Window.partitionBy()))


def corpus_scale(df: DataFrame, first: int, last: int) -> DataFrame:
    """One row: sentences, distinct ids, companies, filings and years in a year window."""
    kept = df.filter(F.col("report_year").between(first, last))
    filings = kept.groupBy("cik", "docID", "report_year").agg(F.count(F.lit(1)).alias("n"))
    facts = filings.agg(
        F.sum("n").alias("total_sentences"),
        F.countDistinct("cik").alias("total_companies"),
        F.countDistinct("docID").alias("total_filings"),
        F.countDistinct("report_year").alias("years_covered"),
    ).crossJoin(F.broadcast(distinct_counts(kept, {"sentenceID": "unique_sentences"})))  # one row each
    return facts.select("total_sentences", "unique_sentences", "total_companies", "total_filings", "years_covered").withColumns(
        {
            "millions": round_half_away(F.col("total_sentences") / 1e6, 2),
            "hours_at_10k": round_half_away(F.col("total_sentences") / 1e4, 1),
        }
    )


def bin_profile(df: DataFrame, bins: Sequence[Bin] = FIVE_BINS, keys: DataFrame | None = None) -> DataFrame:
    """Per temporal bin: sentences, companies, filings, years covered, share and densities."""
    first, last = year_span(bins)
    kept = df.filter(F.col("report_year").between(first, last))
    if keys is not None:
        kept = semi(kept, keys, "cik_int")
    grain = grain_table(kept).withColumn("temporal_bin", temporal_bin(F.col("report_year"), bins, "bin_other"))
    facts = grain.groupBy("temporal_bin").agg(
        F.sum("n").alias("n_sentences"),
        F.countDistinct("cik").alias("n_companies"),
        F.countDistinct("docID").alias("n_filings"),
        F.min("report_year").alias("first_year"),
        F.max("report_year").alias("last_year"),
    )
    return facts.withColumns(
        {
            "pct_of_total": _share("n_sentences"),
            "per_company": ratio(F.col("n_sentences"), F.col("n_companies"), 0),
            "per_filing": ratio(F.col("n_sentences"), F.col("n_filings"), 0),
        }
    )


def company_density(df: DataFrame) -> DataFrame:
    """One row: how sentences are spread over companies."""
    sizes = df.groupBy("cik").agg(F.count(F.lit(1)).alias("n"))
    return _spread(sizes, "n").withColumnRenamed("groups", "total_companies")


def _spread(sizes: DataFrame, value: str) -> DataFrame:
    return sizes.agg(
        F.count(F.lit(1)).alias("groups"),
        F.min(value).alias("smallest"),
        *quantiles(value, {"p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95}),
        F.max(value).alias("largest"),
        round_half_away(F.avg(value), 1).alias("mean"),
        round_half_away(F.stddev(value), 1).alias("stddev"),
    ).withColumns({"p95_to_median": ratio(F.col("p95"), F.col("median")), "max_to_min": ratio(F.col("largest"), F.col("smallest"))})


def yearly_growth(df: DataFrame) -> DataFrame:
    """Per year: size, change against the year before and running total."""
    years = grain_table(df).groupBy("report_year").agg(
        F.sum("n").alias("n_sentences"), F.countDistinct("cik").alias("n_companies"), F.countDistinct("docID").alias("n_filings")
    )
    by_year = Window.orderBy("report_year")  # one row per year
    before = F.lag("n_sentences").over(by_year)
    change = F.col("n_sentences") - before
    return years.withColumns(
        {
            "yoy_growth": change,
            "yoy_growth_pct": percent(change, before, 1),
            "cumulative_sentences": F.sum("n_sentences").over(by_year),
            "pct_of_corpus": _share("n_sentences"),
        }
    )


def grain_report(df: DataFrame) -> DataFrame:
    """One row: companies, filings, filing sections, years, sentences and their ratios."""
    facts = dealt_out(grain_counts(df, GRAIN), "cik").agg(
        F.countDistinct("cik").alias("n_companies"),
        F.countDistinct("docID").alias("n_filings"),
        F.countDistinct("cik", "report_year", "section").alias("n_filing_sections"),
        F.countDistinct("report_year").alias("n_years"),
        F.sum("n").alias("n_sentences"),
    )
    return facts.withColumns(
        {
            "avg_sentences_per_filing": ratio(F.col("n_sentences"), F.col("n_filings"), 1),
            "avg_sentences_per_section": ratio(F.col("n_sentences"), F.col("n_filing_sections"), 1),
            "avg_sections_per_filing": ratio(F.col("n_filing_sections"), F.col("n_filings"), 2),
        }
    )


def filing_sizes(df: DataFrame) -> DataFrame:
    """One row: distribution of sentences per filing."""
    sizes = df.groupBy("docID", "cik", "report_year").agg(F.count(F.lit(1)).alias("n"))
    return _spread(sizes, "n").withColumnRenamed("groups", "n_filings")


def section_overview(df: DataFrame) -> DataFrame:
    """Per section: companies, filings, sentences, share and sentences per filing."""
    counted = {"cik": "companies_with_section", "docID": "filings_with_section"}
    facts = distinct_by_group(grain_counts(df, GRAIN, "n_sentences"), "section", counted, "n_sentences")
    return facts.withColumns(
        {
            "pct_of_corpus": _share("n_sentences"),
            "avg_sentences_per_filing": ratio(F.col("n_sentences"), F.col("filings_with_section"), 1),
            "overall_avg_per_section": round_half_away(F.avg("n_sentences").over(Window.partitionBy()), 1),
        }
    )


def section_sizes(df: DataFrame) -> DataFrame:
    """Per section: distribution of its sentences per filing."""
    sizes = df.groupBy("section", "docID").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("section").agg(
        F.count(F.lit(1)).alias("n_filings_with_section"),
        round_half_away(F.avg("n"), 1).alias("avg_sentences"),
        *quantiles("n", {"median_sentences": 0.5, "p90_sentences": 0.9}),
        F.max("n").alias("max_sentences"),
        round_half_away(F.stddev("n"), 1).alias("stddev"),
    )


def inventory(df: DataFrame, keys: DataFrame, bins: Sequence[Bin] = THREE_BINS, by_year: bool = False) -> DataFrame:
    """What the corpus holds for listed companies inside the year window, per bin or per year."""
    first, last = year_span(bins)
    kept = semi(df.filter(quality_predicate(first, last)), keys, "cik_int")
    label = temporal_bin(F.col("report_year"), bins)
    group = [F.col("report_year"), label.alias("temporal_bin")] if by_year else [label.alias("temporal_bin")]
    facts = grain_table(kept).groupBy(*group).agg(
        F.sum("n").alias("n_sentences"),
        F.countDistinct("cik").alias("n_companies"),
        F.countDistinct("docID").alias("n_filings"),
        F.countDistinct("section").alias("n_sections"),
        round_half_away(F.sum("chars").cast("double") / F.sum("n"), 1).alias("avg_char_length"),
        F.min("min_chars").alias("min_char_length"),
        F.max("max_chars").alias("max_char_length"),
    )
    return facts.withColumns(
        {
            "pct_of_total": _share("n_sentences"),
            "per_company": ratio(F.col("n_sentences"), F.col("n_companies"), 0),
            "filings_per_company": ratio(F.col("n_filings"), F.col("n_companies"), 1),
        }
    )


def window_total(df: DataFrame, keys: DataFrame, bins: Sequence[Bin] = THREE_BINS, budget: int = 1_000_000) -> DataFrame:
    """One row: totals of the listed companies in the window and the rate that a budget would take."""
    first, last = year_span(bins)
    kept = semi(df.filter(quality_predicate(first, last)), keys, "cik_int")
    return grain_table(kept).agg(
        F.sum("n").alias("total_sentences"),
        F.countDistinct("cik").alias("n_companies"),
        F.countDistinct("docID").alias("n_filings"),
        F.countDistinct("report_year").alias("n_years"),
        F.countDistinct("section").alias("n_sections"),
        F.min("first_date").alias("earliest_report_date"),
        F.max("last_date").alias("latest_report_date"),
        round_half_away(F.sum("chars").cast("double") / F.sum("n"), 1).alias("avg_char_length"),
        round_half_away(F.lit(float(budget)) / F.sum("n") * 100, 2).alias("sampling_rate_pct"),
    )


def probe(df: DataFrame, keys: DataFrame, preview: int = 3, preview_chars: int = 100) -> DataFrame:
    """Per listed company: size, years present, date range and the start of its latest sentences."""
    from filigree.operators.windows import top_per_group

    chosen = semi(df, keys, "cik_int")
    facts = chosen.groupBy("cik_int").agg(
        F.count(F.lit(1)).alias("total_sentences"),
        F.countDistinct("docID").alias("n_filings"),
        F.array_join(F.array_sort(F.collect_set("report_year")), ",").alias("years_present"),
        F.min("reportDate").alias("earliest_filing"),
        F.max("reportDate").alias("latest_filing"),
    )
    latest = top_per_group(chosen, ["cik_int"], ["-reportDate", "sentenceID", "sentence"], preview).select(
        "cik_int", F.struct("rn", F.left("sentence", F.lit(preview_chars)).alias("text")).alias("p")
    )
    shown = latest.groupBy("cik_int").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["text"]), " | ").alias("preview")
    )
    return facts.join(shown, "cik_int")


def inspect_nested(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per nested column: rows, filled, null and filled share."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in columns])
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("_rows").alias("total_rows"),
            F.col(c).alias("non_null"),
            (F.col("_rows") - F.col(c)).alias("nulls"),
            percent(F.col(c), F.col("_rows")).alias("populated_pct"),
        )
        for c in columns
    ]
    return counts.select(F.inline(F.array(*rows)))


def company_cardinalities(df: DataFrame) -> DataFrame:
    """Per company: sentences, filings, years and the number of its ticker spellings."""
    return df.groupBy("cik_int", "name").agg(
        F.count(F.lit(1)).alias("n_sentences"),
        F.countDistinct("docID").alias("n_filings"),
        F.countDistinct("report_year").alias("n_years"),
        F.min("report_year").alias("earliest_year"),
        F.max("report_year").alias("latest_year"),
        F.countDistinct(F.array_join("tickers", ",")).alias("n_ticker_lists"),
    )


def compare_corpora(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per section the share in both corpora and the difference, in one scan of each."""

    def shares(df: DataFrame, name: str) -> DataFrame:
        counts = df.groupBy("section").agg(F.count(F.lit(1)).alias(f"n_{name}"))
        return counts.withColumn(f"pct_{name}", _share(f"n_{name}"))

    both = shares(a, "a").join(shares(b, "b"), "section", "full_outer").fillna(0)
    return both.withColumn("pct_difference", round_half_away(F.col("pct_b") - F.col("pct_a"), 2))


def corpora_summary(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row per corpus: rows, companies, sections and date range."""

    def facts(df: DataFrame, name: str) -> DataFrame:
        grain = df.groupBy("cik", "section").agg(
            F.count(F.lit(1)).alias("n"), F.min("reportDate").alias("lo"), F.max("reportDate").alias("hi")
        )
        return grain.agg(
            F.lit(name).alias("corpus"), F.sum("n").alias("rows"), F.countDistinct("cik").alias("companies"),
            F.countDistinct("section").alias("sections"), F.min("lo").alias("date_start"), F.max("hi").alias("date_end"),
        )

    return facts(a, "a").unionByName(facts(b, "b"))


def text_density(df: DataFrame, text: str = "sentence", by: str | None = None) -> DataFrame:
    """Token and character statistics, overall or per group."""
    sized = df.select(
        *([by] if by else []), F.length(text).cast("bigint").alias("chars"), split_count(F.col(text)).alias("tokens")
    )
    return sized.groupBy(*([by] if by else [])).agg(
        F.count(F.lit(1)).alias("n_rows"),
        round_half_away(F.avg("chars"), 4).alias("avg_chars"),
        round_half_away(F.avg("tokens"), 4).alias("avg_tokens"),
        *quantiles("chars", {"median_chars": 0.5}),
        *quantiles("tokens", {"median_tokens": 0.5, "p95_tokens": 0.95}),
        F.max("chars").alias("max_chars"),
        F.max("tokens").alias("max_tokens"),
        F.min("tokens").alias("min_tokens"),
    )


def company_balance(df: DataFrame) -> DataFrame:
    """Per company: sentences, filings and span of report dates."""
    return df.groupBy("cik", "name").agg(
        F.count(F.lit(1)).alias("sentence_count"),
        F.countDistinct("docID").alias("num_filings"),
        F.min("reportDate").alias("earliest_report"),
        F.max("reportDate").alias("latest_report"),
        F.min_by(F.array_join("tickers", ","), F.struct("reportDate", "sentenceID")).alias("tickers"),
    )


def balance_summary(balance: DataFrame) -> DataFrame:
    """One row: mean, deviation and largest-to-smallest ratio of company sizes."""
    n = F.col("sentence_count")
    return balance.agg(
        F.sum(n).alias("total_sentences"),
        round_half_away(F.avg(n), 2).alias("mean"),
        round_half_away(F.stddev(n), 2).alias("stddev"),
        ratio(F.max(n), F.min(n)).alias("imbalance_ratio"),
    )


def section_usage(df: DataFrame, sections: Sequence[int]) -> DataFrame:
    """Company by section counts as a wide table, zero where a company has no such section."""
    return df.groupBy("name").pivot("section", list(sections)).count().fillna(0)
