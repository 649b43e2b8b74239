"""Company curation: dimension, scoring, selection, universe and entity resolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree.functions.bins import label_by_threshold
from filigree.functions.numbers import percent, ratio, round_half_away
from filigree.functions.ordering import top_k
from filigree.functions.text import NAME_SUFFIXES_SHORT, normalise_key, normalise_name, padded_key
from filigree.operators.aggregates import dealt_out, grain_counts, quantiles
from filigree.operators.joins import by_shuffle, list_contains_join
from filigree.operators.keyed import first_by_key, last_by_key
from filigree.operators.numbering import global_row_number
from filigree.operators.windows import top_per_group
from filigree.session import cut_lineage

# Sections whose sentences count as priority, and the tier thresholds.
PRIORITY_SECTIONS = (1, 8, 10)
WEIGHT_TIERS = ((2.0, "sp500_mega"), (0.5, "sp500_large"), (0.2, "sp500_mid"))
QUALITY_TIERS = ((1200.0, "notable_tier1"), (1000.0, "notable_tier2"), (900.0, "notable_tier3"))
BANK_NAMES = ("%BANCORP%", "%BANK%", "%FINANCIAL CORP%")
ROW = "_target_row"
TARGET_COLUMNS = ("company_name", "ticker", "source", "tier", "weight_pct", "quality_score")


def company_dim(df: DataFrame) -> DataFrame:
    """One row per company: latest name, tickers, coverage and size.

    Rows are first collapsed to one per filing, section, name and ticker list; that
    table is written once and read by the four aggregates. Tickers are merged apart from
    the counts, so a company without tickers stays and one with several is not counted
    several times.
    """
    day = F.to_date("reportDate")
    grain = cut_lineage(
        df.groupBy("cik_int", "docID", "section", "name", "tickers").agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.length("sentence")).alias("chars"),
            F.min(day).alias("first"),
            F.max(day).alias("last"),
        )
    )
    facts = grain.groupBy("cik_int").agg(
        F.min("first").cast("string").alias("earliest_filing_date"),
        F.max("last").cast("string").alias("latest_filing_date"),
        F.countDistinct("docID").alias("n_filings"),
        F.countDistinct(F.year("last")).alias("n_years_covered"),
        F.countDistinct("section").alias("n_sections_covered"),
        round_half_away(F.sum("chars").cast("double") / F.sum("rows"), 1).alias("avg_char_length"),
    )
    ids = df.select("cik_int", "sentenceID").distinct().groupBy("cik_int").agg(F.count(F.lit(1)).alias("n_sentences"))
    names = grain.groupBy("cik_int", "name").agg(F.max("last").alias("last"))
    latest = names.groupBy("cik_int").agg(F.max_by("name", F.struct("last", "name")).alias("company_name"))
    tickers = grain.select("cik_int", F.explode("tickers").alias("ticker")).distinct()
    listed = tickers.groupBy("cik_int").agg(F.array_sort(F.collect_set("ticker")).alias("all_tickers"))
    companies = (
        by_shuffle(facts).join(ids, "cik_int").join(latest, "cik_int").join(listed, "cik_int", "left")
        .withColumn("all_tickers", F.coalesce("all_tickers", F.array().cast("array<string>")))
    )
    return companies.withColumns(
        {
            "cik10": padded_key(F.col("cik_int")),
            "earliest_year": F.year(F.to_date("earliest_filing_date")).cast("bigint"),
            "latest_year": F.year(F.to_date("latest_filing_date")).cast("bigint"),
            "name_normalized": normalise_name(F.col("company_name")),
        }
    )


def score_companies(
    df: DataFrame, min_years: int = 5, min_sections: int = 16, min_sentences: int = 8000, recent_year: int = 2018,
    min_priority: int = 3000,
) -> DataFrame:
    """Companies that pass the five gates, with their quality score."""
    grain = grain_counts(df, ["cik", "name", "report_year", "section"])
    recent, priority = F.col("report_year") >= recent_year, F.col("section").isin(*PRIORITY_SECTIONS)
    facts = dealt_out(grain, "cik", "name").groupBy("cik", "name").agg(
        F.size(F.collect_set("report_year")).cast("bigint").alias("filing_years"),  # a few values each
        F.size(F.collect_set("section")).cast("bigint").alias("section_coverage"),
        F.sum("n").alias("total_sentences"),
        F.coalesce(F.sum(F.when(recent, F.col("n"))), F.lit(0)).alias("recent_sentences"),
        F.coalesce(F.sum(F.when(priority, F.col("n"))), F.lit(0)).alias("priority_section_sentences"),
        F.max("report_year").alias("latest_filing_year"),
    )
    passed = facts.filter(
        (F.col("filing_years") >= min_years)
        & (F.col("section_coverage") >= min_sections)
        & (F.col("total_sentences") >= min_sentences)
        & (F.col("latest_filing_year") >= recent_year)
        & (F.col("priority_section_sentences") >= min_priority)
    )
    score = (
        F.col("filing_years") * 5
        + F.col("section_coverage") * 10
        + F.col("recent_sentences") / 100
        + F.col("priority_section_sentences") / 50
    )
    bank = F.lit(False)
    for pattern in BANK_NAMES:
        bank = bank | F.upper("name").like(pattern)
    return passed.withColumns(
        {"quality_score": score, "company_type": F.when(bank, "regional_bank").otherwise("normal")}
    )


def select_notable(
    scored: DataFrame, must_include: DataFrame, excluded: DataFrame, held: DataFrame | None = None,
    automatic: int = 195, total: int = 200,
) -> DataFrame:
    """The best companies by score, joined by listed ones, without excluded ones, cut to ``total``.

    Keys of all inputs are padded to ten characters before they are compared.
    """

    def keys(df: DataFrame) -> DataFrame:
        return df.select(padded_key(F.col("cik")).alias("cik")).filter(F.col("cik").isNotNull()).distinct()

    pool = scored.withColumn("cik", padded_key(F.col("cik")))
    if held is not None:
        pool = pool.join(keys(held), "cik", "left_anti")
    # The candidates come from a scan of the corpus and are used three times.
    pool = cut_lineage(pool.join(keys(excluded), "cik", "left_anti"))
    best = cut_lineage(top_k(pool, automatic, "-quality_score", "cik"))
    listed = pool.join(keys(must_include), "cik", "left_semi").join(best.select("cik"), "cik", "left_anti")
    chosen = best.withColumn("selection_method", F.lit("automatic")).unionByName(
        listed.withColumn("selection_method", F.lit("listed"))
    )
    cut = top_k(chosen, total, "-quality_score", "cik")
    ranked = global_row_number(cut, ["-quality_score", "cik"], "company_rank", partitions=1)
    return ranked.withColumns(
        {
            "quality_score": round_half_away(F.col("quality_score"), 2),
            "priority_ratio": ratio(F.col("priority_section_sentences"), F.col("total_sentences"), 3),
            "recency_ratio": ratio(F.col("recent_sentences"), F.col("total_sentences"), 3),
            "avg_sentences_per_year": ratio(F.col("total_sentences"), F.col("filing_years"), 1),
        }
    ).withColumnRenamed("name", "company_name")


def enrich_ids(holdings: DataFrame, ticker_map: DataFrame, patches: DataFrame | None = None) -> DataFrame:
    """Holdings with company ids by ticker; ``patches`` (ticker, cik, sec_company_name) override.

    Several ids for one ticker are reduced to the smallest, so holdings are not repeated.
    """

    def by_ticker(df: DataFrame) -> DataFrame:
        return df.groupBy(normalise_key(F.col("ticker")).alias("_t")).agg(
            F.min(F.struct("cik", "sec_company_name")).alias("_m")
        )

    found = holdings.withColumn("_t", normalise_key(F.col("ticker"))).join(
        by_ticker(ticker_map.withColumnRenamed("company_name", "sec_company_name")), "_t", "left"
    )
    match = F.col("_m")
    if patches is not None:
        found = found.join(by_ticker(patches).withColumnRenamed("_m", "_p"), "_t", "left")
        match = F.coalesce(F.col("_p"), F.col("_m"))
    return found.select(
        *holdings.columns, match["cik"].alias("cik"), match["sec_company_name"].alias("sec_company_name")
    )


def enrichment_checks(enriched: DataFrame) -> DataFrame:
    """One row: companies, distinct ids, failed matches, repeated tickers and weight covered."""
    repeated = enriched.groupBy("ticker").agg(F.count(F.lit(1)).alias("n")).agg(
        F.count_if(F.col("n") > 1).alias("repeated_tickers")
    )
    facts = enriched.agg(
        F.count(F.lit(1)).alias("total_companies"),
        F.countDistinct("cik").alias("unique_ciks"),
        F.count_if(F.col("cik").isNull()).alias("failed_matches"),
        round_half_away(F.sum("weight_pct"), 4).alias("total_weight"),
        round_half_away(F.sum(F.when(F.col("cik").isNotNull(), F.col("weight_pct"))), 4).alias("matched_weight"),
    )
    return facts.crossJoin(F.broadcast(repeated))  # one row


def build_universe(held: DataFrame, notable: DataFrame) -> DataFrame:
    """Both company sources under one schema, with tiers, flags and ids in source and weight order."""
    first = held.select(
        F.col("cik").cast("string").alias("cik"), "company_name", "ticker", "sector", "weight_pct",
        F.lit("sp500").alias("source"),
        label_by_threshold(F.col("weight_pct"), WEIGHT_TIERS, "sp500_small").alias("tier"),
        F.lit(None).cast("bigint").alias("filing_years"), F.lit(None).cast("bigint").alias("total_sentences"),
        F.lit(None).cast("double").alias("quality_score"), F.lit(None).cast("bigint").alias("latest_filing_year"),
    )
    second = notable.select(
        F.col("cik").cast("string").alias("cik"), "company_name", F.lit(None).cast("string").alias("ticker"),
        F.lit(None).cast("string").alias("sector"), F.lit(None).cast("double").alias("weight_pct"),
        F.lit("notable").alias("source"),
        label_by_threshold(F.col("quality_score"), QUALITY_TIERS, "notable_tier4").alias("tier"),
        "filing_years", "total_sentences", "quality_score", "latest_filing_year",
    )
    both = first.unionByName(second).withColumns(
        {"_rank": _source_rank(F.col("source")), "_score": F.coalesce("weight_pct", F.col("quality_score") / 1000)}
    )
    numbered = global_row_number(both, ["_rank", "-_score", "cik", "ticker", "company_name"], "company_id")
    premium = F.contains("tier", F.lit("mega")) | F.contains("tier", F.lit("tier1"))
    return numbered.drop("_rank", "_score").withColumns(
        {
            "weight_pct": round_half_away(F.coalesce("weight_pct", F.lit(0.0)), 4),
            "quality_score": round_half_away(F.coalesce("quality_score", F.lit(0.0)), 2),
            "is_sp500": (F.col("source") == "sp500").cast("bigint"),
            "is_premium": premium.cast("bigint"),
        }
    )


def drop_share_classes(universe: DataFrame) -> DataFrame:
    """One row per company id, keeping the class with the highest weight; rows without id are kept."""
    known = universe.filter(F.col("cik").isNotNull()).withColumn("_prefer", -F.col("company_id"))
    best = last_by_key(known, ["cik"], ["weight_pct", "quality_score", "_prefer"]).drop("_prefer")
    return best.unionByName(universe.filter(F.col("cik").isNull()))


def _source_rank(source: Column) -> Column:
    return F.when(source == "sp500", 1).otherwise(2)


def match_by_id(targets: DataFrame, dim: DataFrame) -> DataFrame:
    """Targets whose number is a company of the corpus."""
    wanted = targets.withColumn("_id", F.col("cik").try_cast("bigint"))
    found = dim.select(F.col("cik_int").alias("final_cik_int"))
    return wanted.join(found, F.col("_id") == F.col("final_cik_int")).select(
        ROW, F.col("cik").alias("target_cik"), "final_cik_int", *TARGET_COLUMNS, F.lit("CIK_MATCH").alias("match_method")
    )


def match_by_ticker(targets: DataFrame, dim: DataFrame) -> DataFrame:
    """Targets whose ticker is listed for a company; of several the latest filer, then the larger one."""
    wanted = targets.filter(F.coalesce("ticker", F.lit("")) != "").withColumn("_t", F.upper("ticker"))
    found = dim.select("cik_int", "all_tickers", "latest_filing_date", "n_filings")
    pairs = list_contains_join(wanted, found, "_t", "all_tickers").withColumns({"target_cik": F.col("cik"), "_lowest": -F.col("cik_int")})
    best = last_by_key(
        pairs.select(ROW, "target_cik", "cik_int", "latest_filing_date", "n_filings", "_lowest", *TARGET_COLUMNS),
        [ROW],
        ["latest_filing_date", "n_filings", "_lowest"],
    )
    return best.select(
        ROW, "target_cik", F.col("cik_int").alias("final_cik_int"), *TARGET_COLUMNS, F.lit("TICKER_MATCH").alias("match_method")
    )


def numbered_targets(targets: DataFrame) -> DataFrame:
    """``targets`` as a written table with a number for each row, by which rows of one id, or of none, are told apart."""
    return cut_lineage(targets.withColumn(ROW, F.monotonically_increasing_id()))


def resolve_tiers(targets: DataFrame, dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Matches by id, and matches by ticker of the rows of ``numbered_targets`` that have none by id."""
    first = match_by_id(targets, dim)
    left = targets.join(first.select(ROW), ROW, "left_anti")
    return first, match_by_ticker(left, dim)


def resolve_entities(targets: DataFrame, dim: DataFrame) -> DataFrame:
    """Resolved targets, one row per corpus company, with new ids and the method that matched.

    When several targets resolve to one company the index member wins, then the
    better weighted, then the first by name.
    """
    first, second = resolve_tiers(numbered_targets(targets), dim)
    both = first.unionByName(second).withColumns(
        {
            "_rank": _source_rank(F.col("source")),
            "_score": F.coalesce("weight_pct", F.col("quality_score") / 1000),
            "_minus": -F.coalesce("weight_pct", F.col("quality_score") / 1000),
        }
    )
    one = first_by_key(both, ["final_cik_int"], ["_rank", "_minus", "company_name"]).drop("_minus")
    numbered = global_row_number(one, ["_rank", "-_score", "final_cik_int"], "company_id")
    return numbered.select(
        "company_id", padded_key(F.col("final_cik_int")).alias("cik"), F.col("final_cik_int").alias("cik_int"),
        *TARGET_COLUMNS, "match_method",
    )


def resolution_summary(targets: DataFrame, dim: DataFrame) -> DataFrame:
    """Labelled counts of the two matching steps, over rows of ``targets``; ids may be null or repeated."""
    rows = numbered_targets(targets)
    first, second = resolve_tiers(rows, dim)
    marked = (
        rows.select(ROW, "ticker")
        .join(first.select(ROW, F.lit(1).alias("m1")), ROW, "left")
        .join(second.select(ROW, F.lit(1).alias("m2")), ROW, "left")
    )
    no_id = F.col("m1").isNull()
    has_ticker = F.coalesce("ticker", F.lit("")) != ""
    facts = marked.agg(
        F.count("m1").alias("id_matches"),
        F.count_if(no_id & has_ticker).alias("tried_by_ticker"),
        F.count("m2").alias("ticker_matches"),
        F.count_if(~no_id | F.col("m2").isNotNull()).alias("matched"),
        F.count_if(no_id & F.col("m2").isNull()).alias("unmatched"),
    )
    pairs = [F.struct(F.lit(c).alias("step"), F.col(c).alias("n_companies")) for c in facts.columns]
    return facts.select(F.inline(F.array(*pairs)))


def match_status(targets: DataFrame, ids: DataFrame) -> DataFrame:
    """Every target with its match status and normalised name and ticker."""
    known = ids.select(F.col("cik_int").alias("_id")).filter(F.col("_id").isNotNull()).distinct()
    joined = targets.join(known, F.col("cik").try_cast("bigint") == F.col("_id"), "left")
    return joined.select(
        *targets.columns,
        F.when(F.col("_id").isNotNull(), "MATCHED").otherwise("UNMATCHED").alias("match_status"),
        F.upper(F.regexp_replace("company_name", NAME_SUFFIXES_SHORT, "")).alias("name_normalized"),
        F.upper(F.coalesce("ticker", F.lit(""))).alias("ticker_normalized"),
    )


def coverage(listed: DataFrame, dim: DataFrame, pairs: DataFrame, listed_key: str) -> DataFrame:
    """Every listed company with what the dimension knows of it; ``pairs`` links both keys."""
    found = by_shuffle(pairs).join(dim, "cik_int").select(
        listed_key, "cik_int", F.col("company_name").alias("found_name"), "all_tickers", "n_sentences", "n_filings",
        "earliest_year", "latest_year",
    )
    joined = by_shuffle(listed).join(found, listed_key, "left")
    return joined.withColumn("status", F.when(F.col("cik_int").isNull(), "MISSING").otherwise("PRESENT"))


def coverage_summary(detail: DataFrame, listed_key: str) -> DataFrame:
    return detail.groupBy("status").agg(
        F.countDistinct(listed_key).alias("n_companies"), F.coalesce(F.sum("n_sentences"), F.lit(0)).alias("n_sentences")
    )


def select_top(companies: DataFrame, n_held: int, n_notable: int) -> DataFrame:
    """The best of each source under new ids: index members by weight, the others by quality."""
    first = top_k(companies.filter(F.col("source") == "sp500"), n_held, "-weight_pct", "cik_int").withColumn(
        "selection_reason", F.lit(f"sp500_top{n_held}")
    )
    second = top_k(companies.filter(F.col("source") == "notable"), n_notable, "-quality_score", "cik_int").withColumn(
        "selection_reason", F.lit(f"notable_top{n_notable}")
    )
    both = first.unionByName(second).drop("company_id").withColumns(
        {"_rank": _source_rank(F.col("source")), "_score": F.coalesce("weight_pct", F.col("quality_score") / 1000)}
    )
    return global_row_number(both, ["_rank", "-_score", "cik_int"], "company_id", partitions=1).drop("_rank", "_score")


def select_n(companies: DataFrame, n: int, m: int, manual: DataFrame | None = None) -> DataFrame:
    """``n`` index members, ``m`` others and the manual rows first, numbered in that order.

    ``manual`` has cik_int, cik, company_name, ticker; listed companies are not ranked again.
    """
    base = companies
    if manual is not None:
        base = companies.join(manual.select("cik_int"), "cik_int", "left_anti")
    index = normalise_key(F.col("source")) == "SP500"
    columns = ["cik_int", "cik", "company_name", "ticker", "source", "tier", "score", "selection_source"]

    def ranked(rows: DataFrame, score: Column, label: str, k: int) -> DataFrame:
        scored = rows.withColumns({"score": score, "selection_source": F.lit(label)}).select(*columns)
        return top_per_group(scored, ["selection_source"], ["-score", "cik_int"], k, "rank_within_group")

    parts = ranked(base.filter(index), F.col("weight_pct") * 1000, f"SNP500_TOP{n}", n).unionByName(
        ranked(base.filter(~index), F.col("quality_score"), f"QUALITY_TOP{m}", m)
    )
    extra = 0
    if manual is not None:
        listed = manual.withColumns(
            {"source": F.lit("MANUAL"), "tier": F.lit("TIER_PRIORITY"), "score": F.lit(999999.0),
             "selection_source": F.lit("MANUAL"), "rank_within_group": F.lit(0).cast("bigint")}
        )
        extra = manual.count()
        parts = parts.unionByName(listed.select(*columns, "rank_within_group"))
    group = (
        F.when(F.col("selection_source") == "MANUAL", 1)
        .when(F.col("selection_source").startswith("SNP500"), 2)
        .otherwise(3)
    )
    numbered = global_row_number(
        parts.withColumn("_group", group), ["_group", "rank_within_group", "cik_int"], "company_id", partitions=1
    )
    return numbered.drop("_group").withColumn("version", F.lit(f"v2.0_prod_{n + m + extra}companies"))


def check_selection(selected: DataFrame, expected: int) -> DataFrame:
    """One row: companies, distinct ids and whether both are as expected."""
    facts = selected.agg(
        F.count(F.lit(1)).alias("total_companies"), F.countDistinct("cik_int").alias("unique_ciks")
    )
    good = (F.col("total_companies") == expected) & (F.col("unique_ciks") == expected)
    return facts.withColumns(
        {"expected_count": F.lit(expected).cast("bigint"), "status": F.when(good, "as_expected").otherwise("count_mismatch")}
    )


def backfill_tickers(companies: DataFrame, *sources: DataFrame) -> DataFrame:
    """Fill null tickers from the sources (cik_int, ticker) in order; the smallest per company is taken."""
    out = companies
    for i, source in enumerate(sources):
        found = source.filter(F.col("ticker").isNotNull()).groupBy("cik_int").agg(F.min("ticker").alias(f"_t{i}"))
        out = out.join(found, "cik_int", "left").withColumn("ticker", F.coalesce("ticker", f"_t{i}")).drop(f"_t{i}")
    return out.select(*companies.columns)


def completeness(before: DataFrame, after: DataFrame, column: str = "ticker") -> DataFrame:
    """Filled and missing values of a column before and after a change."""

    def facts(df: DataFrame, label: str) -> DataFrame:
        missing = F.count_if(F.col(column).isNull())
        return df.agg(
            F.lit(label).alias("stage"),
            F.count(F.lit(1)).alias("total"),
            F.count(column).alias("filled"),
            missing.alias("missing"),
            percent(F.count(column), F.count(F.lit(1)), 1).alias("pct_complete"),
            F.when(missing == 0, "complete").otherwise("missing_left").alias("status"),
        )

    return facts(before, "before").unionByName(facts(after, "after"))


def selection_breakdown(selected: DataFrame) -> DataFrame:
    """Per selection source: companies and the range and mean of their score."""
    return selected.groupBy("selection_source").agg(
        F.count(F.lit(1)).alias("n_companies"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        round_half_away(F.avg("score"), 2).alias("avg_score"),
    )


def tier_summary(universe: DataFrame) -> DataFrame:
    """Per source and tier: companies and their mean score on the common scale."""
    proxy = F.when(F.col("is_sp500") == 1, F.col("weight_pct")).otherwise(F.col("quality_score") / 1000)
    return universe.groupBy("source", "tier").agg(
        F.count(F.lit(1)).alias("n_companies"), round_half_away(F.avg(proxy), 3).alias("avg_score_proxy")
    )


def dimension_spread(dim: DataFrame) -> DataFrame:
    """One row: companies and the spread of their filing counts."""
    return dim.agg(
        F.count(F.lit(1)).alias("total_companies"),
        F.min("n_filings").alias("min_filings"),
        *quantiles("n_filings", {"median_filings": 0.5}),
        F.max("n_filings").alias("max_filings"),
        round_half_away(F.avg("n_filings"), 1).alias("avg_filings"),
    )
