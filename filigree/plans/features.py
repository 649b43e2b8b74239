"""Regex feature flags over sentences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree.functions.bins import iso_in_years

# The flag patterns of the sampled fact; (?i) marks those that ignore case.
LIKELY_KPI = (
    r"(?i)\b(revenue|sales|gross margin|operating margin|net margin|cost|expense|income|earnings|ebitda|cash flow|"
    r"profit|loss|asset|liability|equity|debt|eps|roe|roa|operating income|net income|gross profit)\b"
)
SCALED_NUMBER = (
    r"(?i)\(?\$?\d{1,3}(,\d{3})*(\.\d+)?\)?\s*(million|billion|thousand|M|B|K|%|percent|bps|basis points)"
)
COMMA_NUMBER = r"\d{1,3}(,\d{3})+(\.\d+)?"
DOLLAR_NUMBER = r"\$\d+"
WIDE_BLANK = r"(\s{2,}|\t)"
NUMBER_RUN = r"(\d+\s+){5,}"
FORWARD_LOOKING = (
    r"(?i)\b(expect(s|ed)?|forecast(s|ed)?|plan(s|ned)?|anticipate(s|d)?|believe(s|d)?|estimate(s|d)?|"
    r"project(s|ed)?|intend(s|ed)?|guidance|outlook|target(s|ed)?)\b"
)
COMPARISON = (
    r"(?i)\b(increas|decreas|compar|prior|previous|year-over-year|yoy|y/y|quarter-over-quarter|qoq|q/q|"
    r"versus|vs\.|compared to|change|growth|decline)\b"
)
MATERIAL = (
    r"(?i)\b(significant|material|substantially|primarily|approximately|considerable|major|critical|key|important)\b"
)
YEAR_MENTION = r"\b(19\d{2}|20\d{2})\b"
RISK = (
    r"(?i)\b(risk(s)?|material adverse|uncertain(ty)?|volatility|exposure to|regulatory (risk|scrutiny)|"
    r"compliance risk|litigation risk|threat|vulnerab)\b"
)
SAFE_HARBOR = (
    r"(?i)\b(forward-looking statement|safe harbor|private securities litigation reform act|"
    r"actual results may differ|risk factors described)\b"
)
# Variants in which word stems match the inflected words they were meant for.
COMPARISON_STEMS = (
    r"(?i)(\b(increas|decreas|compar|declin)\w*|\b(prior|previous|year-over-year|yoy|y/y|quarter-over-quarter|qoq|q/q|"
    r"versus|change|growth)\b|\bvs\.)"
)
RISK_STEMS = (
    r"(?i)(\b(risk(s)?|material adverse|uncertain(ty)?|volatility|exposure to|regulatory (risk|scrutiny)|"
    r"compliance risk|litigation risk|threat)\b|\bvulnerab\w*)"
)
# Weights of the retrieval score.
SCORE_WEIGHTS = {
    "likely_kpi": 3,
    "has_numbers": 2,
    "has_comparison": 2,
    "is_material": 1,
    "has_forward_looking": 1,
    "is_recent": 1,
    "is_safe_harbor": -2,
}
FLAG_COLUMNS = (
    "likely_kpi", "has_numbers", "is_table_like", "has_forward_looking", "has_comparison", "is_material",
    "mentions_years", "is_recent", "has_risk_language", "is_safe_harbor",
)


def has_numbers(text: Column) -> Column:
    return text.rlike(SCALED_NUMBER) | text.rlike(COMMA_NUMBER) | text.rlike(DOLLAR_NUMBER)


def flag_columns(
    text: Column, year: Column, recent_year: int = 2018, table_chars: int = 1000, fixed: bool = False
) -> dict[str, Column]:
    """The ten flags by name; ``fixed`` lets word stems match inflected forms."""
    return {
        "likely_kpi": text.rlike(LIKELY_KPI),
        "has_numbers": has_numbers(text),
        "is_table_like": (F.length(text) > table_chars) | text.rlike(WIDE_BLANK) | text.rlike(NUMBER_RUN),
        "has_forward_looking": text.rlike(FORWARD_LOOKING),
        "has_comparison": text.rlike(COMPARISON_STEMS if fixed else COMPARISON),
        "is_material": text.rlike(MATERIAL),
        "mentions_years": text.rlike(YEAR_MENTION),
        "is_recent": year >= recent_year,
        "has_risk_language": text.rlike(RISK_STEMS if fixed else RISK),
        "is_safe_harbor": text.rlike(SAFE_HARBOR),
    }


def add_flags(
    df: DataFrame, text: str = "sentence", year: str = "report_year", recent_year: int = 2018, fixed: bool = False
) -> DataFrame:
    """Add the ten flags and the weighted retrieval score, replacing earlier ones."""
    flagged = df.withColumns(flag_columns(F.col(text), F.col(year), recent_year, fixed=fixed))
    score = sum((F.col(c).cast("bigint") * w for c, w in SCORE_WEIGHTS.items()), F.lit(0))
    return flagged.withColumn("retrieval_signal_score", score.cast("bigint"))


def drop_flags(df: DataFrame) -> DataFrame:
    return df.drop(*FLAG_COLUMNS, "retrieval_signal_score")


def kpi_prefilter(df: DataFrame, both: bool = False) -> DataFrame:
    """Sentences worth parsing: any flag or any digit; with ``both``, the two flags together."""
    if both:
        return df.filter(F.col("likely_kpi") & F.col("has_numbers"))
    return df.filter(F.col("likely_kpi") | F.col("has_numbers") | F.col("sentence").rlike(r"\d"))


# Section codes and patterns of the KPI sentence filter.
KPI_SECTIONS = (0, 1, 8, 9, 10, 11)
KPI_WORDS = r"(?i)(revenue|sales|margin|cost|expense|income|earnings|EBITDA|cash flow)"
KPI_NUMBERS = r"\$?\d+\.?\d*\s*(million|billion|M|B|%)"
NOISE_SECTIONS = (2, 7, 11, 13, 17)


def kpi_sentences(df: DataFrame, years: list[str], min_chars: int = 100) -> DataFrame:
    """Sentences of the wanted years and sections with a KPI word or number, and the company's row count.

    The company count covers the years and sections alone. It is aggregated and joined
    back instead of being a window, so a company with very many rows is not one task.
    """
    wanted = reduce(lambda a, b: a | b, [iso_in_years(F.col("reportDate"), int(y), int(y)) for y in years], F.lit(False))
    chosen = df.filter(wanted & F.col("section").isin(*KPI_SECTIONS))
    totals = chosen.groupBy("name").agg(F.count(F.lit(1)).alias("company_total_sentences"))
    marked = chosen.withColumns(
        {
            "sentence_length": F.length("sentence").cast("bigint"),
            "year": F.substring("reportDate", 1, 4),
            "likely_kpi": F.col("sentence").rlike(KPI_WORDS),
            "has_numbers": F.col("sentence").rlike(KPI_NUMBERS),
        }
    )
    kept = marked.filter((F.col("likely_kpi") | F.col("has_numbers")) & (F.col("sentence_length") > min_chars))
    return kept.join(totals, "name")


def clean_filter(df: DataFrame, max_chars: int = 500, since: str = "2002-01-01") -> DataFrame:
    """Without noise sections, very long sentences and early filings."""
    return df.filter(
        ~F.col("section").isin(*NOISE_SECTIONS) & (F.length("sentence") <= max_chars) & (F.col("reportDate") >= since)
    )


def outliers(df: DataFrame, min_chars: int = 1000) -> DataFrame:
    """Sentences longer than ``min_chars`` characters, mostly tables and lists."""
    return df.withColumn("char_count", F.length("sentence").cast("bigint")).filter(F.col("char_count") > min_chars)
