"""Numeric KPI values from sentences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree.functions.arrays import first_item
from filigree.functions.numbers import round_half_away
from filigree.operators.keyed import first_by_key
from filigree.operators.numbering import global_row_number

# Value, percent, year and quarter patterns and the multipliers of units. Units stand
# from long to short, so that the raw value keeps "bn"; a unit ends with its word ("12 buildings" is none).
CURRENCY = r"(?i)\$?([\d,]+(?:\.\d+)?)\s*(billion|million|bn|mn|B|M)\b"
PERCENT = r"([\d,]+(?:\.\d+)?)\s*%"
YEAR = r"\b((?:19|20)\d{2})\b"
QUARTER = r"(?i)\b(Q[1-4])\s*(?:19|20)?\d{2}\b"
BILLION_UNITS = ("BILLION", "BN", "B")
MILLION_UNITS = ("MILLION", "MN", "M")
KPI_KEY = ("kpi_type", "value", "year", "ticker", "sentenceID")
KPI_COLUMNS = (
    "kpi_type", "value", "value_raw", "year", "confidence", "source_answer", "original_sentence", "sentenceID", "cik",
    "ticker", "company", "section", "docID", "reportDate",
)


# The words that tell kinds of figures apart stand in this function.
def kpi_type(text: Column) -> Column:
    """Kind of figure a text talks about, by the first group of words it contains."""
    low = F.lower(text)

    def has(*words: str) -> Column:
        return low.rlike("|".join(words))

    income = F.when(has("net"), "net_income").when(has("operating"), "operating_income").otherwise("income")
    margin = F.when(has("gross"), "gross_margin").when(has("operating"), "operating_margin").otherwise("margin")
    return (
        F.when(has("revenue", "sales", "turnover"), "revenue")
        .when(has("income", "earnings", "profit"), income)
        .when(has("ebitda"), "ebitda")
        .when(has("margin"), margin)
        .when(has("eps", "per share"), "eps")
        .otherwise("financial_metric")
    )


def extract_kpis(df: DataFrame, confidence: float = 0.5, answer_chars: int | None = None, sentence_chars: int | None = None) -> DataFrame:
    """One record per scaled amount in a sentence, with type, year and provenance.

    A unit counts also when it is glued to the number ("$2.5B"). The year is the first
    four-digit year of the sentence, else that of the report date. The whole sentence is
    searched and kept; a length cuts the text column of that name.
    """
    sentence = F.col("sentence")

    def text(chars: int | None) -> Column:
        return sentence if chars is None else F.left(sentence, F.lit(chars))

    amounts = df.select("*", F.explode(F.regexp_extract_all(sentence, F.lit(CURRENCY), F.lit(0))).alias("value_raw"))
    digits = F.replace(F.regexp_extract("value_raw", CURRENCY, 1), F.lit(","), F.lit(""))
    unit = F.upper(F.regexp_extract("value_raw", CURRENCY, 2))
    factor = F.when(unit.isin(*BILLION_UNITS), 1e9).when(unit.isin(*MILLION_UNITS), 1e6).otherwise(1.0)
    year = F.nullif(F.regexp_extract(sentence, YEAR, 1), F.lit(""))
    records = amounts.select(
        kpi_type(sentence).alias("kpi_type"),
        (digits.try_cast("double") * factor).alias("value"),
        "value_raw",
        F.coalesce(year, F.left("reportDate", F.lit(4)), F.lit("")).alias("year"),
        F.lit(confidence).alias("confidence"),
        text(answer_chars).alias("source_answer"),
        text(sentence_chars).alias("original_sentence"),
        "sentenceID", "cik",
        first_item(F.col("tickers")).alias("ticker"),
        F.col("name").alias("company"),
        "section", "docID", "reportDate",
    )
    return records.filter(F.col("value").isNotNull())  # a lone comma is no amount


def extract_marks(df: DataFrame) -> DataFrame:
    """Percent figures and quarters named in each sentence."""
    sentence = F.col("sentence")
    return df.select(
        "sentenceID", "sentence",
        F.regexp_extract_all(sentence, F.lit(PERCENT), F.lit(1)).alias("percents"),
        F.transform(F.regexp_extract_all(sentence, F.lit(QUARTER), F.lit(1)), F.upper).alias("quarters"),
    )


def dedupe_kpis(records: DataFrame) -> DataFrame:
    """One record per type, value, year, ticker and sentence; of several the first by raw text."""
    rest = [c for c in records.columns if c not in KPI_KEY]
    return first_by_key(records, list(KPI_KEY), ["value_raw", *[c for c in rest if c != "value_raw"]])


def kpi_distribution(records: DataFrame) -> DataFrame:
    """Per type: records and the range and mean of their confidence."""
    return records.groupBy("kpi_type").agg(
        F.count(F.lit(1)).alias("n_records"),
        round_half_away(F.avg("confidence"), 3).alias("mean_confidence"),
        F.min("confidence").alias("min_confidence"),
        F.max("confidence").alias("max_confidence"),
    )


def pack(df: DataFrame, order: Sequence[str], size: int = 12) -> DataFrame:
    """Sentences in blocks of ``size`` in the given order, each line tagged with its id and company."""
    numbered = global_row_number(df, order, "_n")
    ticker = F.coalesce(first_item(F.col("tickers")), F.lit(""))
    line = F.concat(
        F.lit("<<"), F.col("sentenceID"), F.lit(">> (Company: "), F.coalesce("name", F.lit("Unknown")),
        F.lit(", Ticker: "), ticker, F.lit(") "), F.trim(F.replace("sentence", F.lit("\n"), F.lit(" "))),
    )
    lines = numbered.select(F.floor((F.col("_n") - 1) / size).alias("pack"), "_n", line.alias("line"))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("_n", "line"))), lambda x: x["line"])
    return lines.groupBy("pack").agg(F.count(F.lit(1)).alias("n_sentences"), F.array_join(texts, "\n\n").alias("block"))
