"""Text measures, identifiers and column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Legal suffixes removed from the end of a company name.
NAME_SUFFIXES = r" INC\.?$| CORP\.?$| CO\.?$| LTD\.?$| LLC\.?$| PLC\.?$"
NAME_SUFFIXES_SHORT = r" INC\.?$| CORP\.?$| CO\.?$| /.*$"
# Date spellings accepted for report dates, tried in this order.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyyMMdd")
# Fixed value: the token pattern shared by the n-gram and near-duplicate jobs.
TOKEN_PATTERN = r"[a-z0-9%$.]+"


def char_count(text: Column) -> Column:
    return F.length(text).cast("bigint")


def blank_count(text: Column) -> Column:
    """Number of blanks plus one, the corpus' approximate word count."""
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1).cast("bigint")


def split_count(text: Column) -> Column:
    """Pieces after splitting at single blanks."""
    return F.size(F.split(text, " ", -1)).cast("bigint")


def word_count(text: Column) -> Column:
    """Runs of non-blank characters; null and blank text have none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("bigint")


def tokens(text: Column) -> Column:
    """Lower-case tokens of letters, digits, percent and dollar signs and points."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def ngrams(words: Column, n: int) -> Column:
    """Blank-joined runs of ``n`` neighbouring words; empty when there are fewer."""
    if n == 1:
        return words
    last = F.size(words) - n
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(words, i + 1, n), " "))
    return F.when(last >= 0, runs).otherwise(F.array().cast("array<string>"))


def shingles(words: Column, n: int) -> Column:
    """Runs of ``n`` words; shorter texts give the whole text, empty ones a single empty shingle."""
    return F.when(F.size(words) >= n, ngrams(words, n)).otherwise(F.array(F.array_join(words, " ")))


def padded_key(key: Column, width: int = 10) -> Column:
    return F.lpad(key.cast("string"), width, "0")


def normalise_name(name: Column, suffixes: str = NAME_SUFFIXES) -> Column:
    """Upper-case company name without its trailing legal form."""
    return F.upper(F.trim(F.regexp_replace(name, suffixes, "")))


def normalise_key(key: Column) -> Column:
    return F.upper(F.trim(key))


def parse_date(text: Column) -> Column:
    """First reading of ``text`` that succeeds among the accepted formats, null if none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS]).cast("date")


def row_hash(*parts: Column) -> Column:
    return F.md5(F.concat(*parts))


def upper_strings_where(df: DataFrame, condition: Column) -> DataFrame:
    """Upper-case every string column in the rows where ``condition`` holds."""
    names = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    hit = F.coalesce(condition, F.lit(False))
    return df.select(
        *[
            F.when(hit, F.upper(F.col(c))).otherwise(F.col(c)).alias(c) if c in names else F.col(c)
            for c in df.columns
        ]
    )


def distinct_texts(df: DataFrame, by: str, text: str) -> DataFrame:
    """Each different text of a group once, with its number of ``copies``."""
    return df.filter(F.col(text).isNotNull()).groupBy(by, text).agg(F.count(F.lit(1)).alias("copies"))
