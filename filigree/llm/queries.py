"""The registered queries of the subpackage and the SQL they are compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from filigree.llm import decontaminate, exact_dedup, fill_middle, langid, line_dedup, mixing, periodic_runs, pii, quality, simhash, token_counts, token_files, toxicity
from filigree.llm.common import read, vocabulary


def op1_simhash_pivots(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, folder, "labels")))


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return langid.identify(docs, langid.fit(docs))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, folder, "documents"))


def op5_fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_report(read(spark, folder, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return decontaminate.digest_columns(found)


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(read(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))


def op8_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents"))


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(read(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return pii.digest_columns(pii.find_pii(docs, pii.fit(docs)))


def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.digest_columns(fill_middle.fill_in_middle(read(spark, folder, "documents")))


def op12_quality_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(read(spark, folder, "documents")).drop("distance")


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    planted = periodic_runs.with_planted(read(spark, folder, "documents"))
    return periodic_runs.digest_columns(periodic_runs.find_runs(planted))


QUERIES = {
    "op1_simhash_pivots": op1_simhash_pivots,
    "op2_toxicity": op2_toxicity,
    "op3_language_id": op3_language_id,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_fuzzy_lines": op5_fuzzy_lines,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_token_counts": op7_token_counts,
    "op8_source_mix": op8_source_mix,
    "op9_token_files": op9_token_files,
    "op10_pii": op10_pii,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_quality_outliers": op12_quality_outliers,
    "op13_periodic_runs": op13_periodic_runs,
}
SQL = {
    "op4_exact_dedup": exact_dedup.SQL.strip(),
    "op6_benchmark_decontamination": decontaminate.SQL.strip(),
    "op8_source_mix": mixing.SQL.strip(),
    "op11_fill_in_middle": fill_middle.SQL.strip(),
    "op12_quality_outliers": quality.SQL.strip(),
}
