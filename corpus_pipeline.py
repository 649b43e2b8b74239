"""From raw documents to token files: five stages, each one operator of ``filigree.llm``.

1. toxicity: documents that score 0.5 or more go;
2. SimHash near-duplicates: of each group the document with the smallest id stays;
3. benchmark decontamination: documents with a window of a test item go;
4. mix: sources are taken to their target sizes, documents dropped or repeated accordingly;
5. token files: the mix as token ids; the result is what reading the files back gives.

Every stage works on all rows the one before kept. Models learn from the documents the stage is given
and the labels of the folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from filigree.llm import decontaminate, mixing, simhash, token_files, toxicity
from filigree.llm.common import read, stage, vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.round_trip(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("source_mix", mix_sources),
    ("token_files", write_tokens),
]
ORACLE_SQL = None  # SQL can express neither the toxicity model nor the token files


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: ``doc_id, start, n_tokens, ids_crc32``, a row for each taken repetition."""
    docs = read(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
