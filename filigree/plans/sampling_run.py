"""The whole sampling job: tag, allocate, sample, join back, inject, flag, export, validate, log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filigree.functions.bins import THREE_BINS, Bin
from filigree.plans import sampling as s
from filigree.plans.checks import validate_sample
from filigree.plans.features import add_flags
from filigree.plans.merge import inject, stage_increment
from filigree.plans.runlog import RunLog
from filigree.plans.sections import dim_sections
from filigree.session import cut_lineage
from filigree.sinks.writers import append_log, write_parquet


@dataclass(frozen=True)
class SamplingConfig:
    """Parameters of one run."""

    budget: int = 1_000_000
    bins: Sequence[Bin] = THREE_BINS
    weights: Sequence[float] = (0.6, 0.4)
    version: str = "v1"
    source: str = ""
    seed: int = 42
    recent_year: int = 2018
    placeholders: dict[str, Column] = field(default_factory=dict)


@dataclass(frozen=True)
class SamplingRun:
    """What a run leaves behind: the exported sample, its allocation, the checks and the step log."""

    sample: DataFrame
    allocation: DataFrame
    joinback: DataFrame
    report: DataFrame
    log: DataFrame


def run_sampling(
    spark: SparkSession, corpus: DataFrame, companies: DataFrame, out: str, config: SamplingConfig,
    increment: DataFrame | None = None, log_path: str | None = None,
) -> SamplingRun:
    """Run all steps; each stage is written once and read by the next.

    The join-back check compares ids and rows before an increment is injected, so
    injected rows cannot hide lost ones.
    """
    log = RunLog()
    log.add("INITIALIZATION", status="STARTED")
    sections = dim_sections(spark)
    tagged = cut_lineage(s.tag_corpus(corpus, companies, config.bins))
    log.add("CORPUS_LOAD", tagged.count())
    allocation = cut_lineage(s.allocate(s.bin_populations(tagged), config.budget, config.bins, config.weights))
    log.add("ALLOCATION", allocation.count())
    ids = cut_lineage(s.stratified_sample(tagged, allocation, seed=config.seed))
    log.add("SAMPLING", ids.count())
    joined = cut_lineage(s.join_back(ids, corpus, sections, config.version, config.source))
    joinback = cut_lineage(s.check_joinback(ids, joined))
    log.add("JOIN_BACK", joined.count(), joinback.first()["join_quality"])
    sample = s.number_sample(joined)
    if increment is not None:
        target = cut_lineage(sample)
        staged = cut_lineage(stage_increment(increment, sections, target, config.placeholders, config.source))
        sample = inject(target, staged)
        log.add("INJECTION", staged.count())
    write_parquet(add_flags(sample, recent_year=config.recent_year), out)
    exported = spark.read.parquet(out)
    log.add("EXPORT", exported.count(), out)
    expected = companies.select("cik_int").distinct().count()
    report = cut_lineage(validate_sample(exported, allocation, expected))
    log.add("VALIDATION", report.count())
    steps = log.frame(spark)
    if log_path:
        append_log(steps, log_path)
    return SamplingRun(exported, allocation, joinback, report, steps)


def report_problems(report: DataFrame) -> DataFrame:
    """Rows of a validation report whose status asks for a look."""
    fine = ("", "within_tolerance", "complete", "near_complete", "all_present", "no_nulls", "balanced", "valid", "all_mapped")
    return report.filter(~F.col("status").isin(*fine))
