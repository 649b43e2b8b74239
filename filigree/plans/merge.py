"""Schema alignment, staged injection, keyed merges and their checks."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from filigree.functions.numbers import percent
from filigree.functions.text import blank_count, char_count, normalise_key, row_hash
from filigree.operators.joins import broadcast_up_to
from filigree.operators.keyed import dedupe_last, upsert
from filigree.operators.numbering import append_numbers
from filigree.sinks.versions import VersionedTable
from filigree.sinks.writers import append_log
from filigree.sources.readers import read_csv_log

# Incoming names and what they are called in the base, columns that the base
# does not have, and columns that can be computed instead of read.
RENAMES = {"SIC": "sic", "section_item": "section_name"}
DROPPED = ("sentence_index",)
DERIVED = ("cik_int", "has_comparison", "has_numbers", "likely_kpi", "row_hash", "tickers", "sentence_index")


def rename_incoming(df: DataFrame, renames: dict[str, str] = RENAMES, dropped: Sequence[str] = DROPPED) -> DataFrame:
    """Apply the name map; an incoming column that already has a mapped name gives way."""
    present = {old: new for old, new in renames.items() if old in df.columns}
    shadowed = [new for new in present.values() if new in df.columns and new not in present]
    return df.drop(*shadowed, *dropped).withColumnsRenamed(present)


def normalise_times(df: DataFrame) -> DataFrame:
    """Zone-less timestamps become UTC instants."""
    naive = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampNTZType)]
    return df.withColumns({c: F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(c)).cast("timestamp") for c in naive})


def align_to(df: DataFrame, base: StructType) -> DataFrame:
    """Columns of ``base`` in its order and types; missing ones and values that do not fit the type are null."""
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in base.fields
        ]
    )


def malformed_values(df: DataFrame, base: StructType) -> DataFrame:
    """``(column_name, n_malformed)``: how many values of each shared column ``align_to`` turns into null."""
    shared = [f for f in base.fields if f.name in df.columns]
    lost = [F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name) for f in shared]
    pairs = [F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("n_malformed")) for f in shared]
    return df.agg(*lost).select(F.inline(F.array(*pairs)))


def extra_columns(df: DataFrame, base: StructType) -> list[str]:
    """Columns that ``align_to`` would drop."""
    return [c for c in df.columns if c not in base.fieldNames()]


def add_derived(df: DataFrame) -> DataFrame:
    """Integer company key and row hash; feature and company columns stay null until computed."""
    return df.withColumns(
        {"cik_int": F.col("cik").try_cast("int"), "row_hash": row_hash(F.col("sentenceID"), F.col("sentence"))}
    )


def name_matches(name: Column, patterns: Sequence[str]) -> Column:
    """Whether the upper-cased name contains one of ``patterns``."""
    hit = F.lit(False)
    for p in patterns:
        hit = hit | F.contains(F.upper(name), F.lit(p))
    return hit


def company_placeholders(
    known: Column, tickers: Sequence[str], exchanges: Sequence[str], state: str
) -> dict[str, Column]:
    """Company metadata for rows that come without it: the given values where ``known``, else review marks."""

    def texts(values: Sequence[str]) -> Column:
        return F.array(*[F.lit(v) for v in values])

    return {
        "tickers": F.when(known, texts(tickers)).otherwise(texts(["MANUAL_REVIEW_REQ"])),
        "exchanges": F.when(known, texts(exchanges)).otherwise(texts(["EXCHANGE_UNKNOWN"])),
        "stateOfIncorporation": F.when(known, F.lit(state)).otherwise(F.lit("XX")),
        "tickerCount": F.when(known, F.lit(len(tickers))).otherwise(F.lit(1)),
        "entityType": F.lit("operating"),
    }


def stage_increment(
    src: DataFrame, dim: DataFrame, target: DataFrame, placeholders: dict[str, Column], source: str,
    enabled: bool = True,
) -> DataFrame:
    """Incoming rows in the target's schema with new ids, section metadata and status ``staged``.

    With ``enabled`` false the result has no rows, and nothing is read.
    """
    if not enabled:
        return target.sparkSession.createDataFrame([], target.schema)
    sections = dim.select(
        normalise_key(F.col("sec_item_canonical")).alias("_item"), F.col("section_name").alias("section_desc"),
        "section_category", F.col("priority").alias("sec_dim_priority"),
    )
    item = "section_item" if "section_item" in src.columns else "section_name"
    every = Window.orderBy(*sections.columns)  # some twenty rows
    sections = sections.withColumn("_no", F.row_number().over(every))
    found = src.drop("sample_id").join(F.broadcast(sections.select("_item", "_no")), normalise_key(F.col(item)) == F.col("_item"), "left").drop("_item")
    # Numbered before it is filled, so that what can be computed from a row is not moved with it.
    numbered = append_numbers(target, rename_incoming(found), "sample_id", ["report_year", "sentenceID"])
    filled = numbered.join(F.broadcast(sections.drop("_item")), "_no", "left").drop("_no").withColumns(
        {
            **placeholders,
            "sec_dim_priority": F.coalesce("sec_dim_priority", F.lit("P3")),
            "cik_int": F.col("cik").try_cast("int"),
            "acceptanceDateTime": F.concat(F.col("filingDate"), F.lit("T00:00:00.000Z")),
            "char_count": char_count(F.col("sentence")),
            "word_count_approx": blank_count(F.col("sentence")),
            "row_hash": row_hash(F.col("sentenceID"), F.col("sentence")),
            "load_method": F.lit("incremental_inject"),
            "record_status": F.lit("staged"),
            "source_file_path": F.lit(source),
        }
    )
    return align_to(filled, target.schema)


def inject(target: DataFrame, staged: DataFrame, key: str = "sentenceID") -> DataFrame:
    """Upsert staged rows and mark them injected."""
    done = F.when(F.col("load_method") == "incremental_inject", "injected").otherwise(F.col("record_status"))
    return upsert(target, staged, key).withColumn("record_status", done)


@dataclass
class MergeStats:
    """What one merge read and wrote."""

    merge_type: str
    base_rows: int
    incr_rows: int
    final_rows: int
    duplicates_removed: int
    year_min: int | None = None
    year_max: int | None = None
    companies: int | None = None
    extra_columns: list[str] = field(default_factory=list)
    duration_sec: float = 0.0
    version: int | None = None


class MergeRejected(RuntimeError):
    """The merged table broke a gate; nothing was published."""


def gate_facts(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, null keys and repeated keys of a merged table."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("final_rows"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count_if((F.col("n") > 1) & F.col(key).isNotNull()).alias("repeated_keys"),
    )


def check_merge(df: DataFrame, key: str, input_rows: int) -> Row:
    """Raise ``MergeRejected`` unless rows fit the inputs, no key is null and every key is unique."""
    facts = gate_facts(df, key).first()
    if facts["final_rows"] > input_rows:
        raise MergeRejected(f"{facts['final_rows']} rows from {input_rows} inputs")
    if facts["null_keys"]:
        raise MergeRejected(f"{facts['null_keys']} rows without key")
    if facts["repeated_keys"]:
        raise MergeRejected(f"{facts['repeated_keys']} repeated keys")
    return facts


def aligned_increment(base: DataFrame, increment: DataFrame) -> DataFrame:
    """The increment in the columns, names and types of the base."""
    return align_to(normalise_times(rename_incoming(increment)), base.schema)


def merged_rows(
    base: DataFrame, increment: DataFrame, key: str, tie_break: Sequence[str], base_is_unique: bool = False,
    max_broadcast_bytes: int = 32 << 20,
) -> DataFrame:
    """Base and aligned increment with one row per key; the increment wins.

    A base that is known to have unique keys is not grouped again: rows whose key the
    increment brings are left out, and as long as the increment's keys are few enough to
    broadcast, which is counted, the base is not shuffled at all.
    """
    aligned = aligned_increment(base, increment)
    if not base_is_unique:
        return dedupe_last([base, aligned], [key], tie_break)
    newest = dedupe_last([aligned], [key], tie_break)
    replaced = broadcast_up_to(newest.select(key), max_broadcast_bytes)
    return base.join(replaced, key, "left_anti").select(*base.columns).unionByName(newest)


def preflight(inputs: dict[str, DataFrame], key: str) -> None:
    """Raise ``MergeRejected`` before any work unless every input is readable, has the key and has rows."""
    for name, df in inputs.items():
        if key not in df.columns:
            raise MergeRejected(f"{name} has no column {key}")
        if df.select(key).isEmpty():
            raise MergeRejected(f"{name} has no rows")


def merge_parts(spark: SparkSession, increment: DataFrame, out: VersionedTable, key: str, tie_break: Sequence[str]) -> tuple[int, int, int]:
    """Merge into a table written by partition, rewriting only the partitions the increment falls into.

    Returns the staged version and the rows of the replaced partitions before and after. The gates
    read the new partitions; the others have passed them before. The increment's keys are looked for
    in the other partitions, of which only the key column is read: a key that is found there breaks
    the rule that the key determines the partition, and the merge is rejected.
    """
    newest = out.versions(spark)[-1]
    current = out.read_version(spark, newest)
    aligned = aligned_increment(current, increment)
    touched = out.touched(aligned)
    base = current.where(touched)
    astray = current.where(~F.coalesce(touched, F.lit(False))).join(broadcast_up_to(aligned.select(key).distinct(), 32 << 20), key, "left_semi")
    if not astray.isEmpty():
        raise MergeRejected(f"keys of the increment lie in other partitions of {out.by}")
    version = out.stage(merged_rows(base, increment, key, tie_break, base_is_unique=True), over=newest)
    before = base.count()
    try:
        facts = check_merge(out.read_version(spark, version, own=True), key, before + aligned.count())
    except MergeRejected:
        out.discard(spark, version)
        raise
    return version, before, int(facts["final_rows"])


# The columns of the merge log, in order.
HISTORY = "run_at timestamp, merge_type string, base_rows bigint, incr_rows bigint, final_rows bigint, duplicates_removed bigint, year_min bigint, year_max bigint, companies bigint, extra_columns string, duration_sec double, version bigint, status string"


def merge_history(spark: SparkSession, path: str) -> DataFrame:
    """All logged merges."""
    return read_csv_log(spark, path, HISTORY)


def _log(spark: SparkSession, stats: MergeStats, path: str, status: str) -> None:
    row = (datetime.now(timezone.utc), stats.merge_type, stats.base_rows, stats.incr_rows, stats.final_rows, stats.duplicates_removed, stats.year_min, stats.year_max, stats.companies, ",".join(stats.extra_columns), stats.duration_sec, stats.version, status)
    append_log(spark.createDataFrame([row], HISTORY), path)


def merge_job(
    spark: SparkSession, historical: DataFrame, increment: DataFrame, out: VersionedTable, key: str,
    tie_break: Sequence[str], year: str | None = None, company: str | None = None, sort: Sequence[str] = (),
    history: str | None = None,
) -> MergeStats:
    """Merge an increment into the newest version, or into ``historical`` on the first run.

    A published version has passed the gates, so its keys are unique and it is merged
    without grouping it again; a table with partitions rewrites only those the increment falls
    into. The merged rows are written once to a new, unpublished version; the gates read that
    version, and only then is it published. A failed gate removes it and leaves the old version
    current. With ``history`` a row is added to the log at that path.
    """
    start = time.time()
    current = out.read(spark)
    base = historical if current is None else current
    kind = "initial_bootstrap" if current is None else "incremental_update"
    extra = extra_columns(rename_incoming(increment), base.schema)
    base_rows, incr_rows = base.count(), increment.count()
    stats = MergeStats(kind, base_rows, incr_rows, base_rows, incr_rows, extra_columns=extra)
    try:
        if out.by and current is not None:
            version, before, after = merge_parts(spark, increment, out, key, tie_break)
            final = base_rows - before + after
        else:
            merged = merged_rows(base, increment, key, tie_break, base_is_unique=current is not None)
            if sort:
                merged = merged.repartitionByRange(*[F.col(c) for c in sort]).sortWithinPartitions(*sort)
            version = out.stage(merged)
            try:
                final = int(check_merge(out.read_version(spark, version), key, base_rows + incr_rows)["final_rows"])
            except MergeRejected:
                out.discard(spark, version)
                raise
    except MergeRejected:
        if history:
            _log(spark, stats, history, "rejected")
        raise
    stats.final_rows, stats.duplicates_removed, stats.version = final, base_rows + incr_rows - final, version
    wanted = [F.min(year).alias("lo"), F.max(year).alias("hi")] if year else []
    wanted += [F.countDistinct(company).alias("companies")] if company else []
    if wanted:
        summary = out.read_version(spark, version).agg(*wanted).first().asDict()
        stats.year_min, stats.year_max = summary.get("lo"), summary.get("hi")
        stats.companies = summary.get("companies")
    out.publish(spark, version)
    stats.duration_sec = round(time.time() - start, 2)
    if history:
        _log(spark, stats, history, "published")
    return stats


def project_merge(historical: DataFrame, increment: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct keys and inner duplicates of both inputs, overlap and expected output.

    Both key sets are counted in one aggregate by key, without an intersect.
    """
    both = historical.select(key, F.lit(1).alias("h"), F.lit(0).alias("i")).unionByName(
        increment.select(key, F.lit(0).alias("h"), F.lit(1).alias("i"))
    )
    sides = both.groupBy(key).agg(F.sum("h").alias("h"), F.sum("i").alias("i"))
    facts = sides.agg(
        F.sum("h").alias("hist_rows"),
        F.count_if(F.col("h") > 0).alias("hist_keys"),
        F.sum("i").alias("incr_rows"),
        F.count_if(F.col("i") > 0).alias("incr_keys"),
        F.count_if((F.col("h") > 0) & (F.col("i") > 0)).alias("overlap"),
        F.count(F.lit(1)).alias("expected_rows"),
    )
    removed = F.col("hist_rows") + F.col("incr_rows") - F.col("expected_rows")
    inner = (F.col("hist_rows") > F.col("hist_keys")) | (F.col("incr_rows") > F.col("incr_keys"))
    return facts.select(
        "*", removed.alias("rows_to_remove"),
        F.when(inner, "inner_duplicates").otherwise("clean").alias("verdict"),
    )


def reingest_impact(
    df: DataFrame, company: Column, year: Column, kept_sections: Column, key: str = "sentenceID"
) -> DataFrame:
    """What is lost when a partial re-ingest deletes by company and year instead of by key.

    Per action: rows and sections; ``lost_by_coarse_delete`` are the rows that the
    coarse delete removes although the new data does not bring them back.
    """
    scope = df.filter(company & year)
    incoming = scope.filter(kept_sections).select(key).distinct().withColumn("_new", F.lit(True))
    marked = scope.join(incoming, key, "left")
    action = F.when(F.col("_new"), "replaced").otherwise("lost_by_coarse_delete")
    return marked.groupBy(action.alias("action")).agg(
        F.count(F.lit(1)).alias("n_sentences"), F.countDistinct("section").alias("n_sections")
    )


def data_loss(impact: DataFrame) -> DataFrame:
    """One row from ``reingest_impact``: sentences before, brought again, lost, and the share lost."""
    n = F.col("n_sentences")
    facts = impact.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("original_total"),
        F.coalesce(F.sum(F.when(F.col("action") == "replaced", n)), F.lit(0)).alias("new_data_sentences"),
        F.coalesce(F.sum(F.when(F.col("action") != "replaced", n)), F.lit(0)).alias("lost_sentences"),
    )
    return facts.withColumn("pct_data_lost", percent(F.col("lost_sentences"), F.col("original_total"), 1))
