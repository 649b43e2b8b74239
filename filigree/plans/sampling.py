"""Budgeted stratified sampling with a replayable order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filigree.functions.bins import THREE_BINS, Bin, iso_in_years, label_by_threshold, temporal_bin, year_span
from filigree.functions.numbers import percent, round_half_away
from filigree.functions.ordering import replay_hash, unit_interval
from filigree.functions.text import blank_count, char_count, row_hash
from filigree.operators.joins import broadcast_up_to, null_safe_join, semi, split_by_keys
from filigree.operators.numbering import global_row_number
from filigree.operators.windows import top_per_group
from filigree.session import cut_lineage

# Numbers first: the sort compares a number before it compares text.
STRATA = ("cik_int", "report_year", "section", "temporal_bin")

COVERAGE_STEPS = ((99, "complete"), (75, "high"), (50, "moderate"), (25, "light"), (0.0001, "sparse"))


def quality_predicate(first: int, last: int, min_chars: int = 10) -> Column:
    """Rows inside the year window with a section and a sentence of useful length."""
    return (
        iso_in_years(F.col("reportDate"), first, last)
        & F.col("section").isNotNull()
        & F.col("sentence").isNotNull()
        & (F.length("sentence") > min_chars)
    )


def tag_corpus(df: DataFrame, keys: DataFrame | None = None, bins: Sequence[Bin] = THREE_BINS) -> DataFrame:
    """Narrow, filtered corpus with year and temporal bin; ``keys`` restricts the companies."""
    first, last = year_span(bins)
    kept = df.filter(quality_predicate(first, last))
    if keys is not None:
        kept = semi(kept, keys, "cik_int")
    year = F.year(F.to_date("reportDate")).cast("bigint")
    return kept.select(
        "cik", "cik_int", "sentenceID", "section", "docID", "reportDate",
        year.alias("report_year"), temporal_bin(year, bins).alias("temporal_bin"),
    )


def bin_populations(tagged: DataFrame) -> DataFrame:
    """Rows, companies, filings and sections per bin.

    Rows are first collapsed to one per filing and section, so the distinct counts
    run over the small grain table and not over the corpus.
    """
    grain = tagged.groupBy("temporal_bin", "cik_int", "docID", "section").agg(F.count(F.lit(1)).alias("n"))
    return grain.groupBy("temporal_bin").agg(
        F.sum("n").alias("bin_population"),
        F.countDistinct("cik_int").alias("n_companies"),
        F.countDistinct("docID").alias("n_filings"),
        F.countDistinct("section").alias("n_sections"),
    )


def pivot_populations(populations: DataFrame, bins: Sequence[Bin] = THREE_BINS) -> DataFrame:
    """One row with the population of every bin as a column, and the total."""
    labels = [b.label for b in bins]
    wide = populations.groupBy().pivot("temporal_bin", labels).agg(F.sum("bin_population"))
    counts = [F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("bigint").alias(c) for c in labels]
    total = sum((F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in labels), F.lit(0)).cast("bigint")
    return wide.select(*counts, total.alias("total_population"))


def decide_allocation(
    populations: DataFrame, budget: int, bins: Sequence[Bin] = THREE_BINS, weights: Sequence[float] = (0.6, 0.4)
) -> DataFrame:
    """One row: targets of every bin.

    The newest bin is taken whole, or cut to the budget. What is left of the budget
    goes to the older bins by ``weights``, given from newer to older.
    """
    labels = [b.label for b in bins]
    newest, older = labels[-1], labels[-2::-1]
    if len(weights) != len(older):
        raise ValueError("one weight per older bin is needed")
    wide = pivot_populations(populations, bins)
    pop = F.col(newest)
    left = F.greatest(F.lit(0), F.lit(budget) - pop)
    targets = {newest: F.least(F.lit(budget), pop)}
    for label, weight in zip(older, weights):
        targets[label] = round_half_away(left * F.lit(float(weight))).cast("bigint")
    mode = F.when(pop >= budget, "newest_only").otherwise("newest_full_plus_older")
    return wide.select(
        F.lit(budget).cast("bigint").alias("target_budget"),
        "total_population",
        mode.alias("allocation_mode"),
        left.cast("bigint").alias("leftover_budget"),
        *[F.col(c).alias(f"{c}_pop") for c in labels],
        *[targets[c].cast("bigint").alias(f"{c}_target") for c in labels],
    )


def allocate(
    populations: DataFrame, budget: int, bins: Sequence[Bin] = THREE_BINS, weights: Sequence[float] = (0.6, 0.4)
) -> DataFrame:
    """One row per bin: target, population, sampling rate and priority (1 = newest)."""
    decided = decide_allocation(populations, budget, bins, weights)
    labels = [b.label for b in reversed(bins)]
    rows = [
        F.struct(
            F.lit(c).alias("temporal_bin"),
            F.col(f"{c}_target").alias("target_n"),
            F.col(f"{c}_pop").alias("population"),
            F.lit(i).cast("bigint").alias("priority_order"),
        )
        for i, c in enumerate(labels, 1)
    ]
    long = decided.select(F.inline(F.array(*rows)))
    return long.withColumn("sampling_rate_pct", percent(F.col("target_n"), F.col("population")))


def coverage_level(rate: Column) -> Column:
    return label_by_threshold(rate, COVERAGE_STEPS, "excluded")


def _quota(size: Column, target: Column, population: Column) -> Column:
    share = round_half_away(size * (target.cast("double") / population)).cast("bigint")
    return F.when(target >= population, size).otherwise(F.greatest(F.lit(1).cast("bigint"), share))


def stratified_sample(
    tagged: DataFrame, allocation: DataFrame, strata: Sequence[str] = STRATA, key: str = "sentenceID",
    seed: int = 42, hot_rows: int = 1_000_000,
) -> DataFrame:
    """Keys of the sample: per stratum the first ``quota`` rows by ``md5(seed|key)``.

    Strata up to ``hot_rows`` rows are ranked in one window, one shuffle for size and
    rank together. Larger strata would each be sorted by one task; they are cut by
    counted slices of the hash range instead (see ``take_by_slices``). Both give the
    same rows.
    """
    # One row per bin, so the broadcast is bounded by the number of bins.
    plan = F.broadcast(allocation.filter(F.col("target_n") > 0).select("temporal_bin", "target_n", "population"))
    rows = tagged.select(key, *strata).withColumn("_digest", replay_hash(seed, key)).join(plan, "temporal_bin")
    sizes = rows.groupBy(*strata, "target_n", "population").agg(F.count(F.lit(1)).alias("_size"))
    hot = sizes.filter(F.col("_size") > hot_rows)
    rate = percent(F.col("target_n"), F.col("population")).alias("sampling_rate_pct")
    output = [key, *strata, rate]

    def ranked(part: DataFrame) -> DataFrame:
        # One ordering for both columns, so that one sort serves size and rank.
        group = Window.partitionBy(*strata).orderBy("_digest", key)
        whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        numbered = part.withColumns(
            {"_size": F.count(F.lit(1)).over(whole), "_rank": F.row_number().over(group)}
        )
        wanted = _quota(F.col("_size"), F.col("target_n"), F.col("population"))
        return numbered.filter(F.col("_rank") <= wanted).select(*output)

    if hot.limit(1).count() == 0:
        return ranked(rows)
    # At most (total rows / hot_rows) strata are hot.
    names = hot.select(*strata)
    cold_rows = null_safe_join(rows, names, strata, "left_anti")
    hot_rows_ = null_safe_join(rows, hot.select(*strata, "_size"), strata)
    wanted = _quota(F.col("_size"), F.col("target_n"), F.col("population"))
    picked = take_by_slices(hot_rows_.withColumn("_take", wanted), strata, ["_digest", key], hot_rows)
    return ranked(cold_rows).unionByName(picked.select(*output))


def take_by_slices(rows: DataFrame, strata: Sequence[str], order: Sequence[str], slice_rows: int) -> DataFrame:
    """First ``_take`` rows of each large stratum by ``order``, whose first column is a hex digest.

    The digest range is cut into slices of about ``slice_rows`` rows. Counting rows per
    slice shows which slices are taken whole; only the slice where the quota ends is
    ranked. Copies in that slice (equal in all columns) are counted before ranking.
    """
    slices = F.ceil(F.col("_size") / F.lit(slice_rows)) * 4
    sliced = rows.withColumn("_slice", F.floor(unit_interval(F.col(order[0])) * slices))
    counted = sliced.groupBy(*strata, "_slice", "_take").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*strata).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        counted.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .filter((F.col("_before") < F.col("_take")) & (F.col("_take") <= F.col("_before") + F.col("_n")))
        .select(*strata, F.col("_slice").alias("_cut"), (F.col("_take") - F.col("_before")).alias("_need"))
    )
    placed = null_safe_join(sliced, cut, strata)
    whole = placed.filter(F.col("_slice") < F.col("_cut")).select(*rows.columns)
    edge = placed.filter(F.col("_slice") == F.col("_cut")).groupBy(*rows.columns, "_need")
    before = Window.partitionBy(*strata).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    partly = (
        edge.agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_done", F.coalesce(F.sum("_copies").over(before), F.lit(0)))
        .withColumn("_left", F.least(F.col("_copies"), F.col("_need") - F.col("_done")))
        .filter(F.col("_left") > 0)
        .select(*rows.columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_left"))).alias("_i"))
        .drop("_i")
    )
    return whole.unionByName(partly)


def sample_per_group(
    df: DataFrame, by: str, n: int, keys: Sequence[str], seed: int = 42, hot_rows: int = 1_000_000
) -> DataFrame:
    """At most ``n`` rows per group, the first by ``md5(seed|first key)`` and then by ``keys``.

    Groups above ``hot_rows`` rows are cut by counted slices of the hash range.
    """
    order = ["_digest", *keys]
    hashed = df.withColumn("_digest", replay_hash(seed, keys[0]))
    sizes = hashed.groupBy(by).agg(F.count(F.lit(1)).alias("_size"))
    hot = sizes.filter(F.col("_size") > hot_rows).withColumn("_take", F.least(F.col("_size"), F.lit(n)))
    if hot.limit(1).count() == 0:
        return top_per_group(hashed, [by], order, n, "_rn").select(*df.columns)
    cold = null_safe_join(hashed, hot.select(by), [by], "left_anti")
    picked = take_by_slices(null_safe_join(hashed, hot, [by]), [by], order, hot_rows)
    return top_per_group(cold, [by], order, n, "_rn").select(*df.columns).unionByName(picked.select(*df.columns))


def seeded_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows in replayable random order; Spark keeps only ``n`` rows per task."""
    return df.withColumn("_h", replay_hash(seed, key)).orderBy("_h", key).limit(n).drop("_h")


def join_back(
    ids: DataFrame, corpus: DataFrame, sections: DataFrame, version: str, source: str,
    key: str = "sentenceID", max_broadcast_bytes: int = 32 << 20,
) -> DataFrame:
    """Sampled ids with all corpus columns, section metadata, text measures and audit columns.

    Ids are broadcast only below a checked size, which spares shuffling the wide
    corpus; repeated ids are dropped first, so copies of a key cannot multiply rows. The
    distinct ids are written once, for the check and for the join.
    """
    wanted = cut_lineage(ids.select(key, "temporal_bin", "sampling_rate_pct").distinct())
    rows = split_by_keys(corpus, wanted, key, max_broadcast_bytes)[0].join(broadcast_up_to(wanted, max_broadcast_bytes), key)
    dim = sections.select(
        F.col("hf_section_code").alias("_code"),
        F.col("sec_item_canonical").alias("section_name"),
        F.col("section_name").alias("section_desc"),
        "section_category",
        F.col("priority").alias("sec_dim_priority"),
    )
    now = F.current_timestamp()
    return (
        rows.join(F.broadcast(dim), F.col("section") == F.col("_code"), "left")  # 21 rows
        .drop("_code")
        .withColumnRenamed("section", "section_ID")
        .withColumns(
            {
                "char_count": char_count(F.col("sentence")),
                "word_count_approx": blank_count(F.col("sentence")),
                "sample_created_at": now,
                "last_modified_date": now,
                "sample_version": F.lit(version),
                "source_file_path": F.lit(source),
                "load_method": F.lit("stratified_sampling"),
                "record_status": F.lit("complete"),
                "row_hash": row_hash(F.col(key), F.col("sentence")),
            }
        )
    )


def number_sample(sample: DataFrame) -> DataFrame:
    """Add ``sample_id`` in bin, date, company, section and sentence order."""
    order = ["temporal_bin", "reportDate", "cik", "section_ID", "sentenceID"]
    return global_row_number(sample, order, "sample_id")


def check_allocation(allocation: DataFrame, ids: DataFrame, budget: int) -> DataFrame:
    """Per bin: target, sampled rows, difference, coverage level and whether targets add up to the budget."""
    counts = ids.groupBy("temporal_bin").agg(F.count(F.lit(1)).alias("n_sampled"))
    whole = Window.partitionBy()  # one row per bin
    allocated = F.sum("target_n").over(whole)
    return (
        allocation.join(counts, "temporal_bin", "left")
        .withColumn("n_sampled", F.coalesce("n_sampled", F.lit(0)))
        .select(
            "temporal_bin", "population", "target_n", "sampling_rate_pct", "n_sampled",
            (F.col("n_sampled") - F.col("target_n")).alias("difference"),
            coverage_level(F.col("sampling_rate_pct")).alias("coverage_level"),
            allocated.cast("bigint").alias("total_allocated"),
            F.when(F.abs(allocated - budget) <= 100, "sums_to_budget").otherwise("rounding_error").alias("sum_check"),
        )
    )


def check_joinback(ids: DataFrame, sample: DataFrame, key: str = "sentenceID") -> DataFrame:
    """One row: ids selected against rows retrieved, and nulls in the audit columns."""
    chosen = ids.agg(F.count(F.lit(1)).alias("ids_selected"))

    def nulls(c: str) -> Column:
        return F.count_if(F.col(c).isNull()).alias(f"null_{c}")

    found = sample.agg(
        F.count(F.lit(1)).alias("rows_in_sample"),
        nulls("sample_created_at"), nulls("sample_version"), nulls("row_hash"), nulls("last_modified_date"),
    )
    lost = F.col("ids_selected") - F.col("rows_in_sample")
    return chosen.crossJoin(found).select(
        "*", lost.alias("lost_rows"), F.when(lost == 0, "complete").otherwise("rows_lost").alias("join_quality")
    )
