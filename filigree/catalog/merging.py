"""Registered queries: schema checks, staged injection, merges and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from filigree.catalog.registry import Catalog
from filigree.operators.aggregates import long_form
from filigree.operators import schemas as sc
from filigree.operators.keyed import dedupe_last
from filigree.operators.numbering import key_ranges
from filigree.plans import merge as m
from filigree.plans.sections import dim_sections
from filigree.session import fresh_path
from filigree.sinks.versions import VersionedTable
from filigree.sources.fixture_sql import EVENTS_SPLIT, SENTENCES, on_sentences, with_views
from filigree.catalog.sampling import UNIQUE, section_values, unique_sentences

catalog = Catalog()

MERGED = """merged AS (
  SELECT event_id, ts, user_id, event_type, value, props FROM (
    SELECT *, 0 AS src FROM base UNION ALL SELECT *, 1 FROM incr)
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY src DESC, ts DESC) = 1)"""


@catalog.query(
    "p9_dedupe_later_input_wins",
    with_views("\nSELECT event_id, user_id, value FROM merged", EVENTS_SPLIT, MERGED),
)
def _(t):
    return dedupe_last([t.base_events, t.increment_events], ["event_id"], ["ts"]).select("event_id", "user_id", "value")


@catalog.query(
    "p9_dedupe_sentences",
    on_sentences("""SELECT sentenceID, sentence, docID FROM sentences
QUALIFY row_number() OVER (PARTITION BY sentenceID ORDER BY sentence DESC, docID DESC) = 1"""),
)
def _(t):
    rows = t.sentences.select("sentenceID", "sentence", "docID")
    kept = dedupe_last([rows], ["sentenceID"], ["sentence", "docID"])
    return kept.select("sentenceID", "sentence", "docID")


@catalog.query(
    "p8_merge_into_partitions",
    with_views("\nSELECT event_id, user_id, event_type, value FROM merged", EVENTS_SPLIT, MERGED),
)
def _(t):
    """The base in ranges of a thousand keys or more, the increment merged into those it falls into."""
    part = key_ranges(t.events, "event_id")
    out = VersionedTable(fresh_path(t.spark, "merge-parts"), by="part")
    base = t.base_events.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("part", part)
    m.merge_job(t.spark, base, base.limit(0), out, "event_id", ["ts"])
    m.merge_job(t.spark, base, t.increment_events.withColumn("part", part), out, "event_id", ["ts"])
    return out.read(t.spark).select("event_id", "user_id", "event_type", "value")


@catalog.query(
    "p8_merge_history",
    with_views(
        """
SELECT * FROM (VALUES ('initial_bootstrap', 'published', (SELECT count(*) FROM base), (SELECT count(*) FROM incr), (SELECT count(*) FROM merged)),
  ('incremental_update', 'published', (SELECT count(*) FROM merged), (SELECT count(*) FROM incr), (SELECT count(*) FROM merged)))
  AS v(merge_type, status, base_rows, incr_rows, final_rows)""",
        EVENTS_SPLIT,
        MERGED,
    ),
)
def _(t):
    """The log of two merges."""
    out, log = VersionedTable(fresh_path(t.spark, "merge")), fresh_path(t.spark, "merge-log")
    base = t.base_events.withColumn("ts", F.col("ts").cast("timestamp"))
    for _ in range(2):
        m.merge_job(t.spark, base, t.increment_events, out, "event_id", ["ts"], history=log)
    return m.merge_history(t.spark, log).select("merge_type", "status", "base_rows", "incr_rows", "final_rows")


@catalog.query(
    "p8_merge_job",
    with_views(
        "\nSELECT event_id, user_id, event_type, value FROM merged",
        EVENTS_SPLIT,
        MERGED,
    ),
)
def _(t):
    """Bootstrap from the base, then a second run over the published version; the result must not change."""
    out = VersionedTable(fresh_path(t.spark, "merge"), max_versions=2)
    base = t.base_events.withColumn("ts", F.col("ts").cast("timestamp"))
    increment = t.increment_events
    first = m.merge_job(t.spark, base, increment, out, "event_id", ["ts"], sort=["event_id"])
    second = m.merge_job(t.spark, base, increment, out, "event_id", ["ts"], sort=["event_id"])
    if (first.merge_type, second.merge_type) != ("initial_bootstrap", "incremental_update"):
        raise RuntimeError("the second run must start from the published version")
    return out.read(t.spark).select("event_id", "user_id", "event_type", "value")


@catalog.query(
    "p10_merge_gate_facts",
    with_views(
        """
SELECT CAST(sum(n) AS BIGINT) AS final_rows, CAST(coalesce(sum(CASE WHEN event_id IS NULL THEN n END), 0) AS BIGINT) AS null_keys,
  count(CASE WHEN n > 1 AND event_id IS NOT NULL THEN 1 END) AS repeated_keys
FROM (SELECT event_id, count(*) AS n FROM (SELECT event_id FROM base UNION ALL SELECT event_id FROM incr) GROUP BY event_id)""",
        EVENTS_SPLIT,
    ),
)
def _(t):
    both = t.base_events.select("event_id").unionByName(t.increment_events.select("event_id"))
    return m.gate_facts(both, "event_id")


@catalog.query(
    "p13_merge_projection",
    with_views(
        """,
h AS (SELECT user_id AS k FROM base), i AS (SELECT user_id AS k FROM incr)
SELECT (SELECT count(*) FROM h) AS hist_rows, (SELECT count(DISTINCT k) FROM h) AS hist_keys, (SELECT count(*) FROM i) AS incr_rows,
  (SELECT count(DISTINCT k) FROM i) AS incr_keys, (SELECT count(*) FROM (SELECT k FROM h INTERSECT SELECT k FROM i)) AS overlap,
  (SELECT count(*) FROM (SELECT k FROM h UNION SELECT k FROM i)) AS expected_rows,
  (SELECT count(*) FROM h) + (SELECT count(*) FROM i) - (SELECT count(*) FROM (SELECT k FROM h UNION SELECT k FROM i)) AS rows_to_remove,
  'inner_duplicates' AS verdict""",
        EVENTS_SPLIT,
    ),
)
def _(t):
    return m.project_merge(t.base_events, t.increment_events, "user_id")


SCHEMA_COMPARED = """SELECT 'sic' AS column_name, 'match' AS status, (SELECT count(sic) FROM sentences) AS n_left, (SELECT count(sic) FROM sentences) AS n_right
UNION ALL SELECT 'section_name', 'match', (SELECT count(*) FROM sentences), (SELECT count(*) FROM sentences)
UNION ALL SELECT 'report_year', 'type_difference', (SELECT count(report_year) FROM sentences), (SELECT count(report_year) FROM sentences)
UNION ALL SELECT 'tickers', 'derived', (SELECT count(tickers) FROM sentences), NULL
UNION ALL SELECT 'reportDate', 'time_precision', (SELECT count(*) FROM sentences), (SELECT count(*) FROM sentences)
UNION ALL SELECT 'sentence_index', 'derived', NULL, (SELECT count(*) FROM sentences)
UNION ALL SELECT 'extra', 'right_only', NULL, (SELECT count(*) FROM sentences)
UNION ALL SELECT 'docID', 'left_only', (SELECT count(*) FROM sentences), NULL"""


def two_schemas(t):
    """A base table and an incoming one with other names, types and columns."""
    s = t.sentences
    item = F.concat(F.lit("ITEM_"), F.col("section"))
    left = s.select(
        "sic", item.alias("section_name"), "report_year", "tickers", F.col("reportDate").cast("timestamp").alias("reportDate"), "docID"
    )
    right = s.select(
        F.col("sic").alias("SIC"), item.alias("section_item"), F.lit("x").alias("section_name"),
        F.col("report_year").cast("string").alias("report_year"), F.col("reportDate").cast("timestamp_ntz").alias("reportDate"),
        F.lit(1).alias("sentence_index"), F.lit(1).alias("extra"),
    )
    return left, right


def filled(df, side):
    """Filled rows by column."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return long_form(counts, "column_name", side, df.columns, "bigint")


@catalog.query("p11_schema_comparison_with_fill", on_sentences(SCHEMA_COMPARED))
def _(t):
    """Schema comparison, with the filled rows of each column on both sides."""
    left, right = two_schemas(t)
    compared = sc.compare_schemas(left, right, m.RENAMES, m.DERIVED)
    renamed = m.rename_incoming(right, dropped=())
    return (
        compared.join(filled(left, "n_left"), "column_name", "left")
        .join(filled(renamed, "n_right"), "column_name", "left")
        .select("column_name", "status", "n_left", "n_right")
    )


@catalog.query(
    "p11_schema_verdict_with_rows",
    on_sentences("""SELECT 6::BIGINT AS left_columns, 6::BIGINT AS right_columns, 2::BIGINT AS matching, 1::BIGINT AS left_only, 1::BIGINT AS right_only,
  2::BIGINT AS derived, 2::BIGINT AS type_differences, 3::BIGINT AS critical_issues, 'needs_attention' AS verdict,
  count(sic) + count(report_year) + count(tickers) + 3 * count(*) AS left_values, count(sic) + count(report_year) + 5 * count(*) AS right_values FROM sentences"""),
)
def _(t):
    """The verdict on both schemas beside the values that both tables hold."""
    left, right = two_schemas(t)
    verdict = sc.schema_verdict(sc.compare_schemas(left, right, m.RENAMES, m.DERIVED))
    for df, side in ((left, "left_values"), (right, "right_values")):
        verdict = verdict.crossJoin(F.broadcast(filled(df, "n").agg(F.sum("n").alias(side))))  # one row
    return verdict


@catalog.query(
    "p12_required_columns_with_rows",
    on_sentences("""SELECT 'docID' AS column_name, TRUE AS in_left, FALSE AS in_right, 'one' AS status, count(docID) AS n_left, NULL::BIGINT AS n_right FROM sentences
UNION ALL SELECT 'reportDate', TRUE, TRUE, 'both', count(reportDate), count(reportDate) FROM sentences
UNION ALL SELECT 'form', FALSE, FALSE, 'none', NULL, NULL"""),
)
def _(t):
    """Required columns, where they are, and how many rows have them filled."""
    left, right = two_schemas(t)
    checked = sc.check_required(["docID", "reportDate", "form"], left, right)
    return checked.join(filled(left, "n_left"), "column_name", "left").join(filled(right, "n_right"), "column_name", "left")


TARGET = f"""target AS (
  SELECT row_number() OVER (ORDER BY report_year, sentenceID) AS sample_id, cik, sentence, section AS section_ID, d.item AS section_name,
    d.title AS section_desc, d.category AS section_category, d.priority AS sec_dim_priority, filingDate, uniq.name, docID, sentenceID,
    tickers, 'NY' AS stateOfIncorporation, sic, report_year, length(sentence) AS char_count,
    md5(sentenceID || sentence) AS row_hash, 'stratified_sampling' AS load_method, 'complete' AS record_status
  FROM uniq LEFT JOIN dim d ON section = d.code WHERE report_year <= 1999)"""
STAGED = """staged AS (
  SELECT (SELECT coalesce(max(sample_id), 0) FROM target) + row_number() OVER (ORDER BY report_year, sentenceID) AS sample_id, cik, sentence,
    section AS section_ID, 'ITEM_' || section AS section_name, d.title AS section_desc, d.category AS section_category,
    coalesce(d.priority, 'P3') AS sec_dim_priority, filingDate, uniq.name, docID, sentenceID,
    CASE WHEN contains(upper(uniq.name), '77') THEN ['T77', 'T77.A'] ELSE ['MANUAL_REVIEW_REQ'] END AS tickers,
    CASE WHEN contains(upper(uniq.name), '77') THEN 'DE' ELSE 'XX' END AS stateOfIncorporation, sic, report_year, length(sentence) AS char_count,
    md5(sentenceID || sentence) AS row_hash, 'incremental_inject' AS load_method, 'staged' AS record_status
  FROM uniq LEFT JOIN dim d ON upper(trim('ITEM_' || section)) = upper(trim(d.item)) WHERE report_year >= 1999)"""
STAGE_COLUMNS = (
    "sample_id", "cik", "section_ID", "section_name", "section_desc", "section_category", "sec_dim_priority", "filingDate",
    "name", "docID", "sentenceID", "tickers_text", "stateOfIncorporation", "sic", "report_year", "char_count", "row_hash",
    "load_method", "record_status",
)
STAGE_SELECT = ", ".join("array_to_string(tickers, ',') AS tickers_text" if c == "tickers_text" else c for c in STAGE_COLUMNS)


def target_and_staged(t):
    """Filings to 1999 as the target; those from 1999 on arrive as an increment."""
    from filigree.functions.text import char_count, row_hash
    from filigree.operators.numbering import global_row_number
    from filigree.plans.sections import map_sections
    from filigree.session import cut_lineage, drop_stage

    rows = cut_lineage(unique_sentences(t))
    dim = dim_sections(t.spark)
    kept = ("cik", "sentence", "section", "filingDate", "name", "docID", "sentenceID", "tickers", "sic", "report_year")
    old = rows.filter(F.col("report_year") <= 1999).select(*kept)
    numbered = global_row_number(old, ["report_year", "sentenceID"], "sample_id")
    target = map_sections(numbered, dim.withColumnRenamed("section_name", "section_desc")).select(
        "sample_id", "cik", "sentence", F.col("section").alias("section_ID"), F.col("sec_item_canonical").alias("section_name"),
        "section_desc", "section_category", F.col("priority").alias("sec_dim_priority"), "filingDate", "name", "docID",
        "sentenceID", "tickers", F.lit("NY").alias("stateOfIncorporation"), "sic", "report_year",
        char_count(F.col("sentence")).alias("char_count"), row_hash(F.col("sentenceID"), F.col("sentence")).alias("row_hash"),
        F.lit("stratified_sampling").alias("load_method"), F.lit("complete").alias("record_status"),
    )
    incoming = rows.filter(F.col("report_year") >= 1999).select(
        "cik", "sentence", F.col("section").alias("section_ID"), F.concat(F.lit("ITEM_"), F.col("section")).alias("section_item"),
        "filingDate", "name", "docID", "sentenceID", F.col("sic").alias("SIC"), "report_year",
    )
    known = m.name_matches(F.col("name"), ["77"])
    filled = m.company_placeholders(known, ["T77", "T77.A"], ["NASDAQ"], "DE")
    staged = m.stage_increment(incoming, dim, target, filled, "increment")
    drop_stage(rows)
    return target, staged


def staged_columns(df):
    return df.withColumn("tickers_text", F.array_join("tickers", ",")).select(*STAGE_COLUMNS)


@catalog.query(
    "p6_staged_injection",
    with_views(f"\nSELECT {STAGE_SELECT} FROM staged", SENTENCES, UNIQUE, section_values(), TARGET, STAGED),
)
def _(t):
    return staged_columns(target_and_staged(t)[1])


@catalog.query(
    "p6_p7_injected_target",
    with_views(
        f"""
SELECT {STAGE_SELECT} FROM (SELECT * FROM target WHERE sentenceID NOT IN (SELECT sentenceID FROM staged)
  UNION ALL SELECT * REPLACE ('injected' AS record_status) FROM staged)""",
        SENTENCES, UNIQUE, section_values(), TARGET, STAGED,
    ),
)
def _(t):
    target, staged = target_and_staged(t)
    return staged_columns(m.inject(target, staged))


@catalog.query(
    "p28_reingest_impact",
    on_sentences("""SELECT action, count(*) AS n_sentences, count(DISTINCT section) AS n_sections FROM (
  SELECT section, CASE WHEN section IN (0, 8, 10) THEN 'replaced' ELSE 'lost_by_coarse_delete' END AS action
  FROM sentences WHERE sic = 'BUILDING' AND report_year = 1998) GROUP BY action"""),
)
def _(t):
    return m.reingest_impact(
        t.sentences, F.col("sic") == "BUILDING", F.col("report_year") == 1998, F.col("section").isin(0, 8, 10)
    )


@catalog.query(
    "p28_data_loss",
    on_sentences("""SELECT count(*) AS original_total, count(CASE WHEN section IN (0, 8, 10) THEN 1 END) AS new_data_sentences,
  count(CASE WHEN section NOT IN (0, 8, 10) THEN 1 END) AS lost_sentences,
  round(count(CASE WHEN section NOT IN (0, 8, 10) THEN 1 END) * 100.0 / count(*), 1) AS pct_data_lost FROM sentences"""),
)
def _(t):
    """The calculation when the whole corpus is delivered again with three sections only."""
    everything = F.lit(True)
    return m.data_loss(m.reingest_impact(t.sentences, everything, everything, F.col("section").isin(0, 8, 10)))
