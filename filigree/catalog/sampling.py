"""Registered queries: tagging, allocation, stratified sampling, join-back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filigree.catalog.registry import Catalog
from filigree.functions.numbers import percent
from filigree.operators.joins import anti
from filigree.operators.keyed import first_of_repeated
from filigree.plans import sampling as s
from filigree.plans.sections import dim_sections
from filigree.plans.subsets import read_share, write_shares
from filigree.session import cut_lineage, drop_stage, fresh_path
from filigree.sources.fixture_sql import SENTENCES, bin_case, with_views
from filigree.sources.fixtures import THREE, Tables

catalog = Catalog()

BUDGET = 40_000
SEED = 42

KEYS = "keys AS (SELECT c_custkey AS cik_int FROM customer WHERE c_mktsegment <> 'FURNITURE')"
# Copies of a sentence id are equal in all columns that the sample keeps.
UNIQUE = """uniq AS (
  SELECT * FROM sentences
  QUALIFY row_number() OVER (PARTITION BY sentenceID ORDER BY reportDate, sentence, name) = 1)"""
TAGGED = f"""tagged AS (
  SELECT cik, cik_int, sentenceID, section, docID, reportDate, report_year,
         {bin_case("report_year", THREE)} AS temporal_bin
  FROM {{source}}
  WHERE cik_int IN (SELECT cik_int FROM keys) AND report_year BETWEEN 1995 AND 2001
    AND section IS NOT NULL AND sentence IS NOT NULL AND length(sentence) > 10)"""
POPULATIONS = """pops AS (
  SELECT temporal_bin, count(*) AS bin_population, count(DISTINCT cik_int) AS n_companies,
         count(DISTINCT docID) AS n_filings, count(DISTINCT section) AS n_sections
  FROM tagged GROUP BY temporal_bin)"""
WIDE = """wide AS (
  SELECT coalesce(max(CASE WHEN temporal_bin = 'bin_1995_1996' THEN bin_population END), 0) AS p1,
         coalesce(max(CASE WHEN temporal_bin = 'bin_1997_1998' THEN bin_population END), 0) AS p2,
         coalesce(max(CASE WHEN temporal_bin = 'bin_1999_2001' THEN bin_population END), 0) AS p3,
         coalesce(CAST(sum(bin_population) AS BIGINT), 0) AS total_population
  FROM pops)"""
DECISION = f"""decision AS (
  SELECT *, greatest(0, {BUDGET} - p3) AS leftover, least({BUDGET}, p3) AS t3,
         CAST(round(greatest(0, {BUDGET} - p3) * CAST(0.6 AS DOUBLE)) AS BIGINT) AS t2,
         CAST(round(greatest(0, {BUDGET} - p3) * CAST(0.4 AS DOUBLE)) AS BIGINT) AS t1
  FROM wide)"""
ALLOCATION = """alloc AS (
  SELECT temporal_bin, target_n, population, priority_order,
         round(target_n * 100.0 / nullif(population, 0), 2) AS sampling_rate_pct
  FROM (SELECT 'bin_1999_2001' AS temporal_bin, CAST(t3 AS BIGINT) AS target_n, p3 AS population,
               CAST(1 AS BIGINT) AS priority_order FROM decision
        UNION ALL SELECT 'bin_1997_1998', t2, p2, 2 FROM decision
        UNION ALL SELECT 'bin_1995_1996', t1, p1, 3 FROM decision))"""
SAMPLE = f"""ranked AS (
  SELECT t.*, a.target_n, a.population, a.sampling_rate_pct,
         row_number() OVER (PARTITION BY t.temporal_bin, cik_int, report_year, section
                            ORDER BY md5('{SEED}|' || sentenceID), sentenceID) AS rn,
         count(*) OVER (PARTITION BY t.temporal_bin, cik_int, report_year, section) AS size
  FROM tagged t JOIN alloc a ON t.temporal_bin = a.temporal_bin WHERE a.target_n > 0),
sample_ids AS (
  SELECT sentenceID, temporal_bin, cik_int, report_year, section, sampling_rate_pct
  FROM ranked
  WHERE rn <= CASE WHEN target_n >= population THEN size
                   ELSE greatest(1, CAST(round(size * (CAST(target_n AS DOUBLE) / population)) AS BIGINT)) END)"""
CHAIN = [SENTENCES, UNIQUE, KEYS, TAGGED, POPULATIONS, WIDE, DECISION, ALLOCATION, SAMPLE]


def chain(body: str, last: str = SAMPLE, source: str = "sentences") -> str:
    views = CHAIN[: CHAIN.index(last) + 1]
    return with_views("\n" + body, *[v.replace("{source}", source) for v in views])


def company_keys(t: Tables) -> DataFrame:
    return t.customer.filter(F.col("c_mktsegment") != "FURNITURE").select(F.col("c_custkey").alias("cik_int"))


def unique_sentences(t: Tables, *columns: str) -> DataFrame:
    """One row per sentence id, with ``columns`` or all."""
    rows = t.sentences.select(*columns) if columns else t.sentences
    return first_of_repeated(rows, ["sentenceID"], ["reportDate", "sentence", "name"])


# What the sample and its checks read of a sentence.
SAMPLED = ("cik", "cik_int", "name", "docID", "sentenceID", "section", "sentence", "reportDate", "report_year")


def tagged(t: Tables) -> DataFrame:
    return s.tag_corpus(t.sentences, company_keys(t), THREE)


def allocation(rows: DataFrame) -> DataFrame:
    return s.allocate(s.bin_populations(rows), BUDGET, THREE)


def sample_ids(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Allocation and sampled ids; the tagged corpus and allocation are written once and reused."""
    rows = cut_lineage(tagged(t))
    plan = cut_lineage(allocation(rows))
    return plan, s.stratified_sample(rows, plan, seed=SEED)


@catalog.query("p1_tag_corpus", chain("SELECT * FROM tagged", TAGGED))
def _(t):
    return tagged(t)


@catalog.query("p2_bin_populations", chain("SELECT * FROM pops", POPULATIONS))
def _(t):
    return s.bin_populations(tagged(t))


@catalog.query(
    "a10_pivot_bin_populations",
    chain('SELECT p1 AS "bin_1995_1996", p2 AS "bin_1997_1998", p3 AS "bin_1999_2001", total_population FROM wide', WIDE),
)
def _(t):
    return s.pivot_populations(s.bin_populations(tagged(t)), THREE)


@catalog.query(
    "p2_allocation_decision",
    chain(
        f"""SELECT CAST({BUDGET} AS BIGINT) AS target_budget, total_population,
       CASE WHEN p3 >= {BUDGET} THEN 'newest_only' ELSE 'newest_full_plus_older' END AS allocation_mode,
       CAST(leftover AS BIGINT) AS leftover_budget,
       p1 AS "bin_1995_1996_pop", p2 AS "bin_1997_1998_pop", p3 AS "bin_1999_2001_pop",
       t1 AS "bin_1995_1996_target", t2 AS "bin_1997_1998_target", CAST(t3 AS BIGINT) AS "bin_1999_2001_target"
FROM decision""",
        DECISION,
    ),
)
def _(t):
    return s.decide_allocation(s.bin_populations(tagged(t)), BUDGET, THREE)


@catalog.query("a11_p2_allocate_unpivot", chain("SELECT * FROM alloc", ALLOCATION))
def _(t):
    return allocation(tagged(t))


@catalog.query("p3_stratified_sample", chain("SELECT * FROM sample_ids"))
def _(t):
    return sample_ids(t)[1]


@catalog.query(
    "p3_stratified_sample_by_bin",
    chain("""SELECT temporal_bin, count(*) AS n_sampled, count(DISTINCT cik_int) AS n_companies,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct_of_sample
FROM sample_ids GROUP BY temporal_bin"""),
)
def _(t):
    ids = sample_ids(t)[1]
    per_company = ids.groupBy("temporal_bin", "cik_int").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_company.groupBy("temporal_bin")
        .agg(F.sum("n").alias("n_sampled"), F.count(F.lit(1)).alias("n_companies"))
        .withColumn("pct_of_sample", percent(F.col("n_sampled"), F.sum("n_sampled").over(Window.partitionBy())))
    )


@catalog.query("p3_sample_hot_strata_by_slices", chain("SELECT * FROM sample_ids"))
def _(t):
    """The same sample with every stratum above two rows cut by hash slices."""
    rows = cut_lineage(tagged(t))
    return s.stratified_sample(rows, cut_lineage(allocation(rows)), seed=SEED, hot_rows=2)


P4_COLUMNS = (
    "cik", "sentence", "section_ID", "section_name", "section_desc", "section_category", "sec_dim_priority",
    "docID", "sentenceID", "reportDate", "temporal_bin", "sampling_rate_pct", "char_count", "word_count_approx",
    "sample_version", "load_method", "record_status", "row_hash",
)


def section_values() -> str:
    """The section dimension as a SQL relation, written from the same fixed rows."""
    from filigree.plans.sections import SECTIONS

    def row(r: tuple) -> str:
        item, code, _, _, title, _, category, _, priority, _ = r
        return f"('{item}', {'NULL' if code is None else code}, '{title}', '{category}', '{priority}')"

    rows = ",\n".join(row(r) for r in SECTIONS)
    return f"dim AS (SELECT * FROM (VALUES {rows}) AS v(item, code, title, category, priority))"


JOINED = """joined AS (
  SELECT u.cik, u.sentence, u.section AS section_ID, d.item AS section_name, d.title AS section_desc,
         d.category AS section_category, d.priority AS sec_dim_priority, u.docID, u.sentenceID, u.reportDate,
         s.temporal_bin, s.sampling_rate_pct, length(u.sentence) AS char_count,
         length(u.sentence) - length(replace(u.sentence, ' ', '')) + 1 AS word_count_approx,
         'v1' AS sample_version, 'stratified_sampling' AS load_method, 'complete' AS record_status,
         md5(u.sentenceID || u.sentence) AS row_hash, u.cik_int, u.name, u.report_year
  FROM sample_ids s JOIN uniq u ON s.sentenceID = u.sentenceID LEFT JOIN dim d ON u.section = d.code)"""


def joined_sql(body: str) -> str:
    views = [v.replace("{source}", "uniq") for v in CHAIN]
    return with_views("\n" + body, *views, section_values(), JOINED)


def joined_sample(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Allocation, ids, the joined-back sample and the corpus it was joined to."""
    corpus = cut_lineage(unique_sentences(t, *SAMPLED))
    rows = cut_lineage(s.tag_corpus(corpus, company_keys(t), THREE))
    plan = cut_lineage(allocation(rows))
    ids = cut_lineage(s.stratified_sample(rows, plan, seed=SEED))
    drop_stage(rows)
    return plan, ids, s.join_back(ids, corpus, dim_sections(t.spark), "v1", "fixture"), corpus


@catalog.query("p4_join_back", joined_sql(f"SELECT {', '.join(P4_COLUMNS)} FROM joined"))
def _(t):
    return joined_sample(t)[2].select(*P4_COLUMNS)


@catalog.query(
    "w2_global_sample_number",
    joined_sql("""SELECT row_number() OVER (ORDER BY temporal_bin, reportDate, cik, section_ID, sentenceID) AS sample_id,
       sentenceID FROM joined"""),
)
def _(t):
    _, ids, sample, corpus = joined_sample(t)
    joined = cut_lineage(sample)
    drop_stage(corpus, ids)
    numbered = s.number_sample(joined)
    drop_stage(joined)
    return numbered.select("sample_id", "sentenceID")


@catalog.query(
    "p27_joinback_check",
    joined_sql("""SELECT (SELECT count(*) FROM sample_ids) AS ids_selected, count(*) AS rows_in_sample,
       CAST(0 AS BIGINT) AS null_sample_created_at, CAST(0 AS BIGINT) AS null_sample_version,
       CAST(0 AS BIGINT) AS null_row_hash, CAST(0 AS BIGINT) AS null_last_modified_date,
       (SELECT count(*) FROM sample_ids) - count(*) AS lost_rows, 'complete' AS join_quality FROM joined"""),
)
def _(t):
    _, ids, sample, _ = joined_sample(t)
    return s.check_joinback(ids, sample)


@catalog.query(
    "p38_allocation_check",
    chain(f"""SELECT a.temporal_bin, a.population, a.target_n, a.sampling_rate_pct, coalesce(n, 0) AS n_sampled,
       coalesce(n, 0) - a.target_n AS difference,
       CASE WHEN sampling_rate_pct >= 99 THEN 'complete' WHEN sampling_rate_pct >= 75 THEN 'high'
            WHEN sampling_rate_pct >= 50 THEN 'moderate' WHEN sampling_rate_pct >= 25 THEN 'light'
            WHEN sampling_rate_pct > 0 THEN 'sparse' ELSE 'excluded' END AS coverage_level,
       CAST(sum(a.target_n) OVER () AS BIGINT) AS total_allocated,
       CASE WHEN abs(sum(a.target_n) OVER () - {BUDGET}) <= 100 THEN 'sums_to_budget'
            ELSE 'rounding_error' END AS sum_check
FROM alloc a LEFT JOIN (SELECT temporal_bin, count(*) AS n FROM sample_ids GROUP BY 1) c
  ON a.temporal_bin = c.temporal_bin"""),
)
def _(t):
    plan, ids = sample_ids(t)
    return s.check_allocation(plan, ids, BUDGET)


@catalog.query(
    "fil7_seeded_sample",
    "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('42|' || o_orderkey), o_orderkey LIMIT 1000",
)
def _(t):
    return s.seeded_sample(t.orders.select("o_orderkey", "o_custkey"), 1000, "o_orderkey")


@catalog.query(
    "j6_companies_without_risk_section",
    chain("SELECT cik_int FROM keys WHERE cik_int NOT IN (SELECT cik_int FROM sample_ids WHERE section = 1)"),
)
def _(t):
    return anti(company_keys(t), sample_ids(t)[1].filter(F.col("section") == 1), "cik_int")


@catalog.query(
    "p27_nested_shares",
    """
WITH b AS (SELECT *, CAST(('0x' || substr(md5(CAST(o_custkey AS VARCHAR)), 1, 8)) AS BIGINT) % 100 AS share_bucket FROM orders)
SELECT share_bucket < 14 AS smaller, o_orderkey, o_custkey, share_bucket FROM b WHERE share_bucket < 35
""",
)
def _(t):
    """Orders of 35 of 100 customers' buckets, and which of them a share of 14 holds: both read from one stored layout."""
    folder = write_shares(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", fresh_path(t.spark, "shares"))
    small = read_share(t.spark, folder, 14).select("o_orderkey", F.lit(True).alias("smaller"))
    wide = read_share(t.spark, folder, 35).join(small, "o_orderkey", "left")
    return wide.select(F.coalesce("smaller", F.lit(False)).alias("smaller"), "o_orderkey", "o_custkey", F.col("share_bucket").cast("bigint").alias("share_bucket"))
