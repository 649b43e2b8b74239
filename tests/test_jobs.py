from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from filigree.plans import companies as c
from filigree.plans import kpi
from filigree.plans import merge as m
from filigree.plans import text_scans as x
from filigree.plans.near_duplicates import block_masks, near_dupes, near_pairs, simhash
from filigree.plans.ngrams import suggest_labels, top_ngrams
from filigree.plans.sampling_run import SamplingConfig, report_problems, run_sampling
from filigree.plans.sections import dim_sections
from filigree.sinks.versions import VersionedTable
from filigree.streaming import merges as st

TOKEN = re.compile(r"[a-z0-9%$.]+")
TEXTS = [
    "Revenue rose by 5% in 2019, mostly from services.", "Revenue rose by 5% in 2019, mostly from products.",
    "Risk factors may harm our business and results.", "risk factors may harm our business and results",
    "Risk factors may harm our business and results.", "None.", "", "See exhibit 10.1 and the agreement.",
    "Revenue rose by 6% in 2020, mostly from services.", "We face risk, and risk is large.",
]


def brute_simhash(s: str) -> int:
    words = TOKEN.findall(s.lower())
    parts = [" ".join(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [" ".join(words)]
    votes = [0] * 64
    for p in parts:
        h = int(hashlib.md5(p.encode()).hexdigest(), 16)
        for b in range(64):
            votes[b] += 1 if (h >> b) & 1 else -1
    return sum(1 << b for b in range(64) if votes[b] >= 0)


def unsigned(v: int) -> int:
    return v & ((1 << 64) - 1)


def signed(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def test_simhash_equals_brute_force(spark):
    df = spark.createDataFrame([(1, t) for t in TEXTS] + [(1, None)], "g int, t string")
    found = {r["digest"].hex(): (r["rows"], unsigned(r["simhash"])) for r in simhash(df, "g", "t").collect()}
    copies = Counter(TEXTS)
    assert found == {hashlib.md5(t.encode()).hexdigest(): (n, brute_simhash(t)) for t, n in copies.items()}


def test_masks_cover_every_close_pair():
    rng = random.Random(3)
    for blocks in (4, 6):
        masks = block_masks(48, blocks, 3)
        for _ in range(300):
            flipped = sum(1 << b for b in rng.sample(range(48), 3))
            assert any(flipped & mask == 0 for mask in masks)


@pytest.mark.parametrize("hot_bucket", [50_000, 1])
def test_near_pairs_equal_brute_force(spark, hot_bucket):
    rng = random.Random(5)
    values = set()
    for _ in range(40):
        base = rng.getrandbits(64)
        values.add(base)
        for _ in range(6):
            values.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    rows = [(1, signed(v), 2) for v in values]
    expected = {
        tuple(sorted((signed(a), signed(b))))
        for a in values for b in values
        if a < b and a >> 48 == b >> 48 and (a ^ b).bit_count() <= 3
    }
    pairs = near_pairs(spark.createDataFrame(rows, "g int, simhash bigint, rows bigint"), "g", hot_bucket=hot_bucket).collect()
    assert len(pairs) == len(expected) > 20
    assert {(p["a"], p["b"]) for p in pairs} == expected


def test_near_duplicate_report(spark):
    df = spark.createDataFrame([(1, t) for t in TEXTS] + [(2, "alone here")], "g int, t string")
    report = {r["g"]: r for r in near_dupes(df, "g", "t").collect()}
    assert (report[1]["n_rows"], report[1]["n_near_dupes"], report[2]["n_near_dupes"]) == (10, 1, 0)
    assert report[1]["n_near_pairs"] == 1 and report[1]["dup_rate"] == 0.1


def brute_tfidf(texts, min_df, max_df):
    docs = []
    for t in texts:
        w = TOKEN.findall(t.lower())
        docs.append(Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])]))
    n = len(docs)
    df = Counter(g for d in docs for g in d)
    kept = {g for g, v in df.items() if min_df <= v <= max_df * n}
    scores = defaultdict(float)
    for d in docs:
        weights = {g: tf * (math.log((1 + n) / (1 + df[g])) + 1) for g, tf in d.items() if g in kept}
        norm = math.sqrt(sum(v * v for v in weights.values()))
        for g, v in weights.items():
            scores[g] += v / norm / n
    return scores


def test_ngrams_equal_brute_force(spark):
    df = spark.createDataFrame([(1, t) for t in TEXTS], "g int, t string")
    expected = brute_tfidf(TEXTS, 2, 0.6)
    found = {r["ngram"]: r["score"] for r in top_ngrams(df, "g", "t", k=1000, min_df=2).collect()}
    assert found.keys() == expected.keys()
    assert all(abs(found[g] - expected[g]) < 1e-9 for g in found)
    labels = suggest_labels(top_ngrams(df, "g", "t", k=1000, min_df=2), "g", first=1000).first()
    assert labels["guess_label"] == "Business / Overview" and labels["support_terms"] == "business"


def many_texts(n):
    g = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["Größe", "US$", "5%", "a.b"]
    texts = [" ".join(words[min(int(g.expovariate(0.06)), 63)] for _ in range(g.randint(0, 30))) for _ in range(n)]
    return texts + texts[:9] + ["", "É", texts[3]]


def test_ngrams_are_not_joined_row_by_row(spark):
    """The n-grams of the documents go by hash and packed; no row an n-gram and document is made or shuffled."""
    df = spark.createDataFrame([(1, t) for t in many_texts(80)], "g int, t string")
    plan = top_ngrams(df, "g", "t", k=5)._jdf.queryExecution().toString()
    assert "Generate" not in plan and "array_join" not in plan


@pytest.mark.parametrize(("pairs", "at_once"), [(1 << 22, 1 << 14), (50, 1)])
def test_ngrams_by_tasks_and_rounds(spark, pairs, at_once):
    """The same for many small tasks and for candidates in many rounds; null groups are left out."""
    texts = {"a": many_texts(150), "b": many_texts(30)[::-1], None: ["w1 w1"] * 9}
    df = spark.createDataFrame([(g, t) for g, ts in texts.items() for t in [*ts, None]], "g string, t string").repartition(3)
    got = top_ngrams(df, "g", "t", k=7, min_df=3, pairs_per_task=pairs, at_once=at_once).collect()
    for g in "ab":
        want = sorted(((-round(v, 10), x) for x, v in brute_tfidf(texts[g], 3, 0.6).items()))[:7]
        assert [(r["rank"], r["ngram"]) for r in sorted(got, key=lambda r: r["rank"]) if r["g"] == g] == [(i, x) for i, (_, x) in enumerate(want, 1)]
    assert {r["g"] for r in got} == {"a", "b"}


def test_ngrams_of_nothing(spark):
    for rows in ([], [(1, "a b")], [(1, "")], [(None, "a")]):
        assert top_ngrams(spark.createDataFrame(rows, "g int, t string"), "g", "t").isEmpty()


def test_text_columns_and_stats(spark):
    df = spark.createDataFrame([("a b", 1, "x"), (None, 2, "y"), ("", 3, None)], "body_text string, n int, other string")
    assert x.guess_text_columns(df) == ("body_text",)
    assert x.guess_text_columns(df.drop("body_text")) == ("other",)
    stats = x.text_len_stats(df, ["body_text", "absent"]).collect()
    assert [(s["column"], s["n_nonempty"], s["char_mean"], s["tok_mean"]) for s in stats] == [("body_text", 1, 1.0, 0.666667)]


SENTENCES = [
    ("s1", "2018 compared to 2017 The Other segment reported net income of $14 million, compared to net loss of $71 million.", "2019-02-01"),
    ("s2", "A reduction of 85 million BOE was recorded in Canada.", "2018-12-31"),
    ("s3", "Revenue was $2.1B and EBITDA $200M.", None),
    ("s4", "We issued $1,750.0 million of 2.35 percent notes due in May 2022.", "2017-12-31"),
    ("s5", "Rates range from 2% to 6% in Q4 2018.", "2018-12-31"),
]


def test_kpi_records(spark):
    df = spark.createDataFrame(
        [("1", "Co", ["T", "U"], "d", i, 8, t, d) for i, t, d in SENTENCES],
        "cik string, name string, tickers array<string>, docID string, sentenceID string, section int, sentence string, reportDate string",
    )
    records = kpi.extract_kpis(df)
    assert tuple(records.columns) == kpi.KPI_COLUMNS
    found = sorted((r["sentenceID"], r["kpi_type"], r["value"], r["year"]) for r in records.collect())
    assert found == [
        ("s1", "net_income", 14e6, "2018"), ("s1", "net_income", 71e6, "2018"), ("s2", "financial_metric", 85e6, "2018"),
        ("s3", "revenue", 2e8, ""), ("s3", "revenue", 2.1e9, ""), ("s4", "financial_metric", 1750e6, "2022"),
    ]
    assert kpi.dedupe_kpis(records.unionByName(records)).count() == 6
    marks = {r["sentenceID"]: (r["percents"], r["quarters"]) for r in kpi.extract_marks(df).collect()}
    assert marks["s5"] == (["2", "6"], ["Q4"])
    packs = kpi.pack(df, ["sentenceID"], size=2).orderBy("pack").collect()
    assert [p["n_sentences"] for p in packs] == [2, 2, 1]
    assert packs[0]["block"].startswith("<<s1>> (Company: Co, Ticker: T) 2018 compared")


def base_frame(spark, rows):
    return spark.createDataFrame(rows, "sentenceID string, sentence string, report_year int, sic string")


def test_merge_job_and_gates(spark, tmp_path):
    hist = base_frame(spark, [("a", "old", 2018, "1"), ("b", "old", 2018, "1")])
    incr = spark.createDataFrame(
        [("b", "new", 2019, "2", 7, 1), ("c", "x", 2019, "2", 8, 2)], "sentenceID string, sentence string, report_year int, SIC string, sentence_index int, extra int"
    )
    out = VersionedTable(str(tmp_path / "fact"))
    stats = m.merge_job(spark, hist, incr, out, "sentenceID", ["report_year"], "report_year", "sic", ["report_year", "sentenceID"])
    assert (stats.merge_type, stats.base_rows, stats.incr_rows, stats.final_rows, stats.duplicates_removed) == ("initial_bootstrap", 2, 2, 3, 1)
    assert (stats.year_min, stats.year_max, stats.companies, stats.extra_columns) == (2018, 2019, 2, ["extra"])
    merged = {r["sentenceID"]: (r["sentence"], r["sic"]) for r in out.read(spark).collect()}
    assert merged == {"a": ("old", "1"), "b": ("new", "2"), "c": ("x", "2")}
    empty = m.merge_job(spark, hist, incr.limit(0), out, "sentenceID", ["report_year"])
    assert (empty.merge_type, empty.final_rows) == ("incremental_update", 3)
    bad = base_frame(spark, [(None, "x", 2020, "3")])
    with pytest.raises(m.MergeRejected):
        m.merge_job(spark, hist, bad, out, "sentenceID", ["report_year"])
    assert out.read(spark).count() == 3 and None not in {r["sentenceID"] for r in out.read(spark).collect()}
    assert out.versions(spark, published=False) == out.versions(spark)  # the rejected version is gone
    with pytest.raises(m.MergeRejected):
        m.preflight({"increment": incr.limit(0)}, "sentenceID")
    with pytest.raises(m.MergeRejected):
        m.preflight({"increment": incr.drop("sentenceID")}, "sentenceID")
    m.preflight({"historical": hist, "increment": incr}, "sentenceID")


def test_a_merge_keeps_the_files_of_untouched_partitions(spark, tmp_path):
    out = VersionedTable(str(tmp_path / "fact"), by="report_year")
    log = str(tmp_path / "log")
    hist = base_frame(spark, [(f"k{y}{i}", "old", y, "1") for y in (2017, 2018, 2019) for i in range(5)])
    m.merge_job(spark, hist, hist.limit(0), out, "sentenceID", ["sentence"], history=log)
    before = {p.relative_to(tmp_path): p.stat().st_mtime_ns for p in (tmp_path / "fact").rglob("*.parquet")}
    incr = base_frame(spark, [("k20183", "new", 2018, "2"), ("k2018x", "new", 2018, "2"), ("k20201", "new", 2020, "2")])
    stats = m.merge_job(spark, hist, incr, out, "sentenceID", ["sentence"], history=log)
    assert (stats.base_rows, stats.final_rows, stats.duplicates_removed) == (15, 17, 1)
    parts = out.parts(spark, stats.version)
    assert {k for k, v in parts.items() if v.startswith("version=1/")} == {"report_year=2017", "report_year=2019"}
    assert all((tmp_path / p).stat().st_mtime_ns == t for p, t in before.items())
    got = {r["sentenceID"]: r["sentence"] for r in out.read(spark).collect()}
    assert len(got) == 17 and got["k20183"] == "new" and got["k20190"] == "old"
    with pytest.raises(m.MergeRejected):  # a key that would move to another partition
        m.merge_job(spark, hist, base_frame(spark, [("k20171", "moved", 2019, "2")]), out, "sentenceID", ["sentence"], history=log)
    with pytest.raises(m.MergeRejected):
        m.merge_job(spark, hist, base_frame(spark, [(None, "x", 2018, "2")]), out, "sentenceID", ["sentence"], history=log)
    assert out.read(spark).count() == 17 and len(out.versions(spark, published=False)) == 2
    history = m.merge_history(spark, log).orderBy("run_at").collect()
    assert [h["status"] for h in history] == ["published", "published", "rejected", "rejected"] and history[1]["final_rows"] == 17


@pytest.mark.parametrize("few", [0, 100])
def test_merging_into_unique_keys_equals_grouping(spark, few):
    base = base_frame(spark, [(f"k{i}", "old", 2018, "1") for i in range(30)])
    incr = base_frame(spark, [(f"k{i % 12 + 20}", f"new{i}", 2019, "2") for i in range(24)])
    grouped = m.merged_rows(base, incr, "sentenceID", ["sentence"])
    joined = m.merged_rows(base, incr, "sentenceID", ["sentence"], base_is_unique=True, max_broadcast_bytes=few)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, grouped.collect()))


def test_staging_can_be_switched_off(spark):
    target = spark.createDataFrame([(1, "a")], "sample_id bigint, sentenceID string")
    staged = m.stage_increment(target, dim_sections(spark), target, {}, "x", enabled=False)
    assert staged.count() == 0 and staged.schema == target.schema


def test_times_become_utc_instants(spark):
    df = m.normalise_times(spark.sql("SELECT timestamp_ntz'2020-01-01 00:00:00' AS at"))
    assert df.dtypes == [("at", "timestamp")]
    assert df.select(F.unix_seconds("at")).first()[0] == 1577836800


def test_section_dimension(spark):
    dim = {r["sec_item_canonical"]: r for r in dim_sections(spark).collect()}
    assert len(dim) == 21 and dim["ITEM_16"]["hf_section_code"] is None
    assert (dim["ITEM_8"]["hf_section_code"], dim["ITEM_7A"]["hf_section_code"]) == (10, 9)
    assert dim["ITEM_7"]["section_code"] == "PART_II_ITEM_7" and dim["ITEM_15"]["section_category"] == "P4_EXHIBITS"
    assert sum(1 for r in dim.values() if r["priority"] == "P0") == 2


def test_entity_resolution_ties(spark):
    dim = spark.createDataFrame(
        [(1, "ONE", ["AA"], "2019-01-01", 3), (2, "TWO", ["BB"], "2020-01-01", 1), (3, "THREE", ["BB"], "2020-01-01", 5)],
        "cik_int bigint, company_name string, all_tickers array<string>, latest_filing_date string, n_filings bigint",
    )
    rows = [
        ("1", "One", "zz", "notable", "t", None, 5.0), ("99", "Two", "bb", "sp500", "t", 1.0, None),
        ("98", "Lost", None, "sp500", "t", 1.0, None), ("3", "Three", None, "notable", "t", None, 9.0), ("x", "Bad id", "", "sp500", "t", 2.0, None),
    ]
    targets = spark.createDataFrame(
        rows, "cik string, company_name string, ticker string, source string, tier string, weight_pct double, quality_score double"
    )
    out = {r["cik_int"]: (r["company_id"], r["company_name"], r["match_method"]) for r in c.resolve_entities(targets, dim).collect()}
    assert out == {3: (1, "Two", "TICKER_MATCH"), 1: (2, "One", "CIK_MATCH")}
    steps = {r["step"]: r["n_companies"] for r in c.resolution_summary(targets, dim).collect()}
    assert steps == {"id_matches": 2, "tried_by_ticker": 1, "ticker_matches": 1, "matched": 3, "unmatched": 2}


def test_selection_with_null_weights(spark):
    rows = [(i, f"{i:010d}", f"C{i}", f"T{i}", "sp500" if i % 2 else "notable", "t", float(i) if i % 2 and i > 1 else None, float(i)) for i in range(1, 9)]
    companies = spark.createDataFrame(
        rows, "cik_int bigint, cik string, company_name string, ticker string, source string, tier string, weight_pct double, quality_score double"
    )
    manual = companies.filter("cik_int = 7").select("cik_int", "cik", "company_name", "ticker")
    picked = c.select_n(companies, 2, 1, manual).orderBy("company_id").collect()
    assert [(p["cik_int"], p["selection_source"]) for p in picked] == [(7, "MANUAL"), (5, "SNP500_TOP2"), (3, "SNP500_TOP2"), (8, "QUALITY_TOP1")]
    assert picked[0]["version"] == "v2.0_prod_4companies"


def test_first_rows_of_stream_stops_also_after_a_restart(spark, tmp_path):
    spark.range(20).repartition(2).write.parquet(str(tmp_path / "in"))
    read = lambda: st.first_rows_of_stream(st.file_stream(spark, str(tmp_path / "in"), spark.range(1).schema, files_per_batch=1), 30, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert read().select("id").distinct().count() == 20
    spark.range(20, 100).repartition(5).write.mode("append").parquet(str(tmp_path / "in"))
    assert read().select("id").distinct().count() == 30
    assert read().count() == 30


def test_targets_without_id_or_score(spark):
    dim = spark.createDataFrame([(7, ["T"], "2020-01-01", 3), (8, ["U"], "2020-01-01", 3)], "cik_int int, all_tickers array<string>, latest_filing_date string, n_filings int")
    make = lambda rows: spark.createDataFrame(rows, "cik string, company_name string, ticker string, source string, tier string, weight_pct double, quality_score double")
    none = make([(None, "One", "T", "notable", "x", 1.0, None), (None, "Two", "U", "notable", "x", 1.0, None)])
    assert {r["company_name"] for r in c.resolve_entities(none, dim).collect()} == {"One", "Two"}
    tied = make([("7", "Unscored", None, "notable", "x", None, None), ("07", "Scored", None, "notable", "x", 5.0, None)])
    assert [r["company_name"] for r in c.resolve_entities(tied, dim).collect()] == ["Scored"]


def test_amounts_need_a_whole_unit(spark):
    texts = ["12 buildings", "in 1999 before", "10 months", "up 3 by", "$2.5B more", "5 bn", "7m.", "8 Million"]
    df = spark.createDataFrame([("1", "Co", ["T"], "d", str(i), 8, s, "2020-01-01") for i, s in enumerate(texts)], "cik string, name string, tickers array<string>, docID string, sentenceID string, section int, sentence string, reportDate string")
    got = {r["sentenceID"]: r["value"] for r in kpi.extract_kpis(df).collect()}
    assert got == {"4": 2.5e9, "5": 5e9, "6": 7e6, "7": 8e6}
    long = df.limit(1).withColumn("sentence", F.concat(F.lit("3 million "), F.repeat(F.lit("x"), 900)))
    assert len(kpi.extract_kpis(long).first()["source_answer"]) == 910
    assert len(kpi.extract_kpis(long, answer_chars=20).first()["source_answer"]) == 20


def test_sampling_run_with_injection(spark, tmp_path):
    rows = [
        (f"{c:010d}", c, f"Co {c}", ["T"], f"{c}_10-K_{y}", f"{c}_{y}_{s}_{i}", s, "10-K", "12", f"Revenue was ${i} million in {y}.", f"{y}-03-01", f"{y - 1}-12-31", y - 1)
        for c in (1, 2) for y in (2008, 2013, 2019) for s in (1, 8) for i in range(20)
    ]
    corpus = spark.createDataFrame(
        rows,
        "cik string, cik_int bigint, name string, tickers array<string>, docID string, sentenceID string, section bigint, form string, "
        "sic string, sentence string, filingDate string, reportDate string, report_year bigint",
    )
    increment = spark.createDataFrame(
        [("0000000003", "ALPHABET INC", "3_10-K_2019", f"3_2019_8_{i}", 8, "item_7 ", "7370", "Sales grew strongly.", "2020-02-01", "2019-12-31", 2019, "bin_2016_2020") for i in range(5)],
        "cik string, name string, docID string, sentenceID string, section_ID bigint, section_item string, SIC string, sentence string, "
        "filingDate string, reportDate string, report_year bigint, temporal_bin string",
    )
    known = m.name_matches(F.col("name"), ["ALPHABET", "GOOGLE"])
    config = SamplingConfig(budget=160, placeholders=m.company_placeholders(known, ["GOOGL", "GOOG"], ["NASDAQ"], "DE"))
    run = run_sampling(
        spark, corpus, corpus.select("cik_int").distinct(), str(tmp_path / "sample"), config, increment, str(tmp_path / "log")
    )
    by_method = {r["load_method"]: (r["n"], r["s"]) for r in run.sample.groupBy("load_method").agg(F.count("*").alias("n"), F.max("record_status").alias("s")).collect()}
    assert by_method["incremental_inject"] == (5, "injected") and by_method["stratified_sampling"][0] == 160
    injected = run.sample.filter("load_method = 'incremental_inject'").first()
    assert (injected["section_name"], injected["section_category"], injected["tickers"]) == ("item_7 ", "P2_MDNA", ["GOOGL", "GOOG"])
    ids = [r["sample_id"] for r in run.sample.orderBy("sample_id").collect()]
    assert ids == list(range(1, 166))
    assert run.joinback.first()["lost_rows"] == 0
    assert [r["step_name"] for r in run.log.orderBy("step_number").collect()][-1] == "VALIDATION"
    problems = {r["check_name"] for r in report_problems(run.report).collect()}
    assert "4 sections" in problems and "12 summary" not in problems


def test_resolution_steps_count_rows(spark):
    """Targets without an id, of one id, and alike in all columns are counted each by itself."""
    dim = spark.createDataFrame([(1, ["AA"], "2020-01-01", 3), (2, ["BB"], "2021-01-01", 5)], "cik_int long, all_tickers array<string>, latest_filing_date string, n_filings long")
    names = "cik string, company_name string, ticker string, source string, tier string, weight_pct double, quality_score double"
    rows = [("1", "one", "aa", "sp500", "t", 1.0, None), ("1", "one again", None, "notable", "t", None, 5.0), (None, "two", "bb", "sp500", "t", 1.0, None), (None, "none", "zz", "sp500", "t", 1.0, None), ("9", "x", "aa", "notable", "t", None, 1.0), ("9", "y", "bb", "notable", "t", None, 2.0), ("8", "same", None, "notable", "t", None, 1.0), ("8", "same", None, "notable", "t", None, 1.0)]
    targets = spark.createDataFrame(rows, names)
    got = {r.step: r.n_companies for r in c.resolution_summary(targets, dim).collect()}
    assert got == {"id_matches": 2, "tried_by_ticker": 4, "ticker_matches": 3, "matched": 5, "unmatched": 3}
    assert {(r.cik_int, r.company_name) for r in c.resolve_entities(targets, dim).collect()} == {(1, "one"), (2, "two")}


def test_malformed_values_become_null_and_are_counted(spark):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

    base = StructType([StructField("t", TimestampType()), StructField("n", IntegerType()), StructField("s", StringType()), StructField("new", StringType())])
    df = spark.createDataFrame([("2020-01-01 00:00:00", "1", "a"), ("not a time", "x", "b"), (None, "7", None), ("2020-13-45", "99999999999", "c")], "t string, n string, s string")
    got = m.align_to(df, base).collect()
    assert [r.t is None for r in got] == [False, True, True, True] and [r.n for r in got] == [1, None, 7, None] and all(r.new is None for r in got)
    assert {r.column_name: r.n_malformed for r in m.malformed_values(df, base).collect()} == {"t": 2, "n": 2, "s": 0}
