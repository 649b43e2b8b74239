"""Disk that jobs leave behind, and rows that stay where they are."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from filigree.functions.bins import Bin
from filigree.operators.joins import split_by_keys, tagged_by_keys
from filigree.operators.keyed import first_by_key, first_of_repeated, upsert
from filigree.plans import merge as m
from filigree.plans import ngrams
from filigree.plans.sections import dim_sections
from filigree.plans.subsets import Subset, run_subsets
from filigree.plans.vectors import suppress_near_vectors
from filigree.session import CLEANUP_KEY, cut_lineage, drop_stage


def shuffle_files(spark) -> int:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_a_stage_releases_its_shuffles_and_can_be_dropped(spark):
    before = shuffle_files(spark)
    staged = cut_lineage(spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 10).alias("k")).count())
    until = time.time() + 20
    while shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before and spark.conf.get(CLEANUP_KEY, None) is None
    assert staged.agg(F.sum("count")).first()[0] == 1000
    folder = os.path.dirname(staged.inputFiles()[0].removeprefix("file://"))
    drop_stage(staged.where("k > 3"))
    assert not os.path.exists(folder)


def test_drop_stage_leaves_other_tables(spark, tmp_path):
    spark.range(3).write.parquet(f"file://{tmp_path}/kept")
    drop_stage(spark.read.parquet(f"file://{tmp_path}/kept"))
    assert spark.read.parquet(f"file://{tmp_path}/kept").count() == 3


@pytest.mark.parametrize("whole", [2, 2048])
def test_batches_of_groups_give_the_same(spark, whole):
    rows = [(i % 90, i % 7 if i % 7 else None, None if i % 31 == 0 else [float(i % 5 + 1), float(i % 3), 0.1 * (i % 11)]) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, g int, v array<double>")
    one = suppress_near_vectors(df, "id", "v", ["g"], heads=2, whole=whole, rows_per_piece=16)
    more = suppress_near_vectors(df, "id", "v", ["g"], heads=2, whole=whole, rows_per_piece=16, rows_at_once=30)
    assert sorted(map(str, one.collect())) == sorted(map(str, more.collect()))


def keyed(spark, n=400):
    return spark.range(n).select(F.when(F.col("id") % 13 != 0, F.concat(F.lit("k"), (F.col("id") % 370).cast("string"))).alias("k"), F.col("id").alias("v"))


@pytest.mark.parametrize("limit", [32 << 20, 16])
def test_only_repeated_keys_meet(spark, limit):
    df = keyed(spark)
    found = first_of_repeated(df, ["k"], ["v"], limit)
    want = first_by_key(df, ["k"], ["v"])
    assert found.columns == df.columns and found.exceptAll(want).count() == 0 and found.count() == want.count()
    unique = df.where("k is not null and v < 300")
    assert "Exchange" not in first_of_repeated(unique, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()


def test_rows_that_cannot_match_are_told_apart(spark):
    df, keys = keyed(spark), keyed(spark, 100).select("k")
    assert split_by_keys(df, keys, "k")[1] is None  # few keys
    may, cannot = split_by_keys(df, keys, "k", few=10)
    known = keys.where("k is not null")
    assert may.unionByName(cannot).exceptAll(df).count() == 0 and may.count() + cannot.count() == df.count()
    assert cannot.count() > 100 and cannot.join(known, "k", "left_semi").count() == 0
    new = keyed(spark, 100).withColumn("v", -F.col("v"))
    plain = df.join(new.select("k"), "k", "left_anti").select("k", "v").unionByName(new)
    apart = upsert(df, new, "k", few=10)
    assert apart.exceptAll(plain).count() == 0 and apart.count() == plain.count()


@pytest.mark.parametrize("limit", [32 << 20, 1])
def test_whole_numbers_are_marked_exactly(spark, limit):
    numbers = spark.createDataFrame([(x,) for x in [None, -5, 0, 3, 3, 40_000, 70_000]], "n bigint")
    keys = spark.createDataFrame([(x,) for x in [None, -5, 3, 3, 70_000]], "n int")
    got = {(r.n, r.hit) for r in tagged_by_keys(numbers, keys, "n", "hit", limit).collect()}
    assert got == {(None, False), (-5, True), (0, False), (3, True), (40_000, False), (70_000, True)}
    assert tagged_by_keys(numbers, keys.limit(0), "n", "hit", limit).where("hit").count() == 0


@pytest.mark.parametrize("rows_at_once", [20, 1 << 26])
def test_subsets_in_passes(spark, tmp_path, rows_at_once):
    fact = spark.range(200).select(
        F.when(F.col("id") % 17 != 0, F.col("id") % 11).alias("cik_int"), (1995 + F.col("id") % 5).alias("report_year"), (F.col("id") % 4).alias("section"),
        F.col("id").cast("string").alias("sentenceID"), F.when(F.col("id") % 5 > 2, "new").when(F.col("id") % 5 > 0, "old").alias("temporal_bin"),
    )
    lists = {"a": spark.createDataFrame([(1,), (2,), (2,), (7,), (None,)], "cik_int int"), "b": spark.createDataFrame([(3,)], "cik_int bigint")}
    jobs = [Subset("all", "a", "ALL_BINS"), Subset("newer", "b", "MODERN_ONLY"), Subset("years", "a", (1996, 1997)), Subset("off", "a", "ALL_BINS", enabled=False)]
    got = run_subsets(fact, lists, jobs, f"file://{tmp_path}/subsets", (Bin("old", 1995, 1997), Bin("new", 1998, 1999)), rows_at_once=rows_at_once)
    of_a = fact.where("cik_int in (1, 2, 7)")
    want = {"all": of_a, "newer": fact.where("cik_int = 3 and temporal_bin = 'new'"), "years": of_a.where("report_year between 1996 and 1997")}
    assert list(got) == list(want)
    for name, df in want.items():
        assert got[name].columns == fact.columns and got[name].exceptAll(df).count() == 0 and got[name].count() == df.count() > 0


def test_increment_is_numbered_before_it_is_filled(spark, monkeypatch):
    moved = []
    numbered = m.append_numbers
    monkeypatch.setattr(m, "append_numbers", lambda old, new, *rest: moved.append(new.columns) or numbered(old, new, *rest))
    target = spark.createDataFrame([(7, "s0", "x", "ITEM_1", "P0", 1999, "h")], "sample_id bigint, sentenceID string, sentence string, section_name string, sec_dim_priority string, report_year int, row_hash string")
    new = spark.createDataFrame([("s2", "b", "item_1 ", 2000, "1", "2000-01-01"), ("s1", "a", "none", 2000, "1", "2000-01-01")], "sentenceID string, sentence string, section_item string, report_year int, cik string, filingDate string")
    staged = m.stage_increment(new, dim_sections(spark), target, {}, "x")
    assert [(r.sample_id, r.sentenceID, r.sec_dim_priority) for r in staged.orderBy("sample_id").collect()] == [(8, "s1", "P3"), (9, "s2", "P1")]
    assert "row_hash" not in moved[0] and "section_desc" not in moved[0]


def test_a_range_of_ngrams_gives_only_its_documents(spark):
    texts = [(i, 7, 200, 1, f"alpha{i} beta{i % 9} gamma{i % 50}") for i in range(200)]
    docs = spark.createDataFrame(texts, "no bigint, seed bigint, n bigint, copies bigint, text string").coalesce(1)
    blocks = ngrams._blocks(docs, (1,))
    found = {tasks: ngrams._weighed(ngrams._placed(blocks, tasks), 1, 1.0) for tasks in (1, 16)}
    parts = found[16].where("block is not null")
    assert parts.count() > 8 and parts.agg(F.sum(F.length("squares"))).first()[0] < 16 * 200 * 8 / 2
    lengths = [ngrams._lengths(f.where("block is not null").select("block", "n", "squares", "at")).collect() for f in found.values()]
    one, many = ([memoryview(r.length).cast("d").tolist() for r in x] for x in lengths)
    assert [len(x) for x in one] == [200] and many[0] == pytest.approx(one[0])
