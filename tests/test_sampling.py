from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from filigree.functions.bins import THREE_BINS, label_by_threshold, temporal_bin
from filigree.functions.numbers import round_half_away
from filigree.plans import sampling as s

PUBLISHED = {"bin_2016_2020": 654_096, "bin_2010_2015": 814_696, "bin_2006_2009": 483_913}


def populations(spark, sizes):
    return spark.createDataFrame(list(sizes.items()), "temporal_bin string, bin_population bigint")


@pytest.mark.parametrize(
    ("budget", "expected"),
    [
        (1_000_000, (654_096, 207_542, 138_362)),  # newest bin below the budget
        (654_096, (654_096, 0, 0)),  # equal to it
        (100_000, (100_000, 0, 0)),  # above it
    ],
)
def test_allocation_of_published_populations(spark, budget, expected):
    rows = s.allocate(populations(spark, PUBLISHED), budget).orderBy("priority_order").collect()
    assert tuple(r["target_n"] for r in rows) == expected
    assert [r["temporal_bin"] for r in rows] == ["bin_2016_2020", "bin_2010_2015", "bin_2006_2009"]
    assert sum(r["target_n"] for r in rows) == budget


def test_allocation_without_an_older_bin(spark):
    rows = s.allocate(populations(spark, {"bin_2016_2020": 10}), 100).orderBy("priority_order").collect()
    assert [(r["target_n"], r["population"], r["sampling_rate_pct"]) for r in rows][0] == (10, 10, 100.0)
    assert rows[1]["population"] == 0 and rows[1]["sampling_rate_pct"] is None


def strata(spark):
    """Strata of size 1, 10 and 400, and 300 copies of one id inside a stratum."""
    sizes = [(1, 1), (2, 10), (3, 400)]
    rows = [(f"{c}-{i}", c, 2017, 1, "bin_2016_2020") for c, n in sizes for i in range(n)]
    rows += [("copy", 4, 2017, 1, "bin_2016_2020")] * 300 + [(f"4-{i}", 4, 2017, 1, "bin_2016_2020") for i in range(100)]
    return spark.createDataFrame(rows, "sentenceID string, cik_int int, report_year int, section int, temporal_bin string")


def plan(spark, target, population):
    return spark.createDataFrame(
        [("bin_2016_2020", target, population), ("bin_2010_2015", 0, 5)], "temporal_bin string, target_n bigint, population bigint"
    )


def test_quota_per_stratum_and_hot_path_agree(spark):
    rows, allocation = strata(spark), plan(spark, 200, 811)
    usual = s.stratified_sample(rows, allocation)
    sizes = {r["cik_int"]: r["n"] for r in usual.groupBy("cik_int").agg(F.count("*").alias("n")).collect()}
    assert sizes == {1: 1, 2: 2, 3: 99, 4: 99}  # at least one row, else the rounded share
    for hot_rows in (1, 7, 150):
        hot = s.stratified_sample(rows, allocation, hot_rows=hot_rows)
        assert sorted(map(tuple, hot.collect())) == sorted(map(tuple, usual.collect()))


def test_whole_bin_is_taken_and_order_does_not_matter(spark):
    rows = strata(spark)
    assert s.stratified_sample(rows, plan(spark, 900, 811)).count() == rows.count()
    shuffled = rows.orderBy(F.rand(1)).repartition(5)
    first = s.stratified_sample(rows, plan(spark, 200, 811)).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, s.stratified_sample(shuffled, plan(spark, 200, 811)).collect()))


def test_tagging_filters_and_bins(spark):
    long_text = "a sentence of some length"
    rows = [
        ("0000000001", 1, "a", 1, "d", "2006-01-01", long_text),
        ("0000000001", 1, "b", 1, "d", "2020-12-31", long_text),
        ("0000000001", 1, "c", 1, "d", "2021-01-01", long_text),
        ("0000000001", 1, "d", None, "d", "2012-05-05", long_text),
        ("0000000001", 1, "e", 1, "d", "2012-05-05", "short"),
        ("0000000002", 2, "f", 1, "d", "2012-05-05", long_text),
    ]
    df = spark.createDataFrame(
        rows, "cik string, cik_int int, sentenceID string, section int, docID string, reportDate string, sentence string"
    )
    keys = spark.createDataFrame([(1,)], "cik_int int")
    found = {r["sentenceID"]: r["temporal_bin"] for r in s.tag_corpus(df, keys).collect()}
    assert found == {"a": "bin_2006_2009", "b": "bin_2016_2020"}


def test_labels_bins_and_rounding(spark):
    df = spark.createDataFrame([(2009, 99.0, 1.005), (2021, 24.0, -2.5), (None, None, None)], "y int, v double, x double")
    row = df.select(
        temporal_bin(F.col("y"), THREE_BINS, "other").alias("b"),
        label_by_threshold(F.col("v"), ((99.0, "high"), (25.0, "low")), "none").alias("l"),
        round_half_away(F.col("x"), 2).alias("r"),
    ).collect()
    assert [tuple(r) for r in row] == [("bin_2006_2009", "high", 1.0), ("other", "none", -2.5), ("other", "none", None)]


def test_seeded_sample_replays(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = s.seeded_sample(df, 50, "k").collect()
    assert a == s.seeded_sample(df.repartition(7), 50, "k").collect()
    assert a != s.seeded_sample(df, 50, "k", seed=1).collect()


def test_sample_per_group_hot_path_agrees(spark):
    df = spark.createDataFrame([(i % 2, f"t{i}" if i % 4 else "copy") for i in range(300)], "g int, t string")
    usual = s.sample_per_group(df, "g", 40, ["t"])
    assert {r["g"]: r["count"] for r in usual.groupBy("g").count().collect()} == {0: 40, 1: 40}
    hot = s.sample_per_group(df, "g", 40, ["t"], hot_rows=10)
    assert sorted(map(tuple, hot.collect())) == sorted(map(tuple, usual.collect()))
