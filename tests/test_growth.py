"""What keeps tasks, folders and the driver small when tables grow."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from filigree.operators import joins as j
from filigree.operators.aggregates import dealt_out
from filigree.operators.keyed import first_by_key, last_by_key
from filigree.operators.numbering import key_ranges
from filigree.sinks.versions import VersionedTable
from filigree.sources.readers import spread_by_key


def test_suspects_meet_the_dimension_without_broadcasts(spark, capsys):
    listed = spark.createDataFrame([(1, 7, "ACME", "T1"), (2, 9, "", "T9")], "sid int, cik int, p string, t string")
    dim = spark.createDataFrame([(7, "Other", ["T9"]), (8, "The Acme Company", [])], "cik_int int, name string, tickers array<string>")
    pairs = j.any_of_join(listed, dim, "sid", "cik_int", ("cik", "cik_int"), ("p", "name"), ("t", "tickers"))
    assert {tuple(r) for r in pairs.collect()} == {(1, 7), (1, 8), (2, 7), (2, 8)}
    pairs.explain()
    assert "BroadcastHashJoin" not in capsys.readouterr().out


def test_patterns_with_common_short_pieces_are_found(spark):
    names = spark.createDataFrame([(i, f"NAME#{i:09d}") for i in range(2_000)] + [(-1, "AB"), (-2, None)], "i int, name string")
    patterns = spark.createDataFrame([(k, f"#{k * 5:09d}") for k in range(500)] + [(-1, "B"), (-2, "E#0000000001"), (-3, "E#000000001")], "k int, pattern string")
    got = {(r.i, r.k) for r in j.contains_join(names, patterns, "name", "pattern").collect()}
    assert got == {(k * 5, k) for k in range(400)} | {(-1, -1), (1, -3)}


def test_key_ranges_are_bounded_however_many_keys(spark):
    keys = spark.range(0, 300_000, 3).select(F.when(F.col("id") > 0, F.col("id")).alias("k"))
    ranges = keys.select("k", key_ranges(keys, "k").alias("part"))
    found = {r["part"]: (r["lo"], r["n"]) for r in ranges.groupBy("part").agg(F.min("k").alias("lo"), F.count("*").alias("n")).collect()}
    assert found.pop(None) == (None, 1)
    assert sorted(found) == list(range(64)) and max(n for _, n in found.values()) < 4 * 100_000 / 64
    assert [found[p][0] for p in range(64)] == sorted(lo for lo, _ in found.values())
    few = keys.limit(500)
    assert few.select(key_ranges(few, "k").alias("part")).where("part is not null").distinct().count() == 1


def test_partitions_are_written_by_the_task_that_holds_them(spark, tmp_path):
    out = VersionedTable(f"file://{tmp_path}/t", by="part")
    rows = spark.range(4_000).repartition(8).select("id", (F.col("id") % 4).alias("part"))
    out.write(rows)
    assert out.read(spark).count() == 4_000
    assert len(list(tmp_path.glob("t/version=1/part=*/*.parquet"))) == 4


def test_tasks_follow_the_rows(spark):
    left, right = spark.range(2_000).toDF("a"), spark.range(2_000).toDF("b")
    dealt, other = spread_by_key(left, "a", right, "b", rows_per_task=100)
    assert (dealt.rdd.getNumPartitions(), other.rdd.getNumPartitions()) == (20, 20)
    assert dealt.join(other, F.col("a") == F.col("b")).count() == 2_000
    assert dealt_out(left, "a", rows_per_task=150).rdd.getNumPartitions() == 14


def test_rows_tied_on_the_order_are_chosen_alike(spark):
    rng = random.Random(3)
    data = [(i % 5, None if i % 2 else i % 3, [i], {"k": i}) for i in range(60)]
    chosen = set()
    for _ in range(3):
        rng.shuffle(data)
        df = spark.createDataFrame(data, "k int, o int, v array<int>, m map<string,int>").coalesce(1)
        for pick in (first_by_key, last_by_key):
            plain = pick(df.drop("m"), ["k"], ["o"])
            assert plain.columns == ["k", "o", "v"]
            chosen.add((pick.__name__, str(sorted(map(tuple, plain.collect())))))
        assert first_by_key(df, ["k"], ["o"]).where("m['k'] = v[0]").count() == 5  # a map cannot be compared
    assert len(chosen) == 2
