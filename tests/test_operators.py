from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from filigree.functions import arrays, text
from filigree.functions.ordering import order_by
from filigree.operators import joins as j
from filigree.operators import keyed as k
from filigree.operators import windows as w
from filigree.operators.aggregates import quantiles
from filigree.operators.keyed import first_by_key, last_by_key
from filigree.operators.numbering import append_numbers, global_row_number
from filigree.operators.schemas import check_required, compare_schemas, schema_verdict
from filigree.plans.features import add_flags, drop_flags
from filigree.plans.runlog import RunLog, step_durations
from filigree.session import CHECKPOINT_KEY, shared_dir
from filigree.sinks import writers
from filigree.sinks.versions import VersionedTable
from filigree.sources import readers as r


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_nulls_sort_last_both_ways(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "x int")
    assert [v["x"] for v in order_by(df, "x").collect()] == [1, 2, None]
    assert [v["x"] for v in order_by(df, "-x").collect()] == [2, 1, None]


def test_global_numbers_with_ties_and_nulls(spark):
    df = spark.createDataFrame([(i % 3 if i % 5 else None,) for i in range(200)], "x int").repartition(5)
    out = global_row_number(df, ["x"], "n", start=10, partitions=6).orderBy("n").collect()
    assert [v["n"] for v in out] == list(range(11, 211))
    values = [v["x"] for v in out]
    assert values == sorted(values, key=lambda v: (v is None, v))
    more = append_numbers(spark.createDataFrame([], "n bigint"), df.limit(2), "n", ["x"])
    assert sorted(v["n"] for v in more.collect()) == [1, 2]


def test_running_by_ranges_equals_window(spark):
    data = [(i % 2 if i % 7 else None, i, float(i % 4) if i % 3 else None) for i in range(120)]
    df = spark.createDataFrame(data, "g int, i int, v double")
    usual = w.running(df, ["g"], ["i"], "v")
    assert rows(w.running(df, ["g"], ["i"], "v", hot_rows=1)) == rows(usual)


@pytest.mark.parametrize("hot_rows", [1_000_000, 3])
def test_exact_quantiles_equal_percentile(spark, hot_rows):
    data = [(i % 3 if i % 11 else None, float(i * i % 17) if i % 5 else None) for i in range(200)]
    df = spark.createDataFrame(data, "g int, v double")
    points = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    usual = df.groupBy("g").agg(*quantiles("v", points))
    assert rows(w.exact_quantiles(df, ["g"], "v", points, hot_rows=hot_rows)) == rows(usual)


def test_store_frame_windows(spark):
    data = [("A", 1, 100), ("A", 2, 150), ("A", 3, 200), ("B", 1, 80), ("B", 2, 90), ("B", 3, 110)]
    df = spark.createDataFrame(data, "store string, day int, sales int")
    totals = w.with_group_aggregates(df, ["store"], {"total": F.sum("sales"), "best": F.max("sales")})
    assert {(v["store"], v["total"]) for v in totals.collect()} == {("A", 450), ("B", 280)}
    tied = spark.createDataFrame([("A", 5), ("A", 5), ("A", 9)], "store string, sales int")
    assert sorted(v["rank"] for v in w.average_rank(tied, ["store"], "sales").collect()) == [1.5, 1.5, 3.0]


@pytest.mark.parametrize(("listed", "expected"), [([1], [2]), ([1, None], []), ([], [1, 2, None])])
def test_not_in_is_null_aware(spark, listed, expected):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    keys = spark.createDataFrame([(v,) for v in listed], "k int")
    assert [v["k"] for v in j.not_in(df, keys, "k").collect()] == expected


def test_broadcast_only_below_the_checked_size(spark):
    df = spark.range(100)

    def plan(part):
        return part._jdf.queryExecution().logical().toString()

    assert "hint" in plan(j.broadcast_up_to(df, 1600)).lower()
    assert "hint" not in plan(j.broadcast_up_to(df, 1599)).lower()
    text = spark.createDataFrame([("é" * 500,), (None,)], "s string")
    assert "hint" not in plan(j.broadcast_up_to(text, 1000)).lower()


def test_any_of_three_conditions(spark):
    listed = spark.createDataFrame([(1, 1, "A", "T"), (2, 2, "B", "U"), (3, 9, None, None), (4, 9, "", None)], "sid int, cik int, p string, t string")
    dim = spark.createDataFrame([(7, "xa", ["U"])], "cik_int int, name string, tickers array<string>")
    pairs = j.any_of_join(listed, dim, "sid", "cik_int", ("cik", "cik_int"), ("p", "name"), ("t", "tickers"))
    assert rows(pairs) == [(1, 7), (2, 7), (4, 7)]


def test_contains_join_with_very_many_patterns(spark):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    names = [word(rng.randint(0, 14)) for _ in range(300)] + [None, ""]
    patterns = sorted({word(rng.randint(1, 7)) for _ in range(20_000)}) + [None, ""]
    left = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, name string")
    right = spark.createDataFrame([(k, p) for k, p in enumerate(patterns)], "k int, pattern string")
    got = {(r.i, r.k) for r in j.contains_join(left, right, "name", "pattern").collect()}
    assert got == {(i, k) for i, n in enumerate(names) for k, p in enumerate(patterns) if n is not None and p is not None and p in n}


def test_running_sums_of_doubles_on_both_paths(spark):
    rng = random.Random(2)
    data = [(k % 3, k, rng.uniform(-1e6, 1e6) if k % 7 else 0.1) for k in range(900)]
    df = spark.createDataFrame(data, "g int, o int, x double").repartition(5)
    plain, ranges = ({tuple(r) for r in w.running(df, ["g"], ["o"], "x", hot_rows=h).select("g", "o", "row_num", "running_sum", "previous").collect()} for h in (10**6, 0))
    assert plain == ranges


def test_nulls_come_last_when_choosing_rows(spark):
    df = spark.createDataFrame([("a", None, "unscored"), ("a", 5, "scored"), ("b", None, "only"), ("a", 9, "worse")], "k string, o int, v string")
    assert {(r.k, r.v) for r in first_by_key(df, ["k"], ["o"]).collect()} == {("a", "scored"), ("b", "only")}
    assert {(r.k, r.v) for r in last_by_key(df, ["k"], ["o"]).collect()} == {("a", "worse"), ("b", "only")}


def test_keyed_changes(spark):
    base = spark.createDataFrame([("a", 1, "old"), ("b", 1, "old"), (None, 1, "old")], "k string, o int, v string")
    new = spark.createDataFrame([("b", 0, "new"), ("c", 0, "x"), ("c", 2, "y")], "k string, o int, v string")
    merged = k.dedupe_last([base, new], ["k"], ["o"])
    assert rows(merged.select("k", "v")) == sorted([("a", "old"), ("b", "new"), ("c", "y"), (None, "old")], key=repr)
    once = k.upsert(base, k.dedupe_last([new], ["k"], ["o"]), "k")
    assert rows(k.upsert(once, k.dedupe_last([new], ["k"], ["o"]), "k")) == rows(once)
    filled = k.update_null_from(
        spark.createDataFrame([("a", None), ("b", "own")], "k string, t string"),
        spark.createDataFrame([("a", "z"), ("a", "m"), ("b", "q")], "k string, t string"), "k", "t",
    )
    assert rows(filled) == [("a", "m"), ("b", "own")]


def test_schema_comparison(spark):
    left = spark.sql("SELECT 1 AS cik, 'x' AS sic, timestamp'2020-01-01' AS at, array('a') AS tickers, 1 AS only_left")
    right = spark.sql("SELECT '1' AS cik, 'x' AS SIC, timestamp_ntz'2020-01-01' AS at, 2 AS only_right")
    found = compare_schemas(left, right, {"SIC": "sic"}, ["tickers"])
    assert {v["column_name"]: v["status"] for v in found.collect()} == {
        "cik": "type_difference", "sic": "match", "at": "time_precision", "tickers": "derived", "only_left": "left_only",
        "only_right": "right_only",
    }
    verdict = schema_verdict(found).first()
    assert (verdict["critical_issues"], verdict["verdict"]) == (3, "needs_attention")
    assert schema_verdict(compare_schemas(left, left)).first()["verdict"] == "compatible"
    needed = {v["column_name"]: v["status"] for v in check_required(["cik", "only_left", "form"], left, right).collect()}
    assert needed == {"cik": "both", "only_left": "one", "form": "none"}


def test_text_helpers(spark):
    df = spark.createDataFrame([("Net  sales of $1.5 (up 3%)",), ("",), (None,)], "t string")
    out = df.select(
        text.blank_count(F.col("t")).alias("b"), text.split_count(F.col("t")).alias("s"), text.word_count(F.col("t")).alias("w"),
        text.tokens(F.col("t")).alias("k"),
    ).collect()
    assert tuple(out[0]) == (7, 7, 6, ["net", "sales", "of", "$1.5", "up", "3%"])
    assert tuple(out[1])[:3] == (1, 1, 0) and out[2]["w"] == 0
    words = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "w array<string>")
    grams = words.select(text.ngrams(F.col("w"), 2).alias("n"), text.shingles(F.col("w"), 2).alias("s")).collect()
    assert [tuple(v) for v in grams] == [(["a b", "b c"], ["a b", "b c"]), ([], ["a"]), ([], [""])]


def test_names_and_dates(spark):
    df = spark.createDataFrame(
        [("Apple Inc", "2019-09-28"), ("ACME CO.", "2019/09/28"), ("Foo LTD", "20190928"), ("Bar PLC", "soon")], "n string, d string"
    )
    out = df.select(text.normalise_name(F.col("n")).alias("n"), text.parse_date(F.col("d")).cast("string").alias("d")).collect()
    assert [tuple(v) for v in out] == [
        ("APPLE INC", "2019-09-28"), ("ACME", "2019-09-28"), ("FOO", "2019-09-28"), ("BAR", None),
    ]


def test_practice_lists(spark):
    toy = spark.createDataFrame(
        [("A_2020", ["ABC", "ABC.A"]), ("A_2020", ["ABC", "ABC.A"]), ("B_2021", ["XYZ"]), ("C", [])], "d string, t array<string>"
    )
    merged = toy.groupBy("d").agg(arrays.distinct_sorted(F.col("t")).alias("m"))
    assert {v["d"]: v["m"] for v in merged.collect()} == {"A_2020": ["ABC", "ABC.A"], "B_2021": ["XYZ"], "C": []}
    x = spark.createDataFrame([([1, 2, 3],), ([6, 5, 4],)], "x array<int>")
    out = x.select(
        F.array_max("x"), arrays.list_sum(F.col("x")), arrays.multiply_lists(F.col("x"), arrays.add_to_each(F.col("x"), 3)),
        arrays.between_each(F.col("x"), 2, 4),
    ).collect()
    assert [tuple(v) for v in out] == [(3, 6, [4, 10, 18], [False, True, True]), (6, 15, [54, 40, 28], [False, False, True])]
    upper = spark.createDataFrame([("foo1", 6, "abc"), ("bar1", 4, "def"), (None, 1, "ghi")], "x string, y int, z string")
    changed = text.upper_strings_where(upper, F.startswith("x", F.lit("foo")))
    assert rows(changed) == sorted([("FOO1", 6, "ABC"), ("bar1", 4, "def"), (None, 1, "ghi")], key=repr)


def test_flags_and_fixed_stems(spark):
    df = spark.createDataFrame([("Revenue increased vs. 2019 by $5 million.", 2019)], "sentence string, report_year int")
    kept, fixed = add_flags(df).first(), add_flags(df, fixed=True).first()
    assert kept["likely_kpi"] and kept["has_numbers"] and kept["mentions_years"] and kept["is_recent"]
    assert not kept["has_comparison"] and fixed["has_comparison"]
    assert (kept["retrieval_signal_score"], fixed["retrieval_signal_score"]) == (6, 8)
    assert drop_flags(add_flags(df)).columns == df.columns


def test_versions_publish_and_retention(spark, tmp_path):
    table = VersionedTable(str(tmp_path / "t"), max_versions=2)
    assert table.read(spark) is None
    for n in (1, 2, 3):
        table.write(spark.range(n))
    staged = table.stage(spark.range(99))
    assert table.versions(spark) == [2, 3] and table.read(spark).count() == 3
    table.publish(spark, staged)
    assert table.read(spark).count() == 99
    rejected = table.stage(spark.range(5))
    table.discard(spark, rejected)
    assert table.versions(spark, published=False) == [3, 4]
    with pytest.raises(ValueError):
        table.discard(spark, 4)


def test_versions_by_partition_share_folders(spark, tmp_path):
    table = VersionedTable(str(tmp_path / "t"), max_versions=1, by="p")
    table.write(spark.createDataFrame([(1, "a", "01"), (2, "b", "02"), (3, "c", None)], "k long, v string, p string"))
    first = table.parts(spark, 1)
    staged = table.stage(spark.createDataFrame([(2, "B", "02"), (9, "n", "09")], "k long, v string, p string"), over=1)
    assert rows(table.read_version(spark, staged, own=True)) == [(2, "B", "02"), (9, "n", "09")]
    table.publish(spark, staged)
    after = table.parts(spark, staged)
    assert after["p=01"] == first["p=01"] and after["p=02"] != first["p=02"] and table.versions(spark) == [2]
    assert rows(table.read(spark)) == [(1, "a", "01"), (2, "B", "02"), (3, "c", None), (9, "n", "09")]
    assert not (tmp_path / "t" / first["p=02"]).exists() and (tmp_path / "t" / first["p=01"]).exists()


def test_files(spark, tmp_path):
    path = writers.write_parquet(spark.range(5000).repartition(3), str(tmp_path / "p"), block_bytes=1 << 20)
    files = r.file_inventory(spark, path).collect()
    real = {f.name: f.stat().st_size for f in (tmp_path / "p").glob("*.parquet")}
    assert sum(f["n_rows"] for f in files) == 5000 and {f["path"].rsplit("/")[-1]: f["bytes"] for f in files} == real
    (tmp_path / "t.json").write_text('{"0":{"cik_str":320193,"ticker":"AAPL","title":"Apple Inc."},"1":{"cik_str":7,"ticker":"X","title":"Y"}}')
    assert set(rows(r.read_ticker_map(spark, str(tmp_path / "t.json")))) == {(7, "X", "Y"), (320193, "AAPL", "Apple Inc.")}
    (tmp_path / "h.csv").write_text('Fund Name:,SPDR\nName,Ticker\nHoldings:,As of 15-Oct-2025\n Apple , AAPL ,1,2,"1,006.5",Tech,"1,234",USD\nCash,-,,,,,,\n')
    held = r.read_holdings(spark, str(tmp_path / "h.csv")).collect()
    assert [(h["company_name"], h["ticker"], h["weight_pct"], h["shares_held"]) for h in held] == [("Apple", "AAPL", 1006.5, 1234)]
    assert writers.snapshot_path("/x/", "org/ds:1", "train", "s300", "small_full") == "/x/org__ds__1__small_full__train__s300.parquet"
    view = writers.create_table(spark.range(3), "some_view", temporary=True)
    table = writers.create_table(spark.range(4), "some_table", path=str(tmp_path / "tbl"))
    assert (view.count(), table.count()) == (3, 4)
    assert [c["column_name"] for c in r.catalog_columns(spark, "some_table").collect()] == ["id"]
    spark.sql("DROP TABLE some_table")


def test_run_log(spark):
    log = RunLog()
    log.add("load", 10)
    log.add("write", 10, "done")
    timed = step_durations(log.frame(spark)).orderBy("step_number").collect()
    assert timed[0]["step_seconds"] is None and timed[1]["step_seconds"] >= 0


class FakeSession:
    """A session that knows only its master and, maybe, the checkpoint setting."""

    def __init__(self, master: str, folder: str | None = None):
        self.conf = self.sparkContext = self
        self.master, self.folder, self.current = master, folder, None

    def get(self, key, default=None):
        return self.folder if key == CHECKPOINT_KEY else default

    def getConf(self):
        return self

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, folder):
        self.current = folder


def test_shared_folder_is_the_configured_one():
    cluster = FakeSession("spark://host:7077", "s3a://shared/checkpoints/")
    assert shared_dir(cluster) == "s3a://shared/checkpoints" and cluster.current is not None
    with pytest.raises(RuntimeError):
        shared_dir(FakeSession("spark://host:7077"))
    assert shared_dir(FakeSession("local[2]"))


def test_running_keeps_whole_doubles(spark):
    """Small digits, large values and NaN, in one window and by ranges."""
    values = [1e-12, 0.123456789012345, 2.5, 1e18, -1e18, 3.0, None, float("nan"), 1.0]
    df = spark.createDataFrame([(1, k, v) for k, v in enumerate(values)] + [(2, 0, 1e-12), (2, 1, 2e-12)], "g int, o int, x double")
    for hot in (10**6, 0):
        got = {(r.g, r.o): r for r in w.running(df, ["g"], ["o"], "x", hot_rows=hot).collect()}
        assert got[2, 1].running_sum == pytest.approx(3e-12, rel=1e-12) and got[2, 1].previous == 1e-12
        for k in range(1, len(values)):
            before = got[1, k].previous
            assert before == values[k - 1] or (before != before and values[k - 1] != values[k - 1])
        assert got[1, 2].running_sum == pytest.approx(2.623456789013345, rel=1e-15)
        assert got[1, 3].running_sum == pytest.approx(1e18) and got[1, 6].running_sum is not None
        assert got[1, 7].running_sum != got[1, 7].running_sum and got[1, 8].running_sum != got[1, 8].running_sum
