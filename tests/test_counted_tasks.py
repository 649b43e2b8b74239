"""Grain tables and distinct counts whose tasks follow the counted rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from filigree.operators import aggregates as a
from filigree.plans.profiles import section_overview


@pytest.fixture
def rows(spark):
    data = [(i % 7 if i % 5 else None, f"d{i % 11}" if i % 4 else None, 1990 + i % 3, i % 2 if i % 9 else None) for i in range(200)]
    return spark.createDataFrame(data, "cik int, docID string, report_year int, section int")


def test_grain_is_dealt_out_by_counted_rows(spark, rows, monkeypatch):
    dealt = a.dealt_out
    monkeypatch.setattr(a, "dealt_out", lambda df, *keys: dealt(df, *keys, rows_per_task=10))
    grain = a.grain_counts(rows, ["cik", "docID"])
    assert grain.rdd.getNumPartitions() == 20  # not merged by their bytes
    assert {tuple(r) for r in grain.collect()} == {tuple(r) for r in rows.groupBy("cik", "docID").count().collect()}


@pytest.mark.parametrize("rows_per_task", [7, 500_000])
def test_distinct_by_group_equals_distinct_counts(rows, rows_per_task):
    grain = rows.groupBy("cik", "docID", "section").agg(F.count("*").alias("n"))
    got = a.distinct_by_group(grain, "section", {"cik": "x", "docID": "y"}, "n", rows_per_task)
    want = rows.groupBy("section").agg(F.countDistinct("cik").alias("x"), F.countDistinct("docID").alias("y"), F.count("*").alias("n"))
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}
    assert "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_overview_holds_no_row_twice(rows):
    assert "Expand" not in section_overview(rows)._jdf.queryExecution().optimizedPlan().toString()
