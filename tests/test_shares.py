"""Stored hash shares: nesting, pruned scans, null and hot keys."""

from __future__ import annotations

from hashlib import md5

import pytest

from filigree.plans.subsets import read_share, write_shares


def bucket(key):
    return int(md5(("" if key is None else str(key)).encode()).hexdigest()[:8], 16) % 100


def test_shares_nest_and_prune(spark, tmp_path):
    rows = [(None if i % 50 == 0 else 7 if i % 3 == 0 else i, i) for i in range(600)]
    folder = write_shares(spark.createDataFrame(rows, "k long, v long"), "k", str(tmp_path / "s"))
    held = {n: sorted(r["v"] for r in read_share(spark, folder, n).collect()) for n in (0, 14, 35, 100)}
    for n, got in held.items():
        assert got == sorted(v for k, v in rows if bucket(k) < n)
    assert set(held[14]) < set(held[35]) and len(held[100]) == 600
    share = read_share(spark, folder, 14)
    assert "PartitionFilters: [isnotnull(share_bucket" in share._jdf.queryExecution().executedPlan().toString()
    read = {f.split("share_bucket=")[1].split("/")[0] for f in (r[0] for r in share.select("_metadata.file_path").distinct().collect())}
    assert all(int(b) < 14 for b in read)


def test_shares_of_nothing_and_a_taken_name(spark, tmp_path):
    with pytest.raises(ValueError):
        write_shares(spark.createDataFrame([(1, 2)], "k long, share_bucket long"), "k", str(tmp_path / "s"))
