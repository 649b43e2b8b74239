"""Registered queries against their SQL at the smallest scale; all of them with FILIGREE_ALL=1."""

from __future__ import annotations

import os

import pytest
from check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
REPRESENTATIVE = (
    "p1_tag_corpus", "a11_p2_allocate_unpivot", "p3_stratified_sample_by_bin", "p3_sample_hot_strata_by_slices", "p4_join_back",
    "p5_feature_flags", "j8_null_aware_not_in", "j11_theta_or_match", "a4_percentiles", "a9_grouping_sets_total",
    "w11_average_tie_rank", "w12_cumulative_by_ranges", "fn_date_format_chain", "prj2_rename_drop_reorder", "src5_holdings_sheet",
    "snk8_versions_keep_newest", "p11_schema_comparison_with_fill", "p13_merge_projection", "p15_notable_selection", "p31_filing_sizes",
    "p33_company_probe", "t1_top_ngrams_by_language", "t2_near_duplicates_by_section", "t3_kpi_signal_scan",
    "k1_kpi_records", "k3_kpi_report", "st1_streaming_merge", "st2_unique_on_ingest", "src3_file_inventory", "src8_union_of_splits",
    "src9_first_rows_of_stream", "p8_merge_into_partitions", "p8_merge_history", "p9_dedupe_sentences", "p17_resolved_entities",
    "p20_coverage_summary", "p30_corpus_scale", "a15_src2_column_profile", "a18_grain_check", "t5_section_fingerprint",
    "t7_guessed_text_columns_stats", "w12_cumulative_doubles", "w12_cumulative_doubles_by_ranges", "p39_join_quality",
    "v2_nearest_with_company_quota", "c1_sliding_chunks", "c2_density_chunks", "p27_nested_shares",
)
NAMES = sorted(oracle_sql()) if os.environ.get("FILIGREE_ALL") else REPRESENTATIVE


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, duck, name):
    assert compare(queries()[name](spark, FOLDER), duck, oracle_sql()[name]) is None


def test_names():
    assert set(oracle_sql()) <= set(queries())
    assert len(queries()) >= 200


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["temporal_bin", "n_sampled", "n_companies", "pct_of_sample"]
    assert df.count() == 3
