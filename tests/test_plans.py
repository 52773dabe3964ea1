"""Plans of the queries: what is read, joined and moved."""

import re

import pytest

import __spark_entry__ as contract

from orefold.workload.queries import QUERIES

from .conftest import plan_of

SF_DIR = "/root/testdata/sf0.001"
TOTALS_ONLY = {
    "q02b_ragged_rows", "q07c_cast_rejects", "q10_dedupe_audit", "q29_kpi_distinct", "q30_kpi_mean_of_means",
    "q37h_committed_rows",
}
WRITES_FIRST = {
    "q03_publish_roundtrip", "q05_rewrite_in_place", "q37_layered_build", "q37f_rebuilt_from_bronze", "q37g_quarantine",
}


def plan(spark, name):
    return plan_of(contract.queries()[name](spark, SF_DIR))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES_FIRST))
def test_no_python_no_cross_join_no_single_task(spark, name):
    text = plan(spark, name)
    for word in ("BatchEvalPython", "ArrowEvalPython", "Cartesian", "BroadcastNestedLoop"):
        assert word not in text
    main = text.split("===== Subqueries =====")[0]
    if name not in TOTALS_ONLY:
        assert "SinglePartition" not in main
    # One-row totals come from partial results: the single task gets one row per task.
    for single in re.finditer(r"SinglePartition", text):
        before = text[: single.start()]
        assert "partial_" in before[before.rindex("Functions"):]


def test_pruning_and_pushdown(spark):
    text = plan(spark, "q12_filter_equals")
    assert "EqualTo(o_orderstatus,F)" in text
    text = plan(spark, "q18_dim_snapshot")
    assert "LessThanOrEqual(p_size,25)" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string,p_size:int,p_retailprice:double>" in text
    text = plan(spark, "q19_enrich_left")
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in text
    text = plan(spark, "q25_pct_flag")
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_linestatus:string>" in text


@pytest.mark.parametrize("name", ["q19_enrich_left", "q20_silver_enriched", "q21_gold_by_key"])
def test_small_dimension_is_broadcast(spark, name):
    assert "BroadcastHashJoin LeftOuter BuildRight" in plan(spark, name)


@pytest.mark.parametrize("name", ["q21_gold_by_key", "q22_gold_by_style", "q24_gold_by_segment"])
def test_summaries_aggregate_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert "partial_sum" in text and "partial_count" in text


def test_top_k_keeps_k_rows_per_task(spark):
    for name in ("q28_topk_efficient", "q36_sample_limit"):
        assert "TakeOrderedAndProject" in plan(spark, name)


def test_sample_is_picked_before_the_join(spark):
    text = plan(spark, "q36_sample_limit")
    tree = text[: text.index("\n\n\n")]
    assert tree.index("BroadcastHashJoin") < tree.index("TakeOrderedAndProject")


def test_one_scan_of_silver_for_all_gold_tables(spark):
    from orefold.plans.gold import build_gold_tables, gold_parts
    from orefold.workload.lines import LINES
    from orefold.workload.queries import built_silver

    silver = built_silver(spark, SF_DIR)
    for pre_aggregate in (False, True):
        text = plan_of(gold_parts(silver, LINES.gold, pre_aggregate=pre_aggregate))
        tree = text[: text.index("\n\n\n")]
        assert tree.count("Scan parquet") == 1 and tree.count("Expand") == 1
        # Rows outside a table's filter go before they are summed up.
        assert tree.index("Expand") > tree.index("Filter") > tree.index("Exchange")
    for table in build_gold_tables(silver, LINES.gold).values():
        assert "lines_enriched" not in plan_of(table)


def test_the_snapshot_prunes_folders_of_the_stored_dimension(spark):
    text = plan(spark, "q37i_stored_snapshot")
    assert re.search(r"PartitionFilters: \[.*p_size#\d+ <= 25", text)
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string,p_retailprice:double>" in text


def test_buckets_save_the_shuffle(spark):
    text = plan(spark, "q21b_gold_bucketed")
    assert "Bucketed: true" in text and "Exchange" not in text


def test_strict_casts_stay_one_expression(spark, conf):
    text = plan(spark, "q24_gold_by_segment")
    assert "CAST_INVALID_INPUT" not in text and "cast(" in text
    conf("spark.sql.ansi.enabled", "false")
    assert "CAST_INVALID_INPUT" in plan(spark, "q24_gold_by_segment")


def test_fingerprints_move_no_unique_rows(spark):
    text = plan(spark, "q09c_dedupe_wide")
    anti = text[: text.index("\n\n\n")]
    assert "BroadcastHashJoin LeftAnti" in anti and "BroadcastHashJoin LeftSemi" in anti
