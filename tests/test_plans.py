"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql.functions import lit

import __spark_entry__ as contract
from finledger.operators import audit, hierarchy
from finledger.plans import curation, lake, mart

CHECKED = [
    "scan_projection", "eligible_entities", "filter_funnel", "scale_normalise", "dedup_latest", "latest_filing", "is_leaf",
    "join_inner", "level_names_join", "curated_bp", "curated_dre", "parent_child_check", "cash_reconciliation",
    "variable_coverage", "indicator_mart", "benchmark_long", "median_sector", "median_sector_distributed", "risk_score",
    "score_peer_rank", "score_peer_rank_distributed", "indicator_ranking", "indicator_snapshot", "indicator_mart_simple",
    "outlier_distance", "class_mix_by_year", "pending_files", "missing_periods",
]


def plan_of(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", CHECKED)
def test_no_nested_loops_and_no_python(spark, data_dir, name):
    plan = plan_of(contract.queries()[name](spark, data_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "MapInPandas" not in plan and "Python" not in plan


def test_scan_reads_only_what_is_needed(spark, data_dir):
    plan = plan_of(contract.queries()["current_period_filter"](spark, data_dir))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "l_tax" not in schema and "l_linestatus" not in schema


def test_stored_lines_are_pruned(spark, data_dir):
    lines = lake.silver_lines(spark, data_dir)
    plan = plan_of(audit.cash_identity(curation.repaired_values(lines, "DFC").withColumn("DENOM_CIA", lit("x"))))
    assert re.search(r"PartitionFilters: .*GRUPO_DFP_TRATADO#\d+ = DFC", plan)
    assert "MOEDA" not in re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    direct = plan_of(lines.filter("CD_CONTA = '6.05.02'").select("CNPJ_CIA", "VL_CONTA_TRATADO"))
    assert "EqualTo(CD_CONTA,6.05.02)" in direct
    assert re.search(r"ReadSchema: struct<CNPJ_CIA:string,CD_CONTA:string,VL_CONTA_TRATADO:decimal\(28,6\)>", direct)


def test_dedup_reduces_before_the_shuffle(spark, data_dir):
    plan = plan_of(mart.newest_balances(mart.mart_lines(lake.typed_lines(spark, data_dir))))
    tree = plan[: plan.index("\n(1)")]
    partial = [i for i, line in enumerate(tree.splitlines()) if "WindowGroupLimit" in line]
    exchange = [i for i, line in enumerate(tree.splitlines()) if "Exchange" in line and "Broadcast" not in line]
    assert len(partial) == 2 and partial[0] < exchange[0] < partial[1]


def test_repair_shuffles_once_after_the_collapse(spark, data_dir):
    lines = lake.silver_lines(spark, data_dir)
    extract = curation.statement_extract(lines, curation.STATEMENTS["BP"])
    collapsed = curation.collapsed_statement(extract)
    before = plan_of(collapsed).split("\n(1)")[0].count("Exchange")
    after = plan_of(hierarchy.roll_up(collapsed, "safe", 2, 5, carry=["REPORTADO"])).split("\n(1)")[0]
    assert after.count("Exchange") == before + 1
    assert "Join" not in after


def test_mart_shuffles_lines_once_per_step(spark, data_dir):
    plan = plan_of(lake.mart(spark, data_dir)).split("\n(1)")[0]
    # small-input spread, dedup, pivot, registry, join of the mart with it, company windows
    assert plan.count("Exchange") - plan.count("BroadcastExchange") <= 7


def test_one_statement_is_cut_out_before_anything_is_written(spark, data_dir):
    lines = lake.statement_lines(spark, data_dir, "DRE")
    assert "silver_lines" not in plan_of(lines)
    whole = lake.silver_lines(spark, data_dir).filter("GRUPO_DFP_TRATADO = 'DRE'").select(*lines.columns)
    assert lines.count() == whole.count() > 0 and lines.exceptAll(whole).count() == 0


def test_lines_stored_by_filing_need_no_exchange(spark, data_dir):
    """Newest filing, repeated lines, collapse and repair are planned from the layout of the stored table."""
    bronze, registry = lake.bronze_by_filing(spark, data_dir, buckets=6), lake.ledger.registry(spark, data_dir)
    for code in ("BP", "DRE", "DFC"):
        found = lake.repaired_in_place(bronze, registry, code)
        exchanges = re.findall(r"^\(\d+\) (\w*Exchange)", plan_of(found), flags=re.M)
        assert set(exchanges) <= {"BroadcastExchange"}, exchanges
        want = lake.repaired(spark, data_dir, code).select(found.columns)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))
    assert "SelectedBucketsCount: 6 out of 6" in plan_of(found)
