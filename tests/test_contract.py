"""The driver contract, and agreement with DuckDB on the small tables."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

import __spark_entry__ as contract
from tests.conftest import table_of

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# One query per family; FINLEDGER_ALL=1 runs every registered one.
CHOSEN = [
    "scan_delimited", "scan_archive", "source_catalog", "derive_table_name", "stage_text", "schema_drift",
    "load_log_counts", "pending_files", "load_events", "stream_intake", "eligible_entities", "filter_funnel",
    "statement_class", "scale_normalise", "dedup_latest", "latest_filing", "is_leaf", "hierarchy_rollup_safe",
    "hierarchy_rollup_force", "golden_names", "level_names_join", "curated_bp", "curated_dre", "curated_dfc",
    "cash_reconciliation", "variable_coverage", "missing_periods", "indicator_mart", "curated_mart",
    "indicator_mart_simple", "benchmark_long", "median_sector_distributed", "risk_score", "score_peer_rank",
    "score_peer_rank_distributed", "indicator_ranking", "indicator_long_status", "sector_scorecard", "alert_radar",
    "executive_summary", "cagr",
]
NAMES = sorted(contract.queries()) if os.environ.get("FINLEDGER_ALL") else CHOSEN


def test_import_needs_no_session():
    code = "import __spark_entry__ as e; assert len(e.queries()) > 100 and set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert {"CNPJ_CIA", "ANO_FISCAL", "LIQ_CORRENTE", "EFEITO_TESOURA"} <= set(df.columns)


@pytest.mark.parametrize("name", NAMES)
def test_agrees_with_duckdb(spark, duck, data_dir, name):
    df = contract.queries()[name](spark, data_dir)
    mine = table_of(df.columns, [tuple(r) for r in df.collect()])
    text = contract.oracle_sql().get(name)
    if text is None:
        assert mine[1]
        return
    cursor = duck.execute(text)
    theirs = table_of([d[0] for d in cursor.description], cursor.fetchall())
    assert mine[0] == theirs[0]
    assert mine[1] == theirs[1]


def test_oracles_type_their_own_fixed_values():
    folder = os.path.join(ROOT, "oracles")
    for name in os.listdir(folder):
        if name.endswith(".py"):
            with open(os.path.join(folder, name), encoding="utf-8") as handle:
                assert "finledger.schema" not in handle.read(), name
