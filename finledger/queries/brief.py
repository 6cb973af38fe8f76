"""Registered queries of the indicator brief, and reads of a report that the other modules do not have."""

from __future__ import annotations

from pyspark.sql import functions as F

from finledger.operators import hierarchy
from finledger.plans import benchmark, brief, curation, lake, mart, serving
from finledger.queries.report import report
from finledger.session import materialise


def _stacked(spark, sf):
    return mart.stack_statements(lake.curated_all(spark, sf))


def base_balances(spark, sf):
    return report(brief.base_balances(_stacked(spark, sf)), [*brief.BASE_ACCOUNTS, *brief.BASE_GROUPS])


def indicator_brief(spark, sf):
    table = brief.indicator_table(brief.base_balances(_stacked(spark, sf)))
    return report(table, ["VL_NUMERADOR", "VL_DENOMINADOR"], ["VL_INDICADOR"], places=4)


def variable_contract(spark, sf):
    return brief.variable_contract(lake.repaired_accounts(spark, sf))


def indicator_formulas(spark, sf):
    return brief.indicator_formulas(lake.repaired_accounts(spark, sf))


def overview_snapshot(spark, sf):
    shown = serving.overview_snapshot(lake.stored_mart(spark, sf))
    return report(shown, ["AT", "PL", "REC_LIQ", "EBITDA", "LUCRO_LIQ", "DIVIDA_LIQUIDA"])


def priority_history(spark, sf):
    long = benchmark.unpivot_indicators(lake.mart(spark, sf))
    return report(serving.priority_history(long), [], ["VL_INDICADOR"], places=4)


def _highlights(code: str):
    def query(spark, sf):
        return report(serving.highlights(lake.curated(spark, sf, code), code), ["VL_CONTA_TRATADO"])

    return query


def prefer_reported(spark, sf):
    """Income lines where both a reported and a rebuilt value exist: the reported one stays."""
    extract = materialise(curation.statement_extract(lake.statement_lines(spark, sf, "DRE"), curation.STATEMENTS["DRE"]), "extract")
    keys = ["CNPJ_CIA", "DT_REFER", "CD_CONTA", "VL_CONTA_TRATADO"]
    reported = hierarchy.collapse_accounts(extract).select(*keys, F.lit(False).alias("FLAG_RECONSTRUCAO"))
    deepest, lines = hierarchy.tree_size(extract)
    repaired = curation.repaired_statement(extract, curation.STATEMENTS["DRE"], deepest, rows=lines)
    rebuilt = repaired.filter(F.col("ACAO").isin("filled", "forced", "inserted")).select(*keys, F.lit(True).alias("FLAG_RECONSTRUCAO"))
    return report(mart.prefer_reported(reported.unionByName(rebuilt)), ["VL_CONTA_TRATADO"])


QUERIES = {
    f.__name__: f
    for f in [
        base_balances, indicator_brief, variable_contract, indicator_formulas, overview_snapshot, priority_history, prefer_reported,
    ]
} | {"statement_highlights_bp": _highlights("BP"), "statement_highlights_dfc": _highlights("DFC")}
