"""Registered queries over raw, consolidated and curated lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finledger import schema as S
from finledger.functions.expressions import digits, sector_label
from finledger.operators import audit, coverage, hierarchy, naming, normalise, rows
from finledger.plans import curation, lake, ledger, mart, serving
from finledger.queries.report import report
from finledger.session import materialise, work_path

VALUE = ["VL_CONTA_TRATADO"]


def _newest():
    return rows.newest_first(*ledger.NEWEST_FIRST)


# --- projections and filters ------------------------------------------------------------------


def scan_projection(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of the balance sheet with the columns a reader asks for."""
    return report(
        lake.typed_lines(spark, sf)
        .filter(F.col("GRUPO_DFP_TRATADO") == "BP")
        .select("CNPJ_CIA", "DENOM_CIA", "DT_REFER", "CD_CONTA", "VL_CONTA_TRATADO"),
        VALUE,
    )


def eligible_entities(spark, sf):
    return normalise.eligible_entities(ledger.registry(spark, sf))


def filter_funnel(spark, sf):
    return normalise.filter_funnel(ledger.registry(spark, sf))


def excluded_by_group(spark, sf):
    return normalise.excluded_by_group(ledger.registry(spark, sf))


def ilike_filter(spark, sf):
    lines = lake.raw_lines(spark, sf).filter(F.col("TABLE_NAME").contains("dmpl"))
    kept = normalise.equity_total_only(lines)
    return report(kept.groupBy("CNPJ_CIA", "DT_REFER").agg(F.count("*").alias("N"), F.sum("VL_CONTA").alias("TOTAL")), ["TOTAL"])


def current_period_filter(spark, sf):
    kept = normalise.current_period(lake.raw_lines(spark, sf), F.col("VERSAO") == 10)
    return report(
        kept.groupBy("CNPJ_CIA", "DT_REFER", "TABLE_NAME").agg(F.count("*").alias("N"), F.sum("VL_CONTA").alias("TOTAL")),
        ["TOTAL"],
    )


def scale_normalise(spark, sf):
    lines = lake.typed_lines(spark, sf).filter(F.col("VL_CONTA_TRATADO") != 0)
    return report(
        lines.groupBy("CNPJ_CIA", "CD_CONTA").agg(
            F.count("*").alias("N"), F.sum("VL_CONTA").alias("BRUTO"), F.sum("VL_CONTA_TRATADO").alias("TRATADO")
        ),
        ["BRUTO", "TRATADO"],
    )


def statement_class(spark, sf):
    lines = lake.typed_lines(spark, sf)
    return lines.groupBy("GRUPO_DFP", "GRUPO_DFP_TRATADO").agg(
        F.count("*").alias("N"), F.count_distinct("CNPJ_CIA").alias("EMPRESAS")
    )


def level_filter(spark, sf):
    lines = lake.typed_lines(spark, sf)
    return lines.groupBy(digits("CD_CONTA").alias("DIGITOS"), "GRUPO_DFP_TRATADO").agg(
        F.count("*").alias("N"), F.count_if(digits("CD_CONTA") <= 2 * 3 - 1).alias("ATE_NIVEL_3")
    )


def outlier_null(spark, sf):
    lines = lake.typed_lines(spark, sf).filter(F.col("CD_CONTA").isin(S.PER_SHARE_ACCOUNTS))
    kept = mart.drop_outliers(F.col("VL_CONTA_TRATADO"))
    return report(
        lines.groupBy("CNPJ_CIA", "CD_CONTA").agg(
            F.count("*").alias("N"), F.count(kept).alias("MANTIDOS"), F.max(kept).alias("MAXIMO")
        ),
        ["MAXIMO"],
    )


def sector_labels(spark, sf):
    return lake.companies(spark, sf).groupBy(sector_label("SETOR_ATIV").alias("SETOR_LABEL")).agg(F.count("*").alias("N"))


# --- choosing rows ----------------------------------------------------------------------------


def dedup_latest(spark, sf):
    newest = rows.newest_row(lake.typed_lines(spark, sf), ["CNPJ_CIA", "DT_FIM_EXERC_ANO", "CD_CONTA"], _newest())
    return report(newest.select("CNPJ_CIA", "DT_FIM_EXERC_ANO", "CD_CONTA", "VERSAO", "DT_REFER", "VL_CONTA_TRATADO"), VALUE)


def dedup_prefer_original(spark, sf):
    """Lines of the current exercise before those of the previous one, whatever their version."""
    lines = lake.typed_lines(spark, sf).withColumn("SECUNDARIO", F.col("ORDEM_EXERC") != "ÚLTIMO")
    chosen = rows.newest_row(lines, ["CNPJ_CIA", "DT_REFER", "CD_CONTA"], [F.col("SECUNDARIO").asc(), *_newest()])
    return report(chosen.select("CNPJ_CIA", "DT_REFER", "CD_CONTA", "SECUNDARIO", "VERSAO", "VL_CONTA_TRATADO"), VALUE)


def latest_filing(spark, sf):
    kept = rows.latest_filing(lake.typed_lines(spark, sf), ["CNPJ_CIA", "DT_REFER"])
    return report(
        kept.groupBy("CNPJ_CIA", "DT_REFER", "VERSAO").agg(F.count("*").alias("N"), F.sum("VL_CONTA_TRATADO").alias("TOTAL")),
        ["TOTAL"],
    )


def distinct_on(spark, sf):
    first = rows.newest_row(lake.typed_lines(spark, sf), ["CNPJ_CIA", "CD_CONTA"], _newest())
    return first.select("CNPJ_CIA", "CD_CONTA", F.upper(F.trim("DS_CONTA")).alias("DS_CONTA"), "VERSAO", "DT_REFER")


def distinct_entities(spark, sf):
    return serving.entities(lake.raw_lines(spark, sf))


def consolidate_sources(spark, sf):
    """The consolidated table by source table and statement."""
    lines = normalise.newest_lines(lake.raw_lines(spark, sf), ledger.registry(spark, sf))
    return report(
        lines.groupBy("_origem_tabela", "GRUPO_DFP_TRATADO").agg(
            F.count("*").alias("N"), F.count_distinct("CNPJ_CIA").alias("EMPRESAS"), F.sum("VL_CONTA_TRATADO").alias("TOTAL")
        ),
        ["TOTAL"],
    )


def is_leaf(spark, sf):
    n0 = normalise.consolidated_lines(lake.silver_lines(spark, sf))
    return report(
        n0.select("CNPJ_CIA", "DT_REFER", "VERSAO", "CD_CONTA", "LINE_ID", "LINE_SEQ", "VL_CONTA_TRATADO", "IS_LEAF"), VALUE
    )


def join_inner(spark, sf):
    """Lines of eligible companies per sector."""
    lines = lake.typed_lines(spark, sf).groupBy("CNPJ_CIA").agg(F.count("*").alias("n"), F.sum("VL_CONTA_TRATADO").alias("v"))
    joined = lines.join(normalise.eligible_entities(ledger.registry(spark, sf)), "CNPJ_CIA")
    return report(
        joined.groupBy("SETOR_ATIV").agg(F.count("*").alias("EMPRESAS"), F.sum("n").alias("LINHAS"), F.sum("v").alias("TOTAL")),
        ["TOTAL"],
    )


# --- hierarchy and naming ---------------------------------------------------------------------


def _extract(spark, sf, code):
    return curation.statement_extract(lake.statement_lines(spark, sf, code), curation.STATEMENTS[code])


def collapse_duplicates(spark, sf):
    collapsed = hierarchy.collapse_accounts(_extract(spark, sf, "BP"))
    return report(collapsed, VALUE)


def _values(spark, sf, code):
    return lake.repaired(spark, sf, code)


def _repaired(spark, sf, code):
    lines, depth = ledger.line_count(spark, sf), lake.chart_depth(code)
    return curation.repaired_statement(_extract(spark, sf, code), curation.STATEMENTS[code], depth, rows=lines)


def hierarchy_rollup_safe(spark, sf):
    return report(_repaired(spark, sf, "BP").select("CNPJ_CIA", "DT_REFER", "CD_CONTA", "VL_CONTA_TRATADO", "ACAO"), VALUE)


def hierarchy_rollup_force(spark, sf):
    return report(_repaired(spark, sf, "DRE").select("CNPJ_CIA", "DT_REFER", "CD_CONTA", "VL_CONTA_TRATADO", "ACAO"), VALUE)


def filing_layout(spark, sf):
    """Balance sheets and income statements repaired from lines stored by filing, without an exchange after the scan."""
    bronze, registry = lake.bronze_by_filing(spark, sf), ledger.registry(spark, sf)
    out = None
    for code in ("BP", "DRE"):
        part = lake.repaired_in_place(bronze, registry, code).select("CNPJ_CIA", "DT_REFER", "CD_CONTA", "VL_CONTA_TRATADO", "ACAO")
        out = part if out is None else out.unionByName(part)
    return report(out, VALUE)


def rollup_audit(spark, sf):
    out = None
    for code in curation.STATEMENTS:
        row = hierarchy.repair_counts(_repaired(spark, sf, code)).select(F.lit(code).alias("DEMONSTRATIVO"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def golden_names(spark, sf):
    return naming.golden_names(_extract(spark, sf, "DFC"), "DFC")


def golden_flag(spark, sf):
    return naming.golden_flags(_extract(spark, sf, "BP"))


def modal_scale(spark, sf):
    """The scale most of a company's lines are reported in."""
    lines = lake.raw_lines(spark, sf).select("CNPJ_CIA", F.upper(F.trim("ESCALA_MOEDA")).alias("ESCALA"))
    return rows.modal_value(lines, "CNPJ_CIA", "ESCALA")


def trace_flags(spark, sf):
    n1 = lake.curated(spark, sf, "DRE")
    return n1.select(
        "CNPJ_CIA", "DT_REFER", "CD_CONTA", "DS_CONTA", "DS_CONTA_REPORTADA", "FLAG_RECONSTRUCAO", "FLAG_NORMALIZACAO"
    )


def level_labels(spark, sf):
    n1 = lake.curated(spark, sf, "BP")
    return n1.select("CNPJ_CIA", "DT_REFER", "CD_CONTA", *[f"DS_NIVEL_{i}" for i in range(1, 6)])


def level_names_join(spark, sf):
    return hierarchy.level_names_by_filing(lake.silver_lines(spark, sf))


def is_leaf_global(spark, sf):
    return lake.curated(spark, sf, "BP").groupBy("CD_CONTA", "IS_LEAF").agg(F.count("*").alias("N"))


def is_leaf_entity(spark, sf):
    n1 = lake.curated(spark, sf, "BP", leaf_scope="entity")
    return n1.groupBy("CNPJ_CIA", "CD_CONTA", "IS_LEAF").agg(F.count("*").alias("N"))


def metadata_attach(spark, sf):
    meta = curation.filing_metadata(lake.silver_lines(spark, sf))
    return meta


def gap_fill(spark, sf):
    """Company metadata per date where some dates lack it."""
    lines = lake.typed_lines(spark, sf)
    holes = F.when(F.month("DT_REFER") == 12, F.col("CD_CVM"))
    dated = lines.groupBy("CNPJ_CIA", "DT_REFER").agg(F.max(holes).alias("CD_CVM"), F.max("DENOM_CIA").alias("DENOM_CIA"))
    return rows.fill_gaps(dated, "CNPJ_CIA", "DT_REFER", ["CD_CVM", "DENOM_CIA"])


def curated_bp(spark, sf):
    return report(lake.curated(spark, sf, "BP"), VALUE)


def curated_dre(spark, sf):
    return report(lake.curated(spark, sf, "DRE"), VALUE)


def curated_dfc(spark, sf):
    return report(lake.curated(spark, sf, "DFC"), VALUE)


def golden_schema(spark, sf):
    """All three statements in the shared layout, summarised by statement and status."""
    stacked = mart.stack_statements(lake.curated_all(spark, sf))
    return stacked.groupBy("GRUPO_DFP_TRATADO", "STATUS_MATH", "_origem_tabela").agg(
        F.count("*").alias("N"),
        F.count("DS_NIVEL_2").alias("COM_NIVEL_2"),
        F.count("DS_CONTA_REPORTADA").alias("REPORTADAS"),
        F.count_if("IS_LEAF").alias("FOLHAS"),
    )


def stack_statements(spark, sf):
    stacked = mart.stack_statements(lake.curated_all(spark, sf))
    return report(
        stacked.select("CNPJ_CIA", "DT_REFER", "GRUPO_DFP_TRATADO", "CD_CONTA", "VL_CONTA_TRATADO", "FLAG_RECONSTRUCAO"), VALUE
    )


# --- audits -----------------------------------------------------------------------------------


def balance_status(spark, sf):
    n1 = lake.curated(spark, sf, "BP")
    return n1.select("CNPJ_CIA", "DT_REFER", "STATUS_MATH").distinct()


def cashflow_status(spark, sf):
    n1 = lake.curated(spark, sf, "DFC")
    return n1.select("CNPJ_CIA", "DT_REFER", "STATUS_MATH").distinct()


def volume_summary(spark, sf):
    return audit.volume_summary(lake.curated(spark, sf, "BP"))


def balance_equation(spark, sf):
    audited = audit.balance_equation(_values(spark, sf, "BP"))
    return report(audited, ["TOTAL_ATIVO", "TOTAL_PASSIVO", "DIFERENCA"])


def status_distribution(spark, sf):
    pairs = {"QTD_EMPRESA_DATA": F.count_distinct("CNPJ_CIA", "DT_REFER")}
    return audit.distribution(lake.curated(spark, sf, "BP"), ["STATUS_MATH"], pairs)


def flag_distribution(spark, sf):
    return audit.distribution(lake.curated(spark, sf, "DRE"), ["FLAG_RECONSTRUCAO", "FLAG_NORMALIZACAO"])


def leaf_distribution(spark, sf):
    return audit.distribution(
        lake.curated(spark, sf, "DFC"), ["IS_LEAF"], {"CONTAS_DISTINTAS": F.count_distinct("CD_CONTA")}
    )


def duplicate_keys(spark, sf):
    lines = lake.raw_lines(spark, sf)
    return audit.duplicate_keys(lines, ["CNPJ_CIA", "DENOM_CIA", "DT_REFER", "CD_CONTA", "DS_CONTA"])


def parent_child_check(spark, sf):
    checked = audit.parent_child_check(_values(spark, sf, "DRE"))
    return report(checked, ["VL_PAI", "SOMA_FILHOS", "DIFERENCA"])


def parent_child_summary(spark, sf):
    return audit.parent_child_summary(_values(spark, sf, "BP"))


def coverage_crosscheck(spark, sf):
    lines = lake.silver_lines(spark, sf, curation.VALUE_COLUMNS)
    return audit.coverage_crosscheck(
        curation.repaired_values(lines, "DFC"), curation.repaired_values(lines, "DRE"), "DFC", "DRE"
    )


def cash_identity(spark, sf):
    checked = audit.cash_identity(_values(spark, sf, "DFC"))
    return report(checked, ["SOMA_FLUXOS", "VARIACAO_CAIXA", "DIFERENCA"])


def cash_reconciliation(spark, sf):
    closing = lake.repaired_below(spark, sf, "DFC", ["6.05.02"])
    cash = lake.repaired_below(spark, sf, "BP", ["1.01.01", "1.01.02"])
    checked = audit.cash_reconciliation(closing, cash)
    return report(checked, ["DFC_6_05_02", "BP_1_01_01", "BP_1_01_02", "BP_TETO"])


def waterfall_check(spark, sf):
    checked = audit.waterfall_check(_values(spark, sf, "DRE"))
    return report(checked, ["C3_01", "C3_02", "C3_03", "C3_04", "C3_05"])


def publish_gate(spark, sf):
    return audit.publish_gate(_values(spark, sf, "DRE"))


def gap_candidates(spark, sf):
    return report(audit.gap_candidates(_values(spark, sf, "BP")), ["VL_CONTA_TRATADO", "DIFERENCA"])


def group_totals(spark, sf):
    return report(audit.group_totals(_values(spark, sf, "BP")), ["VL_RAIZ", "SOMA_GRUPOS", "DIFERENCA"])


def top_divergences(spark, sf):
    return report(audit.top_divergences(_values(spark, sf, "BP")), ["TOTAL_ATIVO", "TOTAL_PASSIVO", "DIFERENCA"])


def top_reconstructed(spark, sf):
    return audit.top_reconstructed(_values(spark, sf, "BP"))


def audit_checklist(spark, sf):
    bp = materialise(lake.curated(spark, sf, "BP"), "bp")
    return audit.audit_checklist(bp, F.col("STATUS_MATH") == "DESBALANCEADO")


def _stacked(spark, sf):
    return materialise(mart.stack_statements(lake.curated_all(spark, sf)), "stacked")


def variable_catalogue(spark, sf):
    return audit.variable_catalogue(_stacked(spark, sf))


def variable_coverage(spark, sf):
    return audit.variable_coverage(materialise(lake.repaired_accounts(spark, sf), "accounts"))


def coverage_bitmaps(spark, sf):
    """Coverage of variables from bitmaps kept by year: kept once without the last years, then refreshed with these."""
    facts = materialise(audit.coverage_facts(lake.repaired_accounts(spark, sf)), "facts")
    path, year = work_path(spark, "coverage"), F.year("DT_REFER")
    years = sorted(r[0] for r in facts.select(year).distinct().collect() if r[0] is not None)
    late = years[-3:]
    coverage.keep(facts.filter(~year.isin(late)), path)
    coverage.refresh(facts.filter(year.isin(late)), late, path)
    return audit.coverage_from_counts(coverage.kept_counts(spark, path))


def variable_range(spark, sf):
    ranges = audit.variable_range(_stacked(spark, sf))
    return report(ranges, ["MINIMO", "MAXIMO"], ["MEDIANA"], places=4)


def variable_dictionary(spark, sf):
    return audit.variable_dictionary(_stacked(spark, sf))


def fallback_origin(spark, sf):
    return audit.fallback_origin(_values(spark, sf, "DRE"))


def missing_periods(spark, sf):
    """Years in which a company has no line of a statement at all."""
    lines = lake.silver_lines(spark, sf)
    return audit.missing_periods({code: lines.filter(F.col("GRUPO_DFP_TRATADO") == code) for code in curation.STATEMENTS})


def entities_by_dimension(spark, sf):
    """Registered companies by sector, state, kind of control and category, with their share."""
    companies = lake.companies(spark, sf)
    dimensions = ["SETOR_ATIV", "UF", "CONTROLE_ACIONARIO", "CATEG_REG"]
    long = companies.unpivot(["CNPJ_CIA"], dimensions, "DIMENSAO", "VALOR")
    counted = long.groupBy("DIMENSAO", "VALOR").agg(F.count("*").alias("N"))
    return counted.withColumn("PCT", F.round(F.col("N") * 100.0 / F.sum("N").over(Window.partitionBy("DIMENSAO")), 2))


QUERIES = {
    f.__name__: f
    for f in [
        scan_projection, eligible_entities, filter_funnel, excluded_by_group, ilike_filter, current_period_filter,
        scale_normalise, statement_class, level_filter, outlier_null, dedup_latest, dedup_prefer_original,
        latest_filing, distinct_on, distinct_entities, consolidate_sources, is_leaf, join_inner, collapse_duplicates,
        hierarchy_rollup_safe, hierarchy_rollup_force, filing_layout, rollup_audit, golden_names, golden_flag, modal_scale, trace_flags,
        level_labels, level_names_join, is_leaf_global, is_leaf_entity, metadata_attach, gap_fill, curated_bp,
        curated_dre, curated_dfc, golden_schema, stack_statements, balance_status, cashflow_status, volume_summary,
        balance_equation, status_distribution, flag_distribution, leaf_distribution, duplicate_keys,
        parent_child_check, parent_child_summary, coverage_crosscheck, cash_identity, cash_reconciliation,
        waterfall_check, publish_gate, gap_candidates, group_totals, top_divergences, top_reconstructed,
        audit_checklist, variable_catalogue, variable_coverage, coverage_bitmaps, variable_range, variable_dictionary, fallback_origin,
        missing_periods, entities_by_dimension,
    ]
} | {"sector_label": sector_labels}
