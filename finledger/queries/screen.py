"""Registered queries over the simple mart and over reports of the curated balance sheet."""

from __future__ import annotations

from pyspark.sql import functions as F

from finledger.operators import rows
from finledger.operators.distribution import describe_group
from finledger.plans import curation, lake, mart, screening, serving
from finledger.queries.report import report
from finledger.session import materialise

# The useful period of the year-range query.
FIRST, LAST = 1996, 2000


def _prepared(spark, sf, stored: bool = False):
    simple = lake.simple(spark, sf)
    return screening.prepare(materialise(simple, "simple_mart") if stored else simple)


def useful_period(spark, sf):
    """Company-years per sector in a range of years."""
    useful = screening.prepare(lake.simple(spark, sf), FIRST, LAST)
    return useful.groupBy("SETOR_LABEL", "ANO").agg(F.count("*").alias("N"))


def indicator_mart_simple(spark, sf):
    simple = lake.simple(spark, sf)
    ratios = [
        c
        for c in simple.columns
        if c.startswith("IND_") and c not in ("IND_LPA_DILUIDO", "IND_CGL", "IND_NCG", "IND_ST")
    ]
    money = [c for c in simple.columns if c.startswith("V") or c.startswith("AUX_")]
    return report(simple, [*money, "IND_LPA_DILUIDO", "IND_CGL", "IND_NCG", "IND_ST"], ratios)


def mart_outer_assembly(spark, sf):
    lines = lake.silver_lines(spark, sf, curation.VALUE_COLUMNS)
    parts = [curation.repaired_values(lines, code) for code in ("BP", "DRE", "DFC")]
    wide = mart.assemble_simple(*parts, lake.companies(spark, sf))
    return report(wide, [c for c in wide.columns if c.startswith("V")])


def universe_by_year(spark, sf):
    return screening.universe_by_year(_prepared(spark, sf))


def top_sectors(spark, sf):
    return screening.top_sectors(_prepared(spark, sf))


def simple_fill_rate(spark, sf):
    prepared = _prepared(spark, sf)
    return screening.fill_rates(prepared, [c for c in prepared.columns if c.startswith("IND_")], 90, 70)


def median_trend(spark, sf):
    trend = screening.median_trend(_prepared(spark, sf), ["ANO"], screening.LIQUIDITY)
    return report(trend, [], ["MEDIANA"])


def median_heat(spark, sf):
    prepared = _prepared(spark, sf, stored=True)
    years = serving.fiscal_years(prepared, "ANO")
    heat = screening.median_heat(screening.in_top_sectors(prepared), "IND_LIQUIDEZ_CORRENTE", years)
    return report(heat, [], [f"ANO_{y}" for y in years])


def percentile_table(spark, sf):
    table = screening.percentile_table(
        screening.in_top_sectors(_prepared(spark, sf, stored=True))
    )
    return report(table, [], ["P25", "P50", "P75", "P90"])


def sector_scorecard(spark, sf):
    card = screening.sector_scorecard(
        screening.in_top_sectors(_prepared(spark, sf, stored=True))
    )
    return report(card, [], list(screening.SECTOR_TABLE))


def describe_by_sector(spark, sf):
    described = describe_group(_prepared(spark, sf, stored=True), ["SETOR_LABEL"], "IND_LIQUIDEZ_CORRENTE")
    return report(described, [], ["MEDIA", "DESVIO", "MINIMO", "MAXIMO", "P25", "P50", "P75"])


def working_capital_profile(spark, sf):
    return screening.profile_distribution(_prepared(spark, sf))


def class_mix_by_year(spark, sf):
    return screening.profile_mix_by_year(_prepared(spark, sf))


def intensity_ratios(spark, sf):
    rated = screening.intensity_ratios(_prepared(spark, sf)).select("CNPJ_CIA", "DT_REFER", "IND_DL_AT", "IND_CGL_AT", "IND_NCG_AT")
    return report(rated, [], ["IND_DL_AT", "IND_CGL_AT", "IND_NCG_AT"])


def winsorise(spark, sf):
    clipped = screening.winsorise(
        _prepared(spark, sf, stored=True), "IND_LIQUIDEZ_CORRENTE"
    ).select("CNPJ_CIA", "DT_REFER", "IND_LIQUIDEZ_CORRENTE", "IND_LIQUIDEZ_CORRENTE_VIZ")
    return report(clipped, [], ["IND_LIQUIDEZ_CORRENTE", "IND_LIQUIDEZ_CORRENTE_VIZ"])


def outlier_distance(spark, sf):
    found = screening.outlier_distance(
        screening.in_top_sectors(_prepared(spark, sf, stored=True)),
        "IND_MARGEM_BRUTA",
        "IND_MARGEM_LIQUIDA"
    )
    return report(found, [], ["X", "Y", "DISTANCIA"], places=4)


def latest_non_null(spark, sf):
    columns = ["IND_LIQUIDEZ_CORRENTE", "IND_ROE", "IND_CICLO_FINANCEIRO"]
    return report(rows.latest_non_null(_prepared(spark, sf), "CNPJ_CIA", "DT_REFER", columns), [], columns)


def alert_radar(spark, sf):
    return screening.alert_flags(_annual(_prepared(spark, sf)))


def _annual(prepared):
    """One row per company and year: the latest date of the year."""
    return rows.newest_row(prepared, ["CNPJ_CIA", "ANO"], [F.col("DT_REFER").desc()])


def alert_frequency(spark, sf):
    return screening.alert_frequency(screening.alert_flags(_annual(_prepared(spark, sf))))


def executive_summary(spark, sf):
    annual = materialise(_annual(_prepared(spark, sf)), "annual")
    summary = screening.executive_summary(annual)
    return report(summary, [], ["VALOR"])


def explore_mean(spark, sf):
    means = screening.explore_mean(_prepared(spark, sf), "SETOR_LABEL", "IND_LIQUIDEZ_CORRENTE")
    return report(means, [], ["MEDIA"])


# --- reports of the curated balance sheet -----------------------------------------------------


def entity_statement(spark, sf):
    return serving.statement(lake.curated(spark, sf, "BP"), max_level=3, scale="mil")


def reference_dates(spark, sf):
    return serving.reference_dates(lake.curated(spark, sf, "DFC"))


def statement_pivot(spark, sf):
    stored = materialise(lake.curated(spark, sf, "BP"), "bp")
    years = serving.fiscal_years(stored, "DT_REFER_ANO")
    return report(serving.statement_pivot(stored, years), [f"ANO_{y}" for y in years])


def latest_period(spark, sf):
    stored = materialise(lake.curated(spark, sf, "BP"), "bp")
    last = serving.latest_period(stored).select("CNPJ_CIA", "DT_REFER", "CD_CONTA", "VL_CONTA_TRATADO")
    return report(last, ["VL_CONTA_TRATADO"])


def _assets(spark, sf):
    return serving.account_series(lake.repaired(spark, sf, "BP"), "1")


def yoy_growth(spark, sf):
    return report(serving.period_growth(_assets(spark, sf)), ["VALOR"], ["VARIACAO"])


def cagr(spark, sf):
    return report(serving.compound_growth(_assets(spark, sf)), ["INICIAL", "FINAL"], ["CAGR"])


def statement_highlights(spark, sf):
    return report(serving.highlights(lake.curated(spark, sf, "DRE"), "DRE"), ["VL_CONTA_TRATADO"])


def top_entities(spark, sf):
    stored = materialise(lake.curated(spark, sf, "BP"), "bp")
    return serving.largest(stored, "1")


QUERIES = {
    f.__name__: f
    for f in [
        indicator_mart_simple, mart_outer_assembly, useful_period, universe_by_year, top_sectors, simple_fill_rate, median_trend,
        median_heat, percentile_table, sector_scorecard, describe_by_sector, working_capital_profile,
        class_mix_by_year, intensity_ratios, winsorise, outlier_distance, latest_non_null, alert_radar,
        alert_frequency, executive_summary, explore_mean, entity_statement, reference_dates, statement_pivot,
        latest_period, yoy_growth, cagr, statement_highlights, top_entities,
    ]
}
