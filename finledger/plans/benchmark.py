"""Indicators in long form, their medians, and the risk score with its peers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finledger import schema as S
from finledger.functions.expressions import (
    linear_note,
    mean_of_present,
    score_band,
    target_note,
    weighted_mean_of_present,
)
from finledger.functions.literals import literal_frame
from finledger.operators.distribution import group_median, group_positions, group_ranks
from finledger.operators.rows import newest_row
from finledger.session import materialise

LONG_KEYS = ["CNPJ_CIA", "DENOM_CIA", "SETOR", "ANO_FISCAL"]


def unpivot_indicators(mart: DataFrame, codes: list[str] | None = None) -> DataFrame:
    """One row per company-year and indicator that has a value."""
    codes = codes or S.BENCHMARK_INDICATORS
    base = mart.filter(F.col("ANO_FISCAL").isNotNull()).withColumnRenamed("RAZAO_SOCIAL", "DENOM_CIA")
    return base.unpivot(LONG_KEYS, codes, "COD_INDICADOR", "VL_INDICADOR").filter(F.col("VL_INDICADOR").isNotNull())


def overall_medians(long: DataFrame) -> DataFrame:
    return group_median(long, ["ANO_FISCAL", "COD_INDICADOR"], "VL_INDICADOR", "MEDIANA_GERAL_ANO")


def sector_medians(long: DataFrame) -> DataFrame:
    keys = ["ANO_FISCAL", "SETOR", "COD_INDICADOR"]
    return group_median(long, keys, "VL_INDICADOR", "MEDIANA_SETOR_ANO")


def benchmark(stored_mart: DataFrame) -> DataFrame:
    """Every indicator against the overall and the sector median of its year.

    A company without a sector has no sector median. Both medians come from one sorting of the values, in which each
    value stands for the whole and for its sector. They are few (years x sectors x indicators) and written first, so that
    the planner sees how small they are and does not shuffle the long table for them.
    """
    long = unpivot_indicators(stored_mart)
    scope = lambda name, sector: F.struct(F.lit(name).alias("_scope"), sector.alias("_sector"))
    scopes = F.array(scope("all", F.lit(None).cast("string")), scope("sector", F.col("SETOR")))
    values = long.select("ANO_FISCAL", "COD_INDICADOR", "VL_INDICADOR", F.inline(scopes))
    medians = group_median(values, ["ANO_FISCAL", "COD_INDICADOR", "_scope", "_sector"], "VL_INDICADOR", "_median")
    medians = materialise(medians, "medians")
    overall = medians.filter("_scope = 'all'").select("ANO_FISCAL", "COD_INDICADOR", F.col("_median").alias("MEDIANA_GERAL_ANO"))
    sector = medians.filter("_scope = 'sector'").select(
        "ANO_FISCAL", F.col("_sector").alias("SETOR"), "COD_INDICADOR", F.col("_median").alias("MEDIANA_SETOR_ANO")
    )
    joined = long.join(overall, ["ANO_FISCAL", "COD_INDICADOR"], "left").join(
        sector, ["ANO_FISCAL", "SETOR", "COD_INDICADOR"], "left"
    )
    value = F.col("VL_INDICADOR")
    return joined.select(
        *LONG_KEYS,
        "COD_INDICADOR",
        "VL_INDICADOR",
        "MEDIANA_GERAL_ANO",
        "MEDIANA_SETOR_ANO",
        (value - F.col("MEDIANA_GERAL_ANO")).alias("DELTA_VS_GERAL"),
        (value - F.col("MEDIANA_SETOR_ANO")).alias("DELTA_VS_SETOR"),
    )


def filtered_averages(long: DataFrame, sector: str) -> DataFrame:
    """Mean of one sector beside mean and maximum of all the others, per year and indicator."""
    inside = F.col("SETOR").eqNullSafe(sector)
    return long.groupBy("ANO_FISCAL", "COD_INDICADOR").agg(
        F.avg(F.when(inside, F.col("VL_INDICADOR"))).alias("MEDIA_SETOR"),
        F.avg(F.when(~inside, F.col("VL_INDICADOR"))).alias("MEDIA_DEMAIS"),
        F.max(F.when(~inside, F.col("VL_INDICADOR"))).alias("MAXIMO_DEMAIS"),
    )


# --- risk score -------------------------------------------------------------------------------


def note_columns() -> dict[str, Column]:
    notes = {note: linear_note(indicator, zero, ten) for note, indicator, zero, ten in S.LINEAR_NOTES}
    notes |= {note: target_note(indicator, target) for note, indicator, target in S.TARGET_NOTES}
    return notes


def risk_notes(mart: DataFrame) -> DataFrame:
    """The thirteen inputs of the score with their 0..10 notes."""
    inputs = [indicator for _, indicator, *_ in S.LINEAR_NOTES] + [indicator for _, indicator, _ in S.TARGET_NOTES]
    base = mart.filter(F.col("ANO_FISCAL").isNotNull()).withColumnRenamed("RAZAO_SOCIAL", "DENOM_CIA")
    return base.select(*LONG_KEYS, *inputs).withColumns(note_columns())


def risk_scores(mart: DataFrame) -> DataFrame:
    """Notes, five dimension scores, the total re-weighted to the dimensions present, and its band. One projection."""
    dimensions = {score: mean_of_present(notes) for score, _, notes in S.SCORE_DIMENSIONS}
    total = weighted_mean_of_present({score: weight for score, weight, _ in S.SCORE_DIMENSIONS})
    scored = risk_notes(mart).withColumns(dimensions).withColumn("SCORE_IPRF", total)
    return scored.withColumn("FAIXA_IPRF", score_band("SCORE_IPRF"))


def score_peers(stored_scores: DataFrame) -> DataFrame:
    """Each score among its sector of the year: median, dense rank from the top, percent rank."""
    keys = ["ANO_FISCAL", "SETOR"]
    base = stored_scores.filter(F.col("SCORE_IPRF").isNotNull()).select(*LONG_KEYS, "SCORE_IPRF", "FAIXA_IPRF")
    medians = group_median(base, keys, "SCORE_IPRF", "MEDIANA_IPRF_SETOR_ANO")
    ranked = group_ranks(base, keys, "SCORE_IPRF")
    # A missing sector is a peer group for the ranks, but has no median (plain equality), as in the definition.
    return ranked.join(medians, keys, "left").select(
        *LONG_KEYS,
        "SCORE_IPRF",
        "FAIXA_IPRF",
        "MEDIANA_IPRF_SETOR_ANO",
        F.col("_dense_desc").alias("RANK_IPRF_SETOR_ANO"),
        F.round(F.col("_percent") * 100, 2).alias("PERCENTIL_IPRF_SETOR_ANO"),
    )


# --- long indicator table with status ---------------------------------------------------------

# Indicators of the status table as (code, numerator, denominator), over the base balances.
STATUS_INDICATORS: list[tuple[str, str, str]] = [
    ("LIQ_GERAL", "AC + RLP", "PC + PNC"),
    ("LIQ_CORRENTE", "AC", "PC"),
    ("LIQ_SECA", "AC - ESTOQUE_OPERACIONAL", "PC"),
    ("LIQ_IMEDIATA", "ACF", "PC"),
    ("ENDIV_CP", "PC + PNC", "PL"),
    ("ENDIV_TOTAL", "PC + PNC", "AT"),
    ("GARANTIA_CP_CT", "PL", "PC + PNC"),
    ("COMPOSICAO_ENDIV", "PC", "PC + PNC"),
    ("IMOB_PL", "IMOBILIZADO", "PL"),
    ("IMOB_AT", "IMOBILIZADO", "AT"),
    ("MARGEM_BRUTA", "LUCRO_BRUTO", "REC_LIQ"),
    ("MARGEM_OPERACIONAL", "EBIT", "REC_LIQ"),
    ("MARGEM_LIQUIDA", "LUCRO_LIQ", "REC_LIQ"),
    ("LPA", "LPA_3_99", "1"),
    ("ROA", "LUCRO_LIQ", "AT"),
    ("ROE", "LUCRO_LIQ", "PL"),
    ("ROI", "LUCRO_LIQ", "PL + DIVIDA_BRUTA"),
    ("GIRO_ESTOQUES", "CPV_ABS", "ESTOQUE_OPERACIONAL"),
    ("GIRO_CLIENTES", "REC_LIQ", "CLIENTES"),
    ("GIRO_FORNECEDORES", "CPV_ABS", "FORNECEDORES"),
    ("GIRO_AC", "REC_LIQ", "AC"),
    ("PMRE", "ESTOQUE_OPERACIONAL * 360", "CPV_ABS"),
    ("PMRV", "CLIENTES * 360", "REC_LIQ"),
    ("PMPC", "FORNECEDORES * 360", "CPV_ABS"),
    ("PMRAC", "AC * 360", "REC_LIQ"),
    ("CICLO_ECONOMICO", "ESTOQUE_OPERACIONAL * 360 / nullif(CPV_ABS, 0) + CLIENTES * 360 / nullif(REC_LIQ, 0)", "1"),
    (
        "CICLO_FINANCEIRO",
        "(ESTOQUE_OPERACIONAL - FORNECEDORES) * 360 / nullif(CPV_ABS, 0) + CLIENTES * 360 / nullif(REC_LIQ, 0)",
        "1",
    ),
    ("CGL", "AC - PC", "1"),
    ("NCG", "ACO - PCO", "1"),
    ("ST", "ACF - PCF", "1"),
    ("SALDO_FINAL_CAIXA", "SALDO_FINAL_CAIXA_DFC", "1"),
]


def indicators_with_status(balances: DataFrame) -> DataFrame:
    """Numerator, denominator, value and calculation status of every indicator, in one pass."""
    entries = [
        F.struct(
            F.lit(code).alias("COD_INDICADOR"),
            F.expr(numerator).cast("double").alias("VL_NUMERADOR"),
            F.expr(denominator).cast("double").alias("VL_DENOMINADOR"),
        )
        for code, numerator, denominator in STATUS_INDICATORS
    ]
    long = balances.select("CNPJ_CIA", "ANO_FISCAL", F.inline(F.array(*entries)))
    numerator, denominator = F.col("VL_NUMERADOR"), F.col("VL_DENOMINADOR")
    return long.withColumns(
        {
            "VL_INDICADOR": numerator / F.nullif(denominator, F.lit(0.0)),
            "STATUS_CALCULO": F.when(numerator.isNull(), "CONTA_AUSENTE")
            .when(denominator.isNull() | (denominator == 0), "DENOMINADOR_ZERO_OU_NULO")
            .otherwise("OK"),
        }
    )


# --- rankings ---------------------------------------------------------------------------------


def indicator_ranking(long: DataFrame, top: int | None = None) -> DataFrame:
    """Companies ranked per year, sector and priority indicator, best first; the direction comes from the indicator.

    ``top`` limits the ranking for a chart.
    """
    spec = literal_frame(
        long.sparkSession, [(code, better) for _, code, better in S.PRIORITY_INDICATORS], "COD_INDICADOR string, MELHOR string"
    )
    signed = F.when(F.col("MELHOR") == "lower", F.col("VL_INDICADOR")).otherwise(-F.col("VL_INDICADOR"))
    keyed = long.join(F.broadcast(spec), "COD_INDICADOR").withColumn("_key", signed).drop("MELHOR")
    groups = ["ANO_FISCAL", "SETOR", "COD_INDICADOR"]
    return group_positions(keyed, groups, ["_key", "CNPJ_CIA"], "POSICAO", top).drop("_key")


def indicator_snapshot(long: DataFrame) -> DataFrame:
    """Priority indicators of every company's last year; a company keeps those without a value."""
    spark = long.sparkSession
    spec = literal_frame(
        spark,
        [(i, group, code) for i, (group, code, _) in enumerate(S.PRIORITY_INDICATORS)],
        "ORDEM int, GRUPO string, COD_INDICADOR string",
    )
    last = long.groupBy("CNPJ_CIA").agg(F.max("ANO_FISCAL").alias("ANO_FISCAL"))
    wanted = last.withColumn("ORDEM", F.explode(F.sequence(F.lit(0), F.lit(len(S.PRIORITY_INDICATORS) - 1)))).join(
        F.broadcast(spec), "ORDEM"
    )
    values = long.select("CNPJ_CIA", "ANO_FISCAL", "COD_INDICADOR", "VL_INDICADOR")
    return wanted.join(values, ["CNPJ_CIA", "ANO_FISCAL", "COD_INDICADOR"], "left")


def entity_against_sector(stored_mart: DataFrame, columns: list[str]) -> DataFrame:
    """A company's indicators beside the median of its sector and year, long form."""
    long = unpivot_indicators(stored_mart, columns)
    medians = materialise(sector_medians(long), "sector_medians")
    return long.join(medians, ["ANO_FISCAL", "SETOR", "COD_INDICADOR"]).select(
        "CNPJ_CIA", "ANO_FISCAL", "COD_INDICADOR", "VL_INDICADOR", "MEDIANA_SETOR_ANO"
    )


def newest_score(scores: DataFrame) -> DataFrame:
    return newest_row(scores, ["CNPJ_CIA"], [F.col("ANO_FISCAL").desc()])

