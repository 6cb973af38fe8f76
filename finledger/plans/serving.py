"""Parameterised reads for reports: statements, series, highlights, scores and peers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finledger import schema as S
from finledger.functions.expressions import digits
from finledger.functions.literals import literal_frame
from finledger.operators.distribution import group_positions
from finledger.operators.hierarchy import FILING
from finledger.operators.rows import newest_row

# Accounts highlighted per statement.
HIGHLIGHTS: dict[str, list[str]] = {
    "BP": ["1", "1.01", "1.02", "2.01", "2.02", "2.03"],
    "DRE": ["3.01", "3.03", "3.05", "3.11"],
    "DFC": ["6.01", "6.02", "6.03", "6.05"],
}
# Divisors of the display scales.
SCALES = {"unidade": 1, "mil": 1_000, "milhoes": 1_000_000, "bilhoes": 1_000_000_000}


def entities(df: DataFrame) -> DataFrame:
    """Companies of a table with the label a selection list shows."""
    distinct = df.select("CNPJ_CIA", "DENOM_CIA").distinct()
    return distinct.withColumn("LABEL", F.concat("DENOM_CIA", F.lit(" ("), "CNPJ_CIA", F.lit(")")))


def reference_dates(df: DataFrame, entity: str | None = None) -> DataFrame:
    chosen = df if entity is None else df.filter(F.col("CNPJ_CIA") == entity)
    return chosen.select(*FILING).distinct()


def statement(
    df: DataFrame,
    entity: str | None = None,
    dates: list[str] | None = None,
    accounts: list[str] | None = None,
    max_level: int | None = None,
    scale: str = "unidade",
) -> DataFrame:
    """Statement lines of one company or all, limited to dates, accounts and depth, in a display scale."""
    if entity is not None:
        df = df.filter(F.col("CNPJ_CIA") == entity)
    if dates:
        df = df.filter(F.col("DT_REFER").isin(dates))
    if accounts:
        df = df.filter(F.col("CD_CONTA").isin(accounts))
    if max_level is not None:
        df = df.filter(digits("CD_CONTA") <= 2 * max_level - 1)
    value = F.round(F.col("VL_CONTA_TRATADO") / SCALES[scale], 8)
    return df.select("CNPJ_CIA", "DT_REFER", "CD_CONTA", "DS_CONTA", value.alias("VALOR"))


def fiscal_years(df: DataFrame, column: str) -> list[int]:
    """The years of a stored table, in order: the columns of a table by year."""
    return sorted(r[0] for r in df.select(column).distinct().collect() if r[0] is not None)


def statement_pivot(df: DataFrame, years: list[int]) -> DataFrame:
    """Accounts by fiscal year, missing years as zero."""
    grouped = df.groupBy("CNPJ_CIA", "CD_CONTA", "DS_CONTA").pivot("DT_REFER_ANO", years)
    return grouped.agg(F.sum("VL_CONTA_TRATADO")).na.fill(0.0).withColumnsRenamed({str(y): f"ANO_{y}" for y in years})


def latest_period(df: DataFrame) -> DataFrame:
    """Lines of every company's last reference date."""
    last = df.groupBy("CNPJ_CIA").agg(F.max("DT_REFER").alias("DT_REFER"))
    return df.join(last, FILING, "left_semi")


def account_series(df: DataFrame, account: str) -> DataFrame:
    return df.filter(F.col("CD_CONTA") == account).groupBy(*FILING).agg(F.sum("VL_CONTA_TRATADO").alias("VALOR"))


def period_growth(series: DataFrame) -> DataFrame:
    """Change against the company's previous date; 0 for the first one or after a zero."""
    dates = Window.partitionBy("CNPJ_CIA").orderBy("DT_REFER")
    before = F.lag("VALOR").over(dates)
    growth = F.coalesce(F.col("VALOR") / F.nullif(before, F.lit(0.0)) - 1, F.lit(0.0))
    return series.withColumn("VARIACAO", growth)


def compound_growth(series: DataFrame) -> DataFrame:
    """Compound growth from the first to the last date; 0 unless it starts positive and ends without a sign change."""
    ends = series.groupBy("CNPJ_CIA").agg(
        F.min_by("VALOR", "DT_REFER").alias("INICIAL"),
        F.max_by("VALOR", "DT_REFER").alias("FINAL"),
        F.count("*").alias("N"),
    )
    usable = (F.col("N") >= 2) & (F.col("INICIAL") > 0) & (F.col("FINAL") >= 0)
    base = F.col("FINAL") / F.nullif("INICIAL", F.lit(0.0))
    rate = F.power(base, F.lit(1.0) / F.nullif(F.col("N") - 1, F.lit(0))) - 1
    return ends.withColumn("CAGR", F.when(usable, rate).otherwise(0.0))


def highlights(df: DataFrame, code: str) -> DataFrame:
    """Headline accounts of a statement per fiscal year, newest date of the year."""
    chosen = df.filter(F.col("CD_CONTA").isin(HIGHLIGHTS[code]))
    newest = newest_row(chosen, ["CNPJ_CIA", "DT_REFER_ANO", "CD_CONTA"], [F.col("DT_REFER").desc()])
    return newest.select(
        "CNPJ_CIA", F.col("DT_REFER_ANO").alias("ANO_FISCAL"), "CD_CONTA", "DS_CONTA", "VL_CONTA_TRATADO"
    )


def overview_history(mart: DataFrame) -> DataFrame:
    return mart.select(
        "CNPJ_CIA", "ANO_FISCAL", "AT", "PL", "REC_LIQ", "EBITDA", "LUCRO_LIQ", "DIVIDA_LIQUIDA", "EFEITO_TESOURA"
    )


def overview_snapshot(stored_mart: DataFrame, year: int | None = None) -> DataFrame:
    """The overview of one year, the last one where none is given."""
    shown = overview_history(stored_mart)
    if year is None:
        year = stored_mart.agg(F.max("ANO_FISCAL")).first()[0]
    return shown.filter(F.col("ANO_FISCAL") == year)


def priority_history(long: DataFrame) -> DataFrame:
    """The priority indicators of every company over all years, with their group and place on the list."""
    rows = [(i, group, code) for i, (group, code, _) in enumerate(S.PRIORITY_INDICATORS)]
    spec = literal_frame(long.sparkSession, rows, "ORDEM int, GRUPO string, COD_INDICADOR string")
    return long.join(F.broadcast(spec), "COD_INDICADOR").select(
        "CNPJ_CIA", "ANO_FISCAL", "ORDEM", "GRUPO", "COD_INDICADOR", "VL_INDICADOR"
    )


def score_history(scores: DataFrame) -> DataFrame:
    """Score per company and year with its change against the company's previous year."""
    years = Window.partitionBy("CNPJ_CIA").orderBy("ANO_FISCAL")
    return scores.select(
        "CNPJ_CIA",
        "ANO_FISCAL",
        "SCORE_IPRF",
        "FAIXA_IPRF",
        (F.col("SCORE_IPRF") - F.lag("SCORE_IPRF").over(years)).alias("VARIACAO"),
    )


def score_peers_of_last_year(peers: DataFrame, scores: DataFrame, top: int | None = None) -> DataFrame:
    """Companies ranked by score per sector in the last year of ``scores``; ``top`` limits the ranking for a chart."""
    year = scores.filter(F.col("SCORE_IPRF").isNotNull()).select(F.max("ANO_FISCAL")).scalar()
    last = peers.filter(F.col("ANO_FISCAL") == year).withColumn("_key", -F.col("SCORE_IPRF"))
    return group_positions(last, ["SETOR"], ["_key", "CNPJ_CIA"], "POSICAO", top).drop("_key")


def largest(df: DataFrame, account: str, top: int = 10) -> DataFrame:
    """The companies with the largest balance of an account in the table's last date."""
    last = df.filter((F.col("CD_CONTA") == account) & (F.col("DT_REFER") == df.select(F.max("DT_REFER")).scalar()))
    return (
        last.select("CNPJ_CIA", "DENOM_CIA", "SETOR_ATIV", F.round(F.col("VL_CONTA_TRATADO") / 1e9, 6).alias("BILHOES"))
        .orderBy(F.col("BILHOES").desc(), "CNPJ_CIA")
        .limit(top)
    )
