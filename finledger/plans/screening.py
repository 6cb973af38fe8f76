"""Screening of the simple mart: coverage, trends, sector tables, profiles and alerts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finledger import schema as S
from finledger.functions.expressions import sector_label, working_capital_profile
from finledger.functions.literals import literal_frame
from finledger.operators.distribution import clip_to_quantiles, fractional_rank, group_quantiles
from finledger.operators.rows import latest_non_null
from finledger.session import materialise

# Indicators of the liquidity trend.
LIQUIDITY = ["IND_LIQUIDEZ_GERAL", "IND_LIQUIDEZ_CORRENTE", "IND_LIQUIDEZ_SECA", "IND_LIQUIDEZ_IMEDIATA"]
# Indicators of the sector tables; True where lower is better.
SECTOR_TABLE: dict[str, bool] = {
    "IND_LIQUIDEZ_CORRENTE": False,
    "IND_PCT_AT": True,
    "IND_MARGEM_BRUTA": False,
    "IND_MARGEM_LIQUIDA": False,
    "IND_ROE": False,
    "IND_ROA": False,
    "IND_CICLO_FINANCEIRO": True,
}
# Profiles that count as an alert, and as sound.
ALERT_PROFILES = ["IV — Alto Risco", "V — Muito Ruim"]
SOUND_PROFILES = ["I — Excelente", "II — Solido"]
# Flags of the radar.
ALERTS = ["LC_CRITICA", "PCAT_ALTO", "ML_NEGATIVA", "ROE_NEGATIVO", "CICLO_LONGO", "FLEURIET_IV_V"]


def prepare(simple: DataFrame, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """Year, short sector label and working-capital profile; useful years only, where they are given."""
    dated = simple.withColumn("ANO", F.year("DT_REFER"))
    if first_year is not None:
        dated = dated.filter(F.col("ANO") >= first_year)
    if last_year is not None:
        dated = dated.filter(F.col("ANO") <= last_year)
    return dated.withColumns(
        {
            "SETOR_LABEL": sector_label("SETOR"),
            "FLEURIET": working_capital_profile("IND_CGL", "IND_NCG", "IND_ST"),
        }
    )


def last_year(df: DataFrame) -> DataFrame:
    """Rows of the table's last year."""
    return df.filter(F.col("ANO") == df.select(F.max("ANO")).scalar())


def top_sectors(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` sectors with most observations."""
    counted = df.groupBy("SETOR_LABEL").agg(F.count("*").alias("N_OBS"))
    return counted.orderBy(F.col("N_OBS").desc(), "SETOR_LABEL").limit(n)


def in_top_sectors(df: DataFrame, n: int = 10) -> DataFrame:
    # At most n rows, so the broadcast is bounded.
    return df.join(F.broadcast(top_sectors(df, n).select("SETOR_LABEL")), "SETOR_LABEL", "left_semi")


def universe_by_year(df: DataFrame) -> DataFrame:
    return df.groupBy("ANO").agg(
        F.count_distinct("CNPJ_CIA").alias("N_EMPRESAS"), F.count_distinct("SETOR_LABEL").alias("N_SETORES")
    )


def fill_rates(df: DataFrame, columns: list[str], good: float, fair: float) -> DataFrame:
    """Share of rows with a value per column, banded. One pass over the table."""
    counted = df.agg(F.count("*").alias("_total"), *[F.count(c).alias(c) for c in columns])
    long = counted.unpivot(["_total"], columns, "INDICADOR", "PREENCHIDOS")
    share = F.round(F.col("PREENCHIDOS") * 100.0 / F.nullif("_total", F.lit(0)), 2)
    return long.select(
        "INDICADOR",
        "PREENCHIDOS",
        share.alias("COBERTURA_PCT"),
        F.when(share >= good, "OK").when(share >= fair, "PARCIAL").otherwise("BAIXA").alias("STATUS"),
    )


def long_form(df: DataFrame, ids: list[str], columns: list[str]) -> DataFrame:
    return df.unpivot(ids, columns, "INDICADOR", "VALOR").filter(F.col("VALOR").isNotNull())


def median_trend(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Median of every column per key, long form."""
    return group_quantiles(long_form(df, keys, columns), [*keys, "INDICADOR"], "VALOR", {"MEDIANA": 0.5})


def median_heat(
    df: DataFrame, column: str, years: list[int]) -> DataFrame:
    """Sector by year table of medians; years are columns."""
    medians = group_quantiles(df, ["SETOR_LABEL", "ANO"], column, {"M": 0.5})
    return medians.groupBy("SETOR_LABEL").agg(
        *[F.max(F.when(F.col("ANO") == year, F.col("M"))).alias(f"ANO_{year}") for year in years]
    )


def percentile_table(df: DataFrame) -> DataFrame:
    long = long_form(df, ["SETOR_LABEL"], list(SECTOR_TABLE))
    wanted = {"P25": 0.25, "P50": 0.5, "P75": 0.75, "P90": 0.9}
    return group_quantiles(long, ["SETOR_LABEL", "INDICADOR"], "VALOR", wanted)


def sector_scorecard(df: DataFrame) -> DataFrame:
    """Sector medians ranked from 0 to 1 (higher is better), one column per indicator. A row per sector."""
    long = long_form(df, ["SETOR_LABEL"], list(SECTOR_TABLE))
    medians = group_quantiles(long, ["SETOR_LABEL", "INDICADOR"], "VALOR", {"M": 0.5})
    ranked = fractional_rank(medians, ["INDICADOR"], "M", "_share")
    lower = [c for c, lower_is_better in SECTOR_TABLE.items() if lower_is_better]
    share = F.when(F.col("INDICADOR").isin(lower), 1 - F.col("_share")).otherwise(F.col("_share"))
    return ranked.groupBy("SETOR_LABEL").agg(
        *[F.max(F.when(F.col("INDICADOR") == c, share)).alias(c) for c in SECTOR_TABLE]
    )


def profile_distribution(df: DataFrame) -> DataFrame:
    """Company-years per profile and their share. The window runs over seven rows."""
    counted = df.groupBy("FLEURIET").agg(F.count("*").alias("N"))
    return counted.withColumn("PCT", F.round(F.col("N") * 100.0 / F.sum("N").over(Window.partitionBy()), 2))


def profile_mix_by_year(df: DataFrame) -> DataFrame:
    """Share of every defined profile per year; absent combinations count as zero."""
    known = df.filter(F.col("FLEURIET") != S.UNDEFINED_PROFILE)
    profiles = [label for *_, label in S.WORKING_CAPITAL_PROFILES]
    counted = known.groupBy("ANO").agg(
        F.count("*").alias("TOTAL"), *[F.count_if(F.col("FLEURIET") == p).alias(p) for p in profiles]
    )
    long = counted.unpivot(["ANO", "TOTAL"], [F.col(f"`{p}`") for p in profiles], "FLEURIET", "N")
    return long.select("ANO", "FLEURIET", "N", F.round(F.col("N") / F.col("TOTAL"), 6).alias("PROPORCAO"))


def intensity_ratios(df: DataFrame) -> DataFrame:
    """Net debt, net working capital and its need as shares of total assets."""
    assets = F.nullif("V01_ATIVO_TOTAL", F.lit(0.0))
    return df.withColumns(
        {
            "IND_DL_AT": F.col("AUX_DIVIDA_LIQUIDA") / assets,
            "IND_CGL_AT": F.col("IND_CGL") / assets,
            "IND_NCG_AT": F.col("IND_NCG") / assets,
        }
    )


def winsorise(
    df: DataFrame, column: str, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """Column limited to its own year's quantiles."""
    return clip_to_quantiles(df, ["ANO"], column, f"{column}_VIZ", low, high)


def outlier_distance(df: DataFrame, x: str, y: str, top: int = 13) -> DataFrame:
    """The ``top`` companies of the last year farthest from the median of both axes, in standard deviations."""
    points = last_year(df).select("CNPJ_CIA", "ANO", F.col(x).alias("X"), F.col(y).alias("Y")).dropna()
    spread = points.groupBy("ANO").agg(F.stddev_samp("X").alias("SX"), F.stddev_samp("Y").alias("SY"))
    mx = group_quantiles(points, ["ANO"], "X", {"MX": 0.5})
    my = group_quantiles(points, ["ANO"], "Y", {"MY": 0.5})
    centre = materialise(spread.join(mx, "ANO").join(my, "ANO"), "centre")
    dx = (F.col("X") - F.col("MX")) / F.nullif("SX", F.lit(0.0))
    dy = (F.col("Y") - F.col("MY")) / F.nullif("SY", F.lit(0.0))
    distance = F.sqrt(dx * dx + dy * dy)
    return (
        points.join(centre, "ANO")
        .select("CNPJ_CIA", "ANO", "X", "Y", distance.alias("DISTANCIA"))
        .orderBy(F.col("DISTANCIA").desc_nulls_last(), "CNPJ_CIA")
        .limit(top)
    )


# What the flags are raised on.
ALERT_INPUTS = [
    "IND_LIQUIDEZ_CORRENTE",
    "IND_PCT_AT",
    "IND_MARGEM_LIQUIDA",
    "IND_ROE",
    "IND_CICLO_FINANCEIRO",
    "FLEURIET",
]


def alert_flags(df: DataFrame) -> DataFrame:
    """Six warning flags per company on its latest known values, and how many are raised."""
    latest = latest_non_null(df, "CNPJ_CIA", "ANO", ["RAZAO_SOCIAL", "SETOR_LABEL", *ALERT_INPUTS])
    raised: dict[str, Column] = {
        "LC_CRITICA": F.col("IND_LIQUIDEZ_CORRENTE") < 1.0,
        "PCAT_ALTO": F.col("IND_PCT_AT") > 0.75,
        "ML_NEGATIVA": F.col("IND_MARGEM_LIQUIDA") < -0.05,
        "ROE_NEGATIVO": F.col("IND_ROE") < 0,
        "CICLO_LONGO": F.col("IND_CICLO_FINANCEIRO") > 365,
        "FLEURIET_IV_V": F.col("FLEURIET").isin(ALERT_PROFILES),
    }
    flagged = latest.withColumns({name: F.coalesce(c, F.lit(False)) for name, c in raised.items()})
    count = reduce(lambda a, b: a + b, [F.col(name).cast("int") for name in ALERTS])
    return flagged.select("CNPJ_CIA", "RAZAO_SOCIAL", "SETOR_LABEL", "ANO", *ALERTS, count.alias("N_ALERTAS"))


def alert_frequency(flags: DataFrame) -> DataFrame:
    counted = flags.agg(F.count("*").alias("EMPRESAS"), *[F.count_if(F.col(a)).alias(a) for a in ALERTS])
    long = counted.unpivot(["EMPRESAS"], ALERTS, "ALERTA", "N")
    return long.withColumn("PCT", F.round(F.col("N") * 100.0 / F.nullif("EMPRESAS", F.lit(0)), 2))


def executive_summary(df: DataFrame) -> DataFrame:
    """Medians of the last year, share of sound profiles (types I and II) and of companies with three alerts or more."""
    columns = [
        "IND_LIQUIDEZ_CORRENTE",
        "IND_MARGEM_LIQUIDA",
        "IND_MARGEM_OPERACIONAL",
        "IND_ROE",
        "IND_ROA",
        "IND_PCT_AT",
        "IND_CICLO_FINANCEIRO",
    ]
    last = last_year(df)
    trend = median_trend(last, ["ANO"], columns)
    wanted = literal_frame(df.sparkSession, [(c,) for c in columns], "INDICADOR string")
    medians = wanted.join(trend, "INDICADOR", "left").select(
        F.col("INDICADOR").alias("METRICA"), F.col("MEDIANA").alias("VALOR")
    )
    sound = last.agg(F.avg(F.col("FLEURIET").isin(SOUND_PROFILES).cast("double")).alias("VALOR")).select(
        F.lit("FLEURIET_I_II").alias("METRICA"), "VALOR"
    )
    alerts = alert_flags(df).agg(F.avg((F.col("N_ALERTAS") >= 3).cast("double")).alias("VALOR")).select(
        F.lit("EMPRESAS_3_ALERTAS").alias("METRICA"), "VALOR"
    )
    return medians.unionByName(sound).unionByName(alerts)


def explore_mean(df: DataFrame, by: str, measure: str) -> DataFrame:
    return df.groupBy(by).agg(F.avg(measure).alias("MEDIA"), F.count(measure).alias("N"))

