"""Registered queries over the strict mart, its benchmark and the risk score."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finledger import schema as S
from finledger.operators import audit
from finledger.operators.normalise import current_period, normalise_lines
from finledger.plans import benchmark, incremental, lake, mart, screening, serving
from finledger.queries.report import report
from finledger.session import materialise, work_path
from finledger.sources.tables import export_csv, publish_view, written_rows

KEYS = ["CNPJ_CIA", "ANO_FISCAL"]
BALANCES = [c for c in S.MART_ACCOUNTS if not c.startswith("LPA")] + ["DEP_AMORT"]
TERMS = ["ACF", "PCF", "CGL", "CPV_ABS", "ESTOQUE_OPERACIONAL", "DIVIDA_BRUTA", "CAPEX", "ACO", "PCO"]
MONEY = [*BALANCES, *TERMS, "LPA", "EBITDA", "DIVIDA_LIQUIDA", "NCG", "ST"]
RATIO_GROUPS = {
    "ratios_liquidity": ["LIQ_CORRENTE", "LIQ_SECA", "LIQ_SECA_AJUSTADA", "LIQ_IMEDIATA", "LIQ_GERAL"],
    "ratios_debt": [
        "ENDIV_TOTAL", "GRAU_ENDIVIDAMENTO", "ENDIV_CP", "GARANTIA_CP_CT", "COMPOSICAO_ENDIV", "IMOB_PL", "IMOB_AT",
        "DIVIDA_LIQUIDA", "DL_EBITDA",
    ],
    "ratios_margin": ["MARGEM_BRUTA", "MARGEM_OPERACIONAL", "MARGEM_EBITDA", "MARGEM_LIQUIDA", "EBITDA", "LPA"],
    "ratios_return": ["ROA", "ROE", "ROI"],
    "ratios_activity": [
        "GIRO_ESTOQUES", "GIRO_ESTOQUES_AJUSTADO", "GIRO_CLIENTES", "GIRO_FORNECEDORES", "GIRO_ATIVO_TOTAL", "GIRO_AC",
        "PMRV", "PMRE", "PMRE_AJUSTADO", "PMPC", "PMRAC",
    ],
    "ratios_cycle": ["CICLO_ECONOMICO", "CICLO_FINANCEIRO", "CCC", "NCG", "ST", "CGL"],
    "ratios_cash": [
        "COB_CAIXA_OPERACIONAL", "MARGEM_CAIXA_OPERACIONAL", "COBERTURA_DIVIDA_CAIXA", "INTENSIDADE_REINVESTIMENTO", "CAPEX",
    ],
}
RATIOS = [c for group in RATIO_GROUPS.values() for c in group if c not in MONEY]


def _present(df: DataFrame, columns: list[str]) -> DataFrame:
    chosen = df.select(*KEYS, *columns)
    return report(chosen, [c for c in columns if c in MONEY], [c for c in columns if c in RATIOS])


def _first(spark: SparkSession, sf: str) -> DataFrame:
    lines = normalise_lines(current_period(lake.raw_lines(spark, sf)))
    return mart.account_pivot(mart.newest_balances(mart.mart_lines(lines)))


def account_pivot(spark, sf):
    first = _first(spark, sf)
    lpa = ["LPA_DILUIDO_ON", "LPA_BASICO_ON", "LPA_3_99"]
    return report(first, [*BALANCES, *lpa])


def mart_second_order(spark, sf):
    return _present(mart.second_order(_first(spark, sf)), TERMS)


def indicator_mart(spark, sf):
    return report(lake.mart(spark, sf), MONEY, RATIOS)


def _ratios(*columns: str):
    def query(spark, sf):
        return _present(lake.mart(spark, sf), list(columns))

    return query


def _updated(spark: SparkSession, sf: str) -> tuple[str, DataFrame, DataFrame]:
    """The mart built from earlier lines and brought up to date: its path, its lines, the touched company-years.

    Earlier, the filings of every fifth year were not there, the next year's had a newer version with other values that
    was withdrawn since, and the year after had filings for a year that no longer has any.
    """
    lines = normalise_lines(current_period(lake.raw_lines(spark, sf)))
    year = F.col("DT_FIM_EXERC_ANO")
    path = work_path(spark, "first_order")
    incremental.build(_earlier(lines), path)
    return path, lines, incremental.update(lines, path)


def _earlier(lines: DataFrame) -> DataFrame:
    """The earlier lines, from one scan: as they are, and a second time corrected or withdrawn."""
    year, again = F.col("DT_FIM_EXERC_ANO"), F.col("_again")
    value, kind = F.col("VL_CONTA_TRATADO"), lines.schema["VL_CONTA_TRATADO"].dataType
    # Lines of the missing years, and those without a year, have no copy at all.
    copies = F.when(year % 5 == 0, F.array().cast("array<int>")).when(year % 5 == 1, F.array(F.lit(0), F.lit(1)))
    copies = copies.when(year % 5 == 2, F.array(F.lit(0), F.lit(2))).when(year.isNotNull(), F.array(F.lit(0)))
    twice = lines.select("*", F.explode(copies).alias("_again"))
    changed = {
        "VERSAO": F.when(again == 1, F.col("VERSAO") + 1).otherwise(F.col("VERSAO")),
        "VL_CONTA_TRATADO": F.when(again == 1, (value * 3).cast(kind)).otherwise(value),
        "DT_FIM_EXERC_ANO": F.when(again == 2, year + 100).otherwise(year),
    }
    return twice.withColumns(changed).drop("_again")


def mart_incremental(spark, sf):
    """The strict mart after an update that worked out only what changed."""
    path, lines, _ = _updated(spark, sf)
    kept = incremental.read(spark, path, incremental.first_order_schema(lines), lake.companies(spark, sf))
    return report(kept, MONEY, RATIOS)


def mart_touched(spark, sf):
    """Company-years that an update worked out anew, by what happened to them."""
    return _updated(spark, sf)[2].groupBy("SITUACAO").agg(F.count("*").alias("LINHAS"))


def scissors_effect(spark, sf):
    return _present(lake.mart(spark, sf), ["ST", "EFEITO_TESOURA"])


def curated_mart(spark, sf):
    """End to end: raw lines, consolidation, repair of three statements, stacking, mart."""
    return report(mart.mart_from_curated(lake.curated_all(spark, sf)), MONEY, RATIOS)


def indicators_unpivot(spark, sf):
    return report(benchmark.unpivot_indicators(lake.mart(spark, sf)), [], ["VL_INDICADOR"], places=4)


def median_overall(spark, sf):
    long = benchmark.unpivot_indicators(lake.mart(spark, sf))
    medians = benchmark.overall_medians(long)
    return report(medians, [], ["MEDIANA_GERAL_ANO"], places=4)


def median_sector(spark, sf):
    long = benchmark.unpivot_indicators(lake.mart(spark, sf))
    medians = benchmark.sector_medians(long)
    return report(medians, [], ["MEDIANA_SETOR_ANO"], places=4)


def median_sector_distributed(spark, sf):
    """The same medians over the stored mart."""
    long = benchmark.unpivot_indicators(lake.stored_mart(spark, sf))
    return report(benchmark.sector_medians(long), [], ["MEDIANA_SETOR_ANO"], places=4)


LONG_RATIOS = ["VL_INDICADOR", "MEDIANA_GERAL_ANO", "MEDIANA_SETOR_ANO", "DELTA_VS_GERAL", "DELTA_VS_SETOR"]


def benchmark_long(spark, sf):
    table = benchmark.benchmark(lake.stored_mart(spark, sf))
    return report(table, [], LONG_RATIOS, places=4)


def filtered_agg(spark, sf):
    long = benchmark.unpivot_indicators(lake.mart(spark, sf))
    averages = benchmark.filtered_averages(long, "Agricultura (Açúcar, Álcool e Cana)")
    # Ratios and money share the columns: large values are reported whole.
    return averages.withColumns(
        {
            c: F.when(F.abs(c) >= 10000, F.round(c, 0)).otherwise(F.round(c, 6))
            for c in ("MEDIA_SETOR", "MEDIA_DEMAIS", "MAXIMO_DEMAIS")
        }
    )


def risk_notes(spark, sf):
    inputs = [i for _, i, *_ in S.LINEAR_NOTES] + [i for _, i, _ in S.TARGET_NOTES]
    return report(benchmark.risk_notes(lake.mart(spark, sf)), [], inputs)


SCORES = [score for score, *_ in S.SCORE_DIMENSIONS]


def risk_dimensions(spark, sf):
    return report(benchmark.risk_scores(lake.mart(spark, sf)).select(*KEYS, *SCORES), [], SCORES)


def risk_score(spark, sf):
    scored = benchmark.risk_scores(lake.mart(spark, sf)).select(*benchmark.LONG_KEYS, "SCORE_IPRF", "FAIXA_IPRF")
    return report(scored, [], ["SCORE_IPRF"], places=9)


def _stored_scores(spark, sf):
    scored = benchmark.risk_scores(lake.mart(spark, sf)).select(*benchmark.LONG_KEYS, "SCORE_IPRF", "FAIXA_IPRF")
    return materialise(scored, "scores")


def score_peer_rank(spark, sf):
    peers = benchmark.score_peers(_stored_scores(spark, sf))
    return report(peers, [], ["SCORE_IPRF", "MEDIANA_IPRF_SETOR_ANO"], places=9)


def score_peer_rank_distributed(spark, sf):
    """The same ranks over the stored mart."""
    scored = benchmark.risk_scores(lake.stored_mart(spark, sf)).select(*benchmark.LONG_KEYS, "SCORE_IPRF", "FAIXA_IPRF")
    return report(benchmark.score_peers(materialise(scored, "scores")), [], ["SCORE_IPRF", "MEDIANA_IPRF_SETOR_ANO"], places=9)


def score_history(spark, sf):
    return report(serving.score_history(benchmark.risk_scores(lake.mart(spark, sf))), [], ["SCORE_IPRF", "VARIACAO"], places=9)


def score_peers(spark, sf):
    """Scores of the last year ranked in every sector, with their sector median and rank."""
    scores = _stored_scores(spark, sf)
    peers = benchmark.score_peers(scores)
    return report(serving.score_peers_of_last_year(peers, scores), [], ["SCORE_IPRF", "MEDIANA_IPRF_SETOR_ANO"], places=9)


def indicator_ranking(spark, sf):
    ranked = benchmark.indicator_ranking(benchmark.unpivot_indicators(lake.mart(spark, sf)))
    return report(ranked, [], ["VL_INDICADOR"], places=4)


def indicator_snapshot(spark, sf):
    stored = lake.stored_mart(spark, sf)
    return report(benchmark.indicator_snapshot(benchmark.unpivot_indicators(stored)), [], ["VL_INDICADOR"], places=4)


COMPARED = ["LIQ_CORRENTE", "LIQ_SECA", "MARGEM_LIQUIDA", "ROE", "GIRO_ESTOQUES", "PMRE", "CICLO_FINANCEIRO", "NCG", "ST"]


def entity_vs_sector(spark, sf):
    compared = benchmark.entity_against_sector(lake.stored_mart(spark, sf), COMPARED)
    return report(compared, [], ["VL_INDICADOR", "MEDIANA_SETOR_ANO"], places=4)


def indicator_long_status(spark, sf):
    balances = mart.second_order(_first(spark, sf))
    table = benchmark.indicators_with_status(balances)
    return report(table, ["VL_NUMERADOR", "VL_DENOMINADOR"], ["VL_INDICADOR"], places=4)


def mart_quality(spark, sf):
    return audit.mart_quality(lake.mart(spark, sf))


def indicator_fill_rate(spark, sf):
    return screening.fill_rates(lake.mart(spark, sf), S.BENCHMARK_INDICATORS, 95, 70)


def overview_history(spark, sf):
    history = serving.overview_history(lake.mart(spark, sf))
    return report(history, ["AT", "PL", "REC_LIQ", "EBITDA", "LUCRO_LIQ", "DIVIDA_LIQUIDA"])


def write_readback_count(spark, sf):
    return written_rows(lake.mart(spark, sf), work_path(spark, "mart"), ["ANO_FISCAL"])


def csv_export(spark, sf):
    """The mart's balances exported as text files with a header, read back, counted per year."""
    path = work_path(spark, "export")
    export_csv(lake.mart(spark, sf).select("CNPJ_CIA", "ANO_FISCAL", "AT", "LUCRO_LIQ"), path)
    back = spark.read.option("header", True).csv(path)
    return back.groupBy(F.col("ANO_FISCAL").cast("int").alias("ANO_FISCAL")).agg(
        F.count("*").alias("LINHAS"), F.count("AT").alias("COM_ATIVO"), F.count_distinct("CNPJ_CIA").alias("EMPRESAS")
    )


def published_view(spark, sf):
    """The mart published under a name and read with SQL."""
    publish_view(lake.mart(spark, sf), "finledger_mart")
    return spark.sql("SELECT ANO_FISCAL, count(*) AS LINHAS, count(ROE) AS COM_ROE FROM finledger_mart GROUP BY ANO_FISCAL")


QUERIES = {
    f.__name__: f
    for f in [
        account_pivot, mart_second_order, indicator_mart, scissors_effect, curated_mart, indicators_unpivot,
        median_overall, median_sector, median_sector_distributed, benchmark_long, filtered_agg, risk_notes,
        risk_dimensions, risk_score, score_peer_rank, score_peer_rank_distributed, score_history, score_peers,
        indicator_ranking, indicator_snapshot, entity_vs_sector, indicator_long_status, mart_quality,
        indicator_fill_rate, overview_history, write_readback_count, csv_export, published_view,
        mart_incremental, mart_touched,
    ]
} | {name: _ratios(*columns) for name, columns in RATIO_GROUPS.items()}
