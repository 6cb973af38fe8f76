"""Oracle text of the queries over the strict mart, its benchmark and the score."""

from __future__ import annotations

import oracles.gold  # noqa: F401
import oracles.silver  # noqa: F401
from oracles.fixed import BENCHMARK_INDICATORS, MART_ACCOUNTS, PRIORITY_INDICATORS
from oracles.base import money, query, rounded
from oracles.gold import DIMENSIONS, MART_MONEY, MART_RATIOS, NOTE_INPUTS

FIRST_MONEY = [c for c in MART_MONEY if c in MART_ACCOUNTS] + ["DEP_AMORT", "LPA_DILUIDO_ON", "LPA_BASICO_ON", "LPA_3_99"]
TERMS = ["ACF", "PCF", "CGL", "CPV_ABS", "ESTOQUE_OPERACIONAL", "DIVIDA_BRUTA", "CAPEX", "ACO", "PCO"]


def shown(*columns: str) -> str:
    return ", ".join(
        money(c) if c in MART_MONEY else (rounded(c) if c in MART_RATIOS else c) for c in columns
    )


def whole(table: str, needs: str) -> str:
    replaced = ", ".join([money(*MART_MONEY), rounded(*MART_RATIOS)])
    return query(needs, f"SELECT * REPLACE ({replaced}) FROM {table}")


def ratios(*columns: str) -> str:
    return query("mart", f"SELECT CNPJ_CIA, ANO_FISCAL, {shown(*columns)} FROM mart")


_priority = ", ".join(f"({i}, '{g}', '{c}', '{b}')" for i, (g, c, b) in enumerate(PRIORITY_INDICATORS))
_compared = ["LIQ_CORRENTE", "LIQ_SECA", "MARGEM_LIQUIDA", "ROE", "GIRO_ESTOQUES", "PMRE", "CICLO_FINANCEIRO", "NCG", "ST"]
_status = [
    ("LIQ_GERAL", "AC + RLP", "PC + PNC"), ("LIQ_CORRENTE", "AC", "PC"), ("LIQ_SECA", "AC - ESTOQUE_OPERACIONAL", "PC"),
    ("LIQ_IMEDIATA", "ACF", "PC"), ("ENDIV_CP", "PC + PNC", "PL"), ("ENDIV_TOTAL", "PC + PNC", "AT"),
    ("GARANTIA_CP_CT", "PL", "PC + PNC"), ("COMPOSICAO_ENDIV", "PC", "PC + PNC"), ("IMOB_PL", "IMOBILIZADO", "PL"),
    ("IMOB_AT", "IMOBILIZADO", "AT"), ("MARGEM_BRUTA", "LUCRO_BRUTO", "REC_LIQ"), ("MARGEM_OPERACIONAL", "EBIT", "REC_LIQ"),
    ("MARGEM_LIQUIDA", "LUCRO_LIQ", "REC_LIQ"), ("LPA", "LPA_3_99", "1"), ("ROA", "LUCRO_LIQ", "AT"), ("ROE", "LUCRO_LIQ", "PL"),
    ("ROI", "LUCRO_LIQ", "PL + DIVIDA_BRUTA"), ("GIRO_ESTOQUES", "CPV_ABS", "ESTOQUE_OPERACIONAL"),
    ("GIRO_CLIENTES", "REC_LIQ", "CLIENTES"), ("GIRO_FORNECEDORES", "CPV_ABS", "FORNECEDORES"), ("GIRO_AC", "REC_LIQ", "AC"),
    ("PMRE", "ESTOQUE_OPERACIONAL * 360", "CPV_ABS"), ("PMRV", "CLIENTES * 360", "REC_LIQ"), ("PMPC", "FORNECEDORES * 360", "CPV_ABS"),
    ("PMRAC", "AC * 360", "REC_LIQ"),
    ("CICLO_ECONOMICO", "ESTOQUE_OPERACIONAL * 360 / nullif(CPV_ABS, 0) + CLIENTES * 360 / nullif(REC_LIQ, 0)", "1"),
    ("CICLO_FINANCEIRO", "(ESTOQUE_OPERACIONAL - FORNECEDORES) * 360 / nullif(CPV_ABS, 0) + CLIENTES * 360 / nullif(REC_LIQ, 0)", "1"),
    ("CGL", "AC - PC", "1"), ("NCG", "ACO - PCO", "1"), ("ST", "ACF - PCF", "1"), ("SALDO_FINAL_CAIXA", "SALDO_FINAL_CAIXA_DFC", "1"),
]
_status_rows = " UNION ALL ".join(
    f"SELECT CNPJ_CIA, ANO_FISCAL, '{c}' AS COD_INDICADOR, CAST({n} AS DOUBLE) AS n, CAST({d} AS DOUBLE) AS d FROM second" for c, n, d in _status
)
_fill = " UNION ALL ".join(f"SELECT '{c}' AS INDICADOR, count({c}) AS p, count(*) AS t FROM mart" for c in BENCHMARK_INDICATORS)

ORACLES = {
    "account_pivot": query("first_plain", f"SELECT * EXCLUDE (SETOR) REPLACE ({money(*FIRST_MONEY)}) FROM first_plain"),
    "mart_second_order": query("second", f"SELECT CNPJ_CIA, ANO_FISCAL, {money(*TERMS)} FROM second"),
    "indicator_mart": whole("mart", "mart"),
    "mart_incremental": whole("mart", "mart"),
    "mart_touched": query(
        "mart",
        """SELECT CASE ANO_FISCAL % 5 WHEN 0 THEN 'NOVO' WHEN 1 THEN 'ALTERADO' ELSE 'RETIRADO' END AS SITUACAO, count(*) AS LINHAS
FROM mart WHERE ANO_FISCAL % 5 < 3 GROUP BY ALL""",
    ),
    "scissors_effect": query("mart", f"SELECT CNPJ_CIA, ANO_FISCAL, {money('ST')}, EFEITO_TESOURA FROM mart"),
    "curated_mart": whole("cur_mart", "cur_mart"),
    "indicators_unpivot": query("long", f"SELECT * REPLACE ({rounded('VL_INDICADOR', places=4)}) FROM long"),
    "median_overall": query("med_overall", f"SELECT * REPLACE ({rounded('MEDIANA_GERAL_ANO', places=4)}) FROM med_overall"),
    "median_sector": query("med_sector", f"SELECT * REPLACE ({rounded('MEDIANA_SETOR_ANO', places=4)}) FROM med_sector"),
    "median_sector_distributed": query("med_sector", f"SELECT * REPLACE ({rounded('MEDIANA_SETOR_ANO', places=4)}) FROM med_sector"),
    "benchmark_long": query(
        "long med_overall med_sector",
        """SELECT b.CNPJ_CIA, b.DENOM_CIA, b.SETOR, b.ANO_FISCAL, b.COD_INDICADOR, round(VL_INDICADOR, 4) + 0.0 AS VL_INDICADOR,
round(MEDIANA_GERAL_ANO, 4) + 0.0 AS MEDIANA_GERAL_ANO, round(MEDIANA_SETOR_ANO, 4) + 0.0 AS MEDIANA_SETOR_ANO,
round(VL_INDICADOR - MEDIANA_GERAL_ANO, 4) + 0.0 AS DELTA_VS_GERAL, round(VL_INDICADOR - MEDIANA_SETOR_ANO, 4) + 0.0 AS DELTA_VS_SETOR
FROM long b LEFT JOIN med_overall g ON g.ANO_FISCAL = b.ANO_FISCAL AND g.COD_INDICADOR = b.COD_INDICADOR
LEFT JOIN med_sector s ON s.ANO_FISCAL = b.ANO_FISCAL AND s.SETOR = b.SETOR AND s.COD_INDICADOR = b.COD_INDICADOR""",
    ),
    "filtered_agg": query(
        "long",
        "SELECT ANO_FISCAL, COD_INDICADOR, "
        + ", ".join(
            f"CASE WHEN abs({c}) >= 10000 THEN round({c}, 0) ELSE round({c}, 6) END + 0.0 AS {c}"
            for c in ("MEDIA_SETOR", "MEDIA_DEMAIS", "MAXIMO_DEMAIS")
        )
        + """ FROM (SELECT ANO_FISCAL, COD_INDICADOR, avg(VL_INDICADOR) FILTER (WHERE SETOR = 'Agricultura (Açúcar, Álcool e Cana)') AS MEDIA_SETOR,
avg(VL_INDICADOR) FILTER (WHERE SETOR IS DISTINCT FROM 'Agricultura (Açúcar, Álcool e Cana)') AS MEDIA_DEMAIS,
max(VL_INDICADOR) FILTER (WHERE SETOR IS DISTINCT FROM 'Agricultura (Açúcar, Álcool e Cana)') AS MAXIMO_DEMAIS FROM long GROUP BY ALL)""",
    ),
    "risk_notes": query("notes", f"SELECT * REPLACE ({rounded(*NOTE_INPUTS)}) FROM notes"),
    "risk_dimensions": query("scores", f"SELECT CNPJ_CIA, ANO_FISCAL, {rounded(*DIMENSIONS)} FROM scores"),
    "risk_score": query(
        "scores", "SELECT CNPJ_CIA, DENOM_CIA, SETOR, ANO_FISCAL, round(SCORE_IPRF, 9) + 0.0 AS SCORE_IPRF, FAIXA_IPRF FROM scores"
    ),
    "score_peer_rank": query("peers", f"SELECT * REPLACE ({rounded('SCORE_IPRF', 'MEDIANA_IPRF_SETOR_ANO', places=9)}) FROM peers"),
    "score_peer_rank_distributed": query("peers", f"SELECT * REPLACE ({rounded('SCORE_IPRF', 'MEDIANA_IPRF_SETOR_ANO', places=9)}) FROM peers"),
    "score_history": query(
        "scores",
        """SELECT CNPJ_CIA, ANO_FISCAL, round(SCORE_IPRF, 9) + 0.0 AS SCORE_IPRF, FAIXA_IPRF,
round(SCORE_IPRF - lag(SCORE_IPRF) OVER (PARTITION BY CNPJ_CIA ORDER BY ANO_FISCAL), 9) + 0.0 AS VARIACAO FROM scores""",
    ),
    "score_peers": query(
        "peers",
        """SELECT * REPLACE (round(SCORE_IPRF, 9) + 0.0 AS SCORE_IPRF, round(MEDIANA_IPRF_SETOR_ANO, 9) + 0.0 AS MEDIANA_IPRF_SETOR_ANO) FROM (SELECT *,
CAST(row_number() OVER (PARTITION BY SETOR ORDER BY SCORE_IPRF DESC, CNPJ_CIA) AS INTEGER) AS POSICAO
FROM peers WHERE ANO_FISCAL = (SELECT max(ANO_FISCAL) FROM peers))""",
    ),
    "indicator_ranking": query(
        "long",
        f"""SELECT CNPJ_CIA, DENOM_CIA, SETOR, ANO_FISCAL, COD_INDICADOR, round(VL_INDICADOR, 4) + 0.0 AS VL_INDICADOR, POSICAO FROM (
SELECT l.*, CAST(row_number() OVER (PARTITION BY ANO_FISCAL, SETOR, COD_INDICADOR
  ORDER BY CASE b WHEN 'lower' THEN VL_INDICADOR ELSE -VL_INDICADOR END, CNPJ_CIA) AS INTEGER) AS POSICAO
FROM long l JOIN (VALUES {_priority}) p(i, g, c, b) ON c = COD_INDICADOR)""",
    ),
    "indicator_snapshot": query(
        "long",
        f"""SELECT k.CNPJ_CIA, k.ANO_FISCAL, i AS ORDEM, g AS GRUPO, c AS COD_INDICADOR, round(VL_INDICADOR, 4) + 0.0 AS VL_INDICADOR
FROM (SELECT CNPJ_CIA, max(ANO_FISCAL) AS ANO_FISCAL FROM long GROUP BY ALL) k, (VALUES {_priority}) p(i, g, c, b)
LEFT JOIN long l ON l.CNPJ_CIA = k.CNPJ_CIA AND l.ANO_FISCAL = k.ANO_FISCAL AND l.COD_INDICADOR = c""",
    ),
    "entity_vs_sector": query(
        "mart",
        f""", u AS (SELECT CNPJ_CIA, SETOR, ANO_FISCAL, COD_INDICADOR, VL_INDICADOR FROM (UNPIVOT mart ON {', '.join(_compared)} INTO NAME COD_INDICADOR VALUE VL_INDICADOR)),
md AS (SELECT ANO_FISCAL, SETOR, COD_INDICADOR, quantile_cont(VL_INDICADOR, 0.5) AS md FROM u GROUP BY ALL)
SELECT u.CNPJ_CIA, u.ANO_FISCAL, u.COD_INDICADOR, round(VL_INDICADOR, 4) + 0.0 AS VL_INDICADOR, round(md, 4) + 0.0 AS MEDIANA_SETOR_ANO
FROM u JOIN md ON md.ANO_FISCAL = u.ANO_FISCAL AND md.SETOR = u.SETOR AND md.COD_INDICADOR = u.COD_INDICADOR""",
    ).replace("\n, u AS", ", u AS"),
    "indicator_long_status": query(
        "second",
        f"""SELECT CNPJ_CIA, ANO_FISCAL, COD_INDICADOR, CAST(CAST(n AS DECIMAL(28,2)) AS DOUBLE) AS VL_NUMERADOR,
CAST(CAST(d AS DECIMAL(28,2)) AS DOUBLE) AS VL_DENOMINADOR, round(n / nullif(d, 0), 4) + 0.0 AS VL_INDICADOR,
CASE WHEN n IS NULL THEN 'CONTA_AUSENTE' WHEN coalesce(d, 0) = 0 THEN 'DENOMINADOR_ZERO_OU_NULO' ELSE 'OK' END AS STATUS_CALCULO FROM ({_status_rows})""",
    ),
    "mart_quality": query(
        "mart",
        """SELECT count(*) FILTER (WHERE LIQ_CORRENTE < 0) AS LIQ_CORRENTE_NEGATIVA, count(*) FILTER (WHERE PMRE < 0) AS PMRE_NEGATIVO,
count(*) FILTER (WHERE PMRV < 0) AS PMRV_NEGATIVO, count(*) FILTER (WHERE PMPC < 0) AS PMPC_NEGATIVO,
count(*) FILTER (WHERE PL < 0 AND ROE IS NOT NULL) AS ROE_COM_PL_NEGATIVO, count(*) FILTER (WHERE LPA IS NULL) AS LPA_NULO,
count(AT_BIOLOGICO) AS LINHAS_COM_BIOLOGICO, count(DISTINCT CNPJ_CIA) FILTER (WHERE AT_BIOLOGICO IS NOT NULL) AS EMPRESAS_COM_BIOLOGICO,
count(*) FILTER (WHERE AT_BIOLOGICO IS NULL) AS LINHAS_SEM_BIOLOGICO FROM mart""",
    ),
    "indicator_fill_rate": query(
        "mart",
        f"""SELECT INDICADOR, p AS PREENCHIDOS, round(p * 100.0 / t, 2) + 0.0 AS COBERTURA_PCT,
CASE WHEN round(p * 100.0 / t, 2) >= 95 THEN 'OK' WHEN round(p * 100.0 / t, 2) >= 70 THEN 'PARCIAL' ELSE 'BAIXA' END AS STATUS FROM ({_fill})""",
    ),
    "overview_history": query(
        "mart",
        f"SELECT CNPJ_CIA, ANO_FISCAL, {money('AT', 'PL', 'REC_LIQ', 'EBITDA', 'LUCRO_LIQ', 'DIVIDA_LIQUIDA')}, EFEITO_TESOURA FROM mart",
    ),
    "csv_export": query(
        "mart",
        "SELECT ANO_FISCAL, count(*) AS LINHAS, count(AT) AS COM_ATIVO, count(DISTINCT CNPJ_CIA) AS EMPRESAS FROM mart GROUP BY ANO_FISCAL",
    ),
    "published_view": query("mart", "SELECT ANO_FISCAL, count(*) AS LINHAS, count(ROE) AS COM_ROE FROM mart GROUP BY ANO_FISCAL"),
    "write_readback_count": query(
        "mart", "SELECT ANO_FISCAL, count(*) AS ESPERADO, count(*) AS GRAVADO, TRUE AS CONFERE FROM mart GROUP BY ALL"
    ),
    "ratios_liquidity": ratios("LIQ_CORRENTE", "LIQ_SECA", "LIQ_SECA_AJUSTADA", "LIQ_IMEDIATA", "LIQ_GERAL"),
    "ratios_debt": ratios(
        "ENDIV_TOTAL", "GRAU_ENDIVIDAMENTO", "ENDIV_CP", "GARANTIA_CP_CT", "COMPOSICAO_ENDIV", "IMOB_PL", "IMOB_AT",
        "DIVIDA_LIQUIDA", "DL_EBITDA",
    ),
    "ratios_margin": ratios("MARGEM_BRUTA", "MARGEM_OPERACIONAL", "MARGEM_EBITDA", "MARGEM_LIQUIDA", "EBITDA", "LPA"),
    "ratios_return": ratios("ROA", "ROE", "ROI"),
    "ratios_activity": ratios(
        "GIRO_ESTOQUES", "GIRO_ESTOQUES_AJUSTADO", "GIRO_CLIENTES", "GIRO_FORNECEDORES", "GIRO_ATIVO_TOTAL", "GIRO_AC",
        "PMRV", "PMRE", "PMRE_AJUSTADO", "PMPC", "PMRAC",
    ),
    "ratios_cycle": ratios("CICLO_ECONOMICO", "CICLO_FINANCEIRO", "CCC", "NCG", "ST", "CGL"),
    "ratios_cash": ratios(
        "COB_CAIXA_OPERACIONAL", "MARGEM_CAIXA_OPERACIONAL", "COBERTURA_DIVIDA_CAIXA", "INTENSIDADE_REINVESTIMENTO", "CAPEX",
    ),
}
