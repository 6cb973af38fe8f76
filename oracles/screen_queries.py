"""Oracle text of the queries over the simple mart and the balance-sheet reports."""

from __future__ import annotations

import oracles.gold  # noqa: F401
import oracles.silver  # noqa: F401
from oracles.base import money, query, rounded
from oracles.gold import SIMPLE_INDICATORS, SIMPLE_MONEY, SIMPLE_RATIO_NAMES

V = "CAST(CAST(VL_CONTA_TRATADO AS DECIMAL(28,2)) AS DOUBLE) AS VL_CONTA_TRATADO"
YEARS = range(1995, 2002)
LIQUIDITY = ["IND_LIQUIDEZ_GERAL", "IND_LIQUIDEZ_CORRENTE", "IND_LIQUIDEZ_SECA", "IND_LIQUIDEZ_IMEDIATA"]
TABLE = [
    "IND_LIQUIDEZ_CORRENTE", "IND_PCT_AT", "IND_MARGEM_BRUTA", "IND_MARGEM_LIQUIDA", "IND_ROE", "IND_ROA", "IND_CICLO_FINANCEIRO",
]
INVERTED = {"IND_PCT_AT", "IND_CICLO_FINANCEIRO"}


def r(expression: str, name: str, places: int = 6) -> str:
    return f"round({expression}, {places}) + 0.0 AS {name}"


def m(expression: str, name: str) -> str:
    return f"CAST(CAST({expression} AS DECIMAL(28,2)) AS DOUBLE) AS {name}"


def chained(needs: str, first: str, body: str) -> str:
    """``body`` after one more expression list that follows the named ones."""
    sql = query(needs, f"@@{first}\n{body}")
    return sql.replace("\n@@", ",\n")


_long = f"SELECT SETOR_LABEL, INDICADOR, VALOR FROM (UNPIVOT prep_top ON {', '.join(TABLE)} INTO NAME INDICADOR VALUE VALOR)"
_fill = " UNION ALL ".join(f"SELECT '{c}' AS INDICADOR, count({c}) AS p, count(*) AS t FROM prep" for c in SIMPLE_INDICATORS)
_annual = (
    "annual AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY CNPJ_CIA, ANO ORDER BY DT_REFER DESC) AS rn FROM prep) WHERE rn = 1)"
)
_pick = ", ".join(
    f"arg_max({c}, ANO) FILTER (WHERE {c} IS NOT NULL) AS {c}"
    for c in (
        "RAZAO_SOCIAL", "SETOR_LABEL", "IND_LIQUIDEZ_CORRENTE", "IND_PCT_AT", "IND_MARGEM_LIQUIDA", "IND_ROE",
        "IND_CICLO_FINANCEIRO", "FLEURIET",
    )
)
_flags = f"""{_annual},
picked AS (SELECT CNPJ_CIA, max(ANO) AS y, {_pick} FROM annual GROUP BY CNPJ_CIA),
flags AS (SELECT *, CAST(LC_CRITICA AS INTEGER) + CAST(PCAT_ALTO AS INTEGER) + CAST(ML_NEGATIVA AS INTEGER) + CAST(ROE_NEGATIVO AS INTEGER)
  + CAST(CICLO_LONGO AS INTEGER) + CAST(FLEURIET_IV_V AS INTEGER) AS N_ALERTAS FROM (
  SELECT CNPJ_CIA, RAZAO_SOCIAL, SETOR_LABEL, y AS ANO, coalesce(IND_LIQUIDEZ_CORRENTE < 1, FALSE) AS LC_CRITICA,
    coalesce(IND_PCT_AT > 0.75, FALSE) AS PCAT_ALTO, coalesce(IND_MARGEM_LIQUIDA < -0.05, FALSE) AS ML_NEGATIVA,
    coalesce(IND_ROE < 0, FALSE) AS ROE_NEGATIVO, coalesce(IND_CICLO_FINANCEIRO > 365, FALSE) AS CICLO_LONGO,
    FLEURIET IN ('IV — Alto Risco', 'V — Muito Ruim') AS FLEURIET_IV_V FROM picked))"""
_alerts = ["LC_CRITICA", "PCAT_ALTO", "ML_NEGATIVA", "ROE_NEGATIVO", "CICLO_LONGO", "FLEURIET_IV_V"]
_profiles = [
    "I — Excelente", "II — Solido", "III — Insatisfatorio", "IV — Alto Risco", "V — Muito Ruim", "VI — Arriscado",
]
_summary = [
    "IND_LIQUIDEZ_CORRENTE", "IND_MARGEM_LIQUIDA", "IND_MARGEM_OPERACIONAL", "IND_ROE", "IND_ROA", "IND_PCT_AT", "IND_CICLO_FINANCEIRO",
]
_raw_money = [c for c in SIMPLE_MONEY if c.startswith("V") and c not in ("V06_ESTOQUES", "V26_LPA_DILUIDO")]

ORACLES = {
    "indicator_mart_simple": query("simple", f"SELECT * REPLACE ({money(*SIMPLE_MONEY)}, {rounded(*SIMPLE_RATIO_NAMES)}) FROM simple"),
    "mart_outer_assembly": query("simple_raw", f"SELECT * REPLACE ({money(*_raw_money)}) FROM simple_raw"),
    "useful_period": query("prep", "SELECT SETOR_LABEL, ANO, count(*) AS N FROM prep WHERE ANO BETWEEN 1996 AND 2000 GROUP BY ALL"),
    "universe_by_year": query(
        "prep", "SELECT ANO, count(DISTINCT CNPJ_CIA) AS N_EMPRESAS, count(DISTINCT SETOR_LABEL) AS N_SETORES FROM prep GROUP BY ALL"
    ),
    "top_sectors": query("top10", "SELECT * FROM top10"),
    "simple_fill_rate": query(
        "prep",
        f"""SELECT INDICADOR, p AS PREENCHIDOS, round(p * 100.0 / t, 2) AS COBERTURA_PCT,
CASE WHEN round(p * 100.0 / t, 2) >= 90 THEN 'OK' WHEN round(p * 100.0 / t, 2) >= 70 THEN 'PARCIAL' ELSE 'BAIXA' END AS STATUS FROM ({_fill})""",
    ),
    "median_trend": query(
        "prep",
        f"SELECT ANO, INDICADOR, {r('quantile_cont(VALOR, 0.5)', 'MEDIANA')} FROM (UNPIVOT prep ON {', '.join(LIQUIDITY)} INTO NAME INDICADOR VALUE VALOR) GROUP BY ALL",
    ),
    "median_heat": query(
        "prep_top",
        "SELECT SETOR_LABEL, "
        + ", ".join(r(f"quantile_cont(IND_LIQUIDEZ_CORRENTE, 0.5) FILTER (WHERE ANO = {y})", f"ANO_{y}") for y in YEARS)
        + " FROM prep_top WHERE IND_LIQUIDEZ_CORRENTE IS NOT NULL GROUP BY ALL",
    ),
    "percentile_table": query(
        "prep_top",
        "SELECT SETOR_LABEL, INDICADOR, "
        + ", ".join(r(f"quantile_cont(VALOR, {p / 100})", f"P{p}") for p in (25, 50, 75, 90))
        + f" FROM ({_long}) GROUP BY ALL",
    ),
    "sector_scorecard": chained(
        "prep_top",
        f"md AS (SELECT SETOR_LABEL, INDICADOR, quantile_cont(VALOR, 0.5) AS v FROM ({_long}) GROUP BY ALL), "
        "rk AS (SELECT SETOR_LABEL, INDICADOR, (rank() OVER (PARTITION BY INDICADOR ORDER BY v) + (count(*) OVER (PARTITION BY INDICADOR, v) - 1) / 2.0)"
        " / count(*) OVER (PARTITION BY INDICADOR) AS s FROM md)",
        "SELECT SETOR_LABEL, "
        + ", ".join(
            r(f"max({'1 - s' if c in INVERTED else 's'}) FILTER (WHERE INDICADOR = '{c}')", c) for c in TABLE
        )
        + " FROM rk GROUP BY ALL",
    ),
    "describe_by_sector": query(
        "prep",
        f"""SELECT SETOR_LABEL, count(x) AS N, {r('avg(x)', 'MEDIA')}, {r('stddev_samp(x)', 'DESVIO')}, {r('min(x)', 'MINIMO')}, {r('max(x)', 'MAXIMO')},
{r('quantile_cont(x, 0.25)', 'P25')}, {r('quantile_cont(x, 0.5)', 'P50')}, {r('quantile_cont(x, 0.75)', 'P75')}
FROM (SELECT SETOR_LABEL, IND_LIQUIDEZ_CORRENTE AS x FROM prep WHERE IND_LIQUIDEZ_CORRENTE IS NOT NULL) GROUP BY ALL""",
    ),
    "working_capital_profile": query(
        "prep",
        "SELECT FLEURIET, N, round(N * 100.0 / sum(N) OVER (), 2) AS PCT FROM (SELECT FLEURIET, count(*) AS N FROM prep GROUP BY ALL)",
    ),
    "class_mix_by_year": query(
        "prep",
        f"""SELECT ANO, p AS FLEURIET, count(*) FILTER (WHERE FLEURIET = p) AS N, round(count(*) FILTER (WHERE FLEURIET = p) / count(*), 6) AS PROPORCAO
FROM prep, (VALUES {', '.join(f"('{p}')" for p in _profiles)}) d(p) WHERE FLEURIET <> 'Indefinido' GROUP BY ALL""",
    ),
    "intensity_ratios": query(
        "prep",
        f"""SELECT CNPJ_CIA, DT_REFER, {r('AUX_DIVIDA_LIQUIDA / nullif(V01_ATIVO_TOTAL, 0)', 'IND_DL_AT')},
{r('IND_CGL / nullif(V01_ATIVO_TOTAL, 0)', 'IND_CGL_AT')}, {r('IND_NCG / nullif(V01_ATIVO_TOTAL, 0)', 'IND_NCG_AT')} FROM prep""",
    ),
    "winsorise": query(
        "prep",
        f"""SELECT CNPJ_CIA, DT_REFER, {r('x', 'IND_LIQUIDEZ_CORRENTE')}, {r('CASE WHEN x IS NOT NULL THEN least(greatest(x, lo), hi) END', 'IND_LIQUIDEZ_CORRENTE_VIZ')}
FROM (SELECT CNPJ_CIA, DT_REFER, ANO, IND_LIQUIDEZ_CORRENTE AS x FROM prep) LEFT JOIN (
SELECT ANO, quantile_cont(IND_LIQUIDEZ_CORRENTE, 0.02) AS lo, quantile_cont(IND_LIQUIDEZ_CORRENTE, 0.98) AS hi FROM prep GROUP BY ALL) USING (ANO)""",
    ),
    "outlier_distance": chained(
        "prep_top",
        """p AS (SELECT CNPJ_CIA, ANO, IND_MARGEM_BRUTA AS X, IND_MARGEM_LIQUIDA AS Y FROM prep_top
  WHERE ANO = (SELECT max(ANO) FROM prep_top) AND IND_MARGEM_BRUTA IS NOT NULL AND IND_MARGEM_LIQUIDA IS NOT NULL),
c AS (SELECT quantile_cont(X, 0.5) AS mx, quantile_cont(Y, 0.5) AS my, stddev_samp(X) AS sx, stddev_samp(Y) AS sy FROM p)""",
        f"""SELECT CNPJ_CIA, ANO, {r('X', 'X', 4)}, {r('Y', 'Y', 4)}, {r('d', 'DISTANCIA', 4)} FROM (
SELECT *, sqrt(power((X - mx) / nullif(sx, 0), 2) + power((Y - my) / nullif(sy, 0), 2)) AS d FROM p, c) ORDER BY d DESC NULLS LAST, CNPJ_CIA LIMIT 13""",
    ),
    "latest_non_null": query(
        "prep",
        "SELECT CNPJ_CIA, max(DT_REFER) AS DT_REFER, "
        + ", ".join(
            r(f"arg_max({c}, DT_REFER) FILTER (WHERE {c} IS NOT NULL)", c)
            for c in ("IND_LIQUIDEZ_CORRENTE", "IND_ROE", "IND_CICLO_FINANCEIRO")
        )
        + " FROM prep GROUP BY CNPJ_CIA",
    ),
    "alert_radar": chained("prep", _flags, "SELECT * FROM flags"),
    "alert_frequency": chained(
        "prep",
        _flags,
        " UNION ALL ".join(
            f"SELECT count(*) AS EMPRESAS, '{a}' AS ALERTA, count(*) FILTER (WHERE {a}) AS N, round(count(*) FILTER (WHERE {a}) * 100.0 / count(*), 2) AS PCT FROM flags"
            for a in _alerts
        ),
    ),
    "executive_summary": chained(
        "prep",
        f"{_flags}, lasty AS (SELECT * FROM annual WHERE ANO = (SELECT max(ANO) FROM annual))",
        " UNION ALL ".join(f"SELECT '{c}' AS METRICA, {r(f'quantile_cont({c}, 0.5)', 'VALOR')} FROM lasty" for c in _summary)
        + " UNION ALL SELECT 'FLEURIET_I_II', round(avg(CASE WHEN FLEURIET IN ('I — Excelente', 'II — Solido') THEN 1.0 ELSE 0.0 END), 6) FROM lasty"
        + " UNION ALL SELECT 'EMPRESAS_3_ALERTAS', round(avg(CASE WHEN N_ALERTAS >= 3 THEN 1.0 ELSE 0.0 END), 6) FROM flags",
    ),
    "explore_mean": query(
        "prep", f"SELECT SETOR_LABEL, {r('avg(IND_LIQUIDEZ_CORRENTE)', 'MEDIA')}, count(IND_LIQUIDEZ_CORRENTE) AS N FROM prep GROUP BY ALL"
    ),
    "entity_statement": query(
        "n1_bp",
        f"SELECT CNPJ_CIA, DT_REFER, CD_CONTA, DS_CONTA, {r('VL_CONTA_TRATADO / 1000', 'VALOR', 8)} FROM n1_bp WHERE CD_CONTA_QTD_DIGITOS <= 5",
    ),
    "reference_dates": query("dfc_rolled", "SELECT DISTINCT CNPJ_CIA, DT_REFER FROM dfc_rolled"),
    "statement_pivot": query(
        "n1_bp",
        "SELECT CNPJ_CIA, CD_CONTA, DS_CONTA, "
        + ", ".join(m(f"coalesce(sum(VL_CONTA_TRATADO) FILTER (WHERE DT_REFER_ANO = {y}), 0)", f"ANO_{y}") for y in YEARS)
        + " FROM n1_bp GROUP BY ALL",
    ),
    "latest_period": query(
        "n1_bp",
        f"SELECT CNPJ_CIA, DT_REFER, CD_CONTA, {V} FROM n1_bp b WHERE DT_REFER = (SELECT max(DT_REFER) FROM n1_bp x WHERE x.CNPJ_CIA = b.CNPJ_CIA)",
    ),
    "yoy_growth": query(
        "bp_rolled",
        f"""SELECT CNPJ_CIA, DT_REFER, {m('v', 'VALOR')}, {r('coalesce(v / nullif(lag(v) OVER (PARTITION BY CNPJ_CIA ORDER BY DT_REFER), 0) - 1, 0)', 'VARIACAO')}
FROM (SELECT CNPJ_CIA, DT_REFER, CAST(v AS DOUBLE) AS v FROM bp_rolled WHERE CD_CONTA = '1')""",
    ),
    "cagr": query(
        "bp_rolled",
        f"""SELECT CNPJ_CIA, {m('a', 'INICIAL')}, {m('z', 'FINAL')}, N, {r('CASE WHEN N >= 2 AND a > 0 AND z >= 0 THEN power(z / a, 1.0 / (N - 1)) - 1 ELSE 0 END', 'CAGR')}
FROM (SELECT CNPJ_CIA, CAST(arg_min(v, DT_REFER) AS DOUBLE) AS a, CAST(arg_max(v, DT_REFER) AS DOUBLE) AS z, count(*) AS N FROM bp_rolled WHERE CD_CONTA = '1' GROUP BY ALL)""",
    ),
    "statement_highlights": query(
        "n1_dre",
        f"""SELECT CNPJ_CIA, DT_REFER_ANO AS ANO_FISCAL, CD_CONTA, DS_CONTA, {V} FROM (SELECT *,
row_number() OVER (PARTITION BY CNPJ_CIA, DT_REFER_ANO, CD_CONTA ORDER BY DT_REFER DESC) AS rn FROM n1_dre WHERE CD_CONTA IN ('3.01', '3.03', '3.05', '3.11')) WHERE rn = 1""",
    ),
    "top_entities": query(
        "n1_bp",
        f"""SELECT CNPJ_CIA, DENOM_CIA, SETOR_ATIV, {r('VL_CONTA_TRATADO / 1e9', 'BILHOES')} FROM n1_bp
WHERE CD_CONTA = '1' AND DT_REFER = (SELECT max(DT_REFER) FROM n1_bp) ORDER BY BILHOES DESC, CNPJ_CIA LIMIT 10""",
    ),
}
