"""Oracle text of the marts, the benchmark and the score."""

from __future__ import annotations

from oracles.fixed import (
    BENCHMARK_INDICATORS,
    LINEAR_NOTES,
    MART_ACCOUNTS,
    SCORE_BANDS,
    SCORE_DIMENSIONS,
    SIMPLE_BALANCE_ACCOUNTS,
    SIMPLE_INCOME_ACCOUNTS,
    TARGET_NOTES,
)
from oracles.base import cte

_accounts = ", ".join(f"'{c}'" for c in [*MART_ACCOUNTS.values(), "6.01.01.02", "6.01.01.03", "6.01.01.04"])
cte(
    "balances",
    "typed",
    f"""
SELECT * FROM (SELECT *, DT_FIM_EXERC_ANO AS ANO_FISCAL,
    row_number() OVER (PARTITION BY CNPJ_CIA, DT_FIM_EXERC_ANO, GRUPO_DFP_TRATADO, CD_CONTA
                       ORDER BY VERSAO DESC, DT_REFER DESC, LINE_ID DESC, LINE_SEQ DESC, VL_CONTA DESC) AS rn
  FROM typed WHERE ORDEM_EXERC = 'ÚLTIMO' AND GRUPO_DFP_TRATADO IN ('BP', 'DRE', 'DFC') AND CD_CONTA IN ({_accounts}))
WHERE rn = 1
""",
)


def first_order(source: str, sector: str) -> str:
    columns = ",\n       ".join(
        f"CAST(max(VL_CONTA_TRATADO) FILTER (WHERE CD_CONTA = '{code}') AS DOUBLE) AS {name}"
        for name, code in MART_ACCOUNTS.items()
    )
    return f"""
SELECT CNPJ_CIA, ANO_FISCAL, max(DT_REFER) AS DT_REFER, max(DENOM_CIA) AS RAZAO_SOCIAL, {sector} AS SETOR, max(CD_CVM) AS CD_CVM,
       'MERCADO_ABERTO' AS TP_MERC, {columns},
       CAST(coalesce(sum(VL_CONTA_TRATADO) FILTER (WHERE CD_CONTA IN ('6.01.01.02', '6.01.01.03', '6.01.01.04')), 0) AS DOUBLE) AS DEP_AMORT
FROM {source} GROUP BY CNPJ_CIA, ANO_FISCAL
"""


cte("first_plain", "balances", first_order("balances", "NULL"))
cte(
    "first",
    "first_plain companies",
    "SELECT f.* REPLACE (c.SETOR_ATIV AS SETOR) FROM first_plain f LEFT JOIN companies c ON c.CNPJ_CIA = f.CNPJ_CIA",
)

# Ratios as (name, numerator, denominator, condition on the denominator).
RATIOS = [
    ("LIQ_CORRENTE", "AC", "PC", "> 0"),
    ("LIQ_SECA", "AC - ESTOQUE_OPERACIONAL", "PC", "> 0"),
    ("LIQ_SECA_AJUSTADA", "AC - ESTOQUE_OPERACIONAL", "PC", "> 0"),
    ("LIQ_IMEDIATA", "ACF", "PC", "> 0"),
    ("LIQ_GERAL", "AC + RLP", "PC + PNC", "> 0"),
    ("ENDIV_TOTAL", "PC + PNC", "AT", "> 0"),
    ("GRAU_ENDIVIDAMENTO", "PC + PNC", "AT", "> 0"),
    ("ENDIV_CP", "PC + PNC", "PL", "<> 0"),
    ("GARANTIA_CP_CT", "PL", "PC + PNC", "<> 0"),
    ("COMPOSICAO_ENDIV", "PC", "PC + PNC", "<> 0"),
    ("IMOB_PL", "IMOBILIZADO", "PL", "> 0"),
    ("IMOB_AT", "IMOBILIZADO", "AT", "> 0"),
    ("DL_EBITDA", "DIVIDA_BRUTA - coalesce(SALDO_FINAL_CAIXA_DFC, 0)", "EBIT + DEP_AMORT", "> 0"),
    ("MARGEM_BRUTA", "LUCRO_BRUTO", "REC_LIQ", "> 0"),
    ("MARGEM_OPERACIONAL", "EBIT", "REC_LIQ", "> 0"),
    ("MARGEM_EBITDA", "EBIT + DEP_AMORT", "REC_LIQ", "> 0"),
    ("MARGEM_LIQUIDA", "LUCRO_LIQ", "REC_LIQ", "> 0"),
    ("ROA", "LUCRO_LIQ", "AT", "> 0"),
    ("ROE", "LUCRO_LIQ", "PL", "> 0"),
    ("ROI", "LUCRO_LIQ", "DIVIDA_BRUTA + coalesce(PL, 0)", "<> 0"),
    ("GIRO_ESTOQUES", "CPV_ABS", "ESTOQUE_OPERACIONAL", "> 0"),
    ("GIRO_ESTOQUES_AJUSTADO", "CPV_ABS", "ESTOQUE_OPERACIONAL", "> 0"),
    ("GIRO_CLIENTES", "REC_LIQ", "CLIENTES", "> 0"),
    ("GIRO_FORNECEDORES", "CPV_ABS", "FORNECEDORES", "> 0"),
    ("GIRO_ATIVO_TOTAL", "REC_LIQ", "AT", "> 0"),
    ("GIRO_AC", "REC_LIQ", "AC", "> 0"),
    ("PMRV", "CLIENTES * 360.0", "REC_LIQ", "> 0"),
    ("PMRE", "ESTOQUE_OPERACIONAL * 360.0", "CPV_ABS", "> 0 AND coalesce(ESTOQUES, AT_BIOLOGICO) IS NOT NULL"),
    ("PMRE_AJUSTADO", "ESTOQUE_OPERACIONAL * 360.0", "CPV_ABS", "> 0 AND coalesce(ESTOQUES, AT_BIOLOGICO) IS NOT NULL"),
    ("PMPC", "FORNECEDORES * 360.0", "CPV_ABS", "> 0"),
    ("PMRAC", "AC * 360.0", "REC_LIQ", "> 0"),
    ("COB_CAIXA_OPERACIONAL", "CAIXA_OPERACIONAL", "PC", "> 0"),
    ("MARGEM_CAIXA_OPERACIONAL", "CAIXA_OPERACIONAL", "REC_LIQ", "> 0"),
    ("COBERTURA_DIVIDA_CAIXA", "CAIXA_OPERACIONAL", "DIVIDA_BRUTA", "> 0"),
    ("INTENSIDADE_REINVESTIMENTO", "CAPEX", "CAIXA_OPERACIONAL", "> 0"),
]
_ratios = ",\n       ".join(f"CASE WHEN ({d}) {guard} THEN ({n}) / ({d}) END AS {name}" for name, n, d, guard in RATIOS)


def mart_chain(prefix: str, first: str) -> None:
    cte(
        f"{prefix}second",
        first,
        f"""
SELECT *, coalesce(AC, 0) - ACF AS ACO, coalesce(PC, 0) - PCF AS PCO FROM (
  SELECT *, coalesce(CAIXA_EQUIV, 0) + coalesce(APLIC_FIN, 0) AS ACF, coalesce(EMP_FIN_CP, 0) AS PCF,
         coalesce(AC, 0) - coalesce(PC, 0) AS CGL, abs(coalesce(CPV, 0)) AS CPV_ABS,
         coalesce(ESTOQUES, 0) + coalesce(AT_BIOLOGICO, 0) AS ESTOQUE_OPERACIONAL,
         coalesce(EMP_FIN_CP, 0) + coalesce(EMP_FIN_LP, 0) AS DIVIDA_BRUTA,
         abs(coalesce(AQUISICAO_IMOBILIZADO_1, 0)) + abs(coalesce(AQUISICAO_IMOBILIZADO_2, 0))
           + abs(coalesce(AQUISICAO_INTANGIVEL, 0)) AS CAPEX
  FROM {first})
""",
    )
    cte(
        f"{prefix}mart",
        f"{prefix}second",
        f"""
SELECT * EXCLUDE (LPA_DILUIDO_ON, LPA_BASICO_ON, LPA_3_99, st1, st2),
       PMRE_AJUSTADO + PMRV AS CICLO_ECONOMICO, PMRE_AJUSTADO + PMRV - PMPC AS CICLO_FINANCEIRO,
       PMRE_AJUSTADO + PMRV - PMPC AS CCC,
       coalesce(ST < 0 AND st1 < 0 AND st2 < 0 AND ST < st1 AND st1 < st2, FALSE) AS EFEITO_TESOURA
FROM (SELECT *, lag(ST, 1) OVER w AS st1, lag(ST, 2) OVER w AS st2 FROM (
    SELECT *, coalesce(LPA_DILUIDO_ON, LPA_BASICO_ON, LPA_3_99) AS LPA, EBIT + DEP_AMORT AS EBITDA,
       DIVIDA_BRUTA - coalesce(SALDO_FINAL_CAIXA_DFC, 0) AS DIVIDA_LIQUIDA,
       ACO - PCO AS NCG, ACF - PCF AS ST, {_ratios}
    FROM {prefix}second) WINDOW w AS (PARTITION BY CNPJ_CIA ORDER BY ANO_FISCAL))
""",
    )


mart_chain("", "first")

# The same mart over the curated tables.
cte(
    "cur_balances",
    "n1_bp n1_dre n1_dfc",
    f"""
SELECT * FROM (SELECT *, DT_FIM_EXERC_ANO AS ANO_FISCAL,
    row_number() OVER (PARTITION BY CNPJ_CIA, DT_FIM_EXERC_ANO, GRUPO_DFP_TRATADO, CD_CONTA
                       ORDER BY VERSAO DESC, DT_REFER DESC, VL_CONTA_TRATADO DESC) AS rn
  FROM (SELECT * FROM n1_bp UNION ALL BY NAME SELECT * FROM n1_dre UNION ALL BY NAME SELECT * FROM n1_dfc)
  WHERE CD_CONTA IN ({_accounts})) WHERE rn = 1
""",
)
cte("cur_first", "cur_balances", first_order("cur_balances", "max(SETOR_ATIV)"))
mart_chain("cur_", "cur_first")

MART_MONEY = [
    *[c for c in MART_ACCOUNTS if not c.startswith("LPA")],
    "DEP_AMORT", "ACF", "PCF", "CGL", "CPV_ABS", "ESTOQUE_OPERACIONAL", "DIVIDA_BRUTA", "CAPEX", "ACO", "PCO",
    "LPA", "EBITDA", "DIVIDA_LIQUIDA", "NCG", "ST",
]
MART_RATIOS = [name for name, *_ in RATIOS] + ["CICLO_ECONOMICO", "CICLO_FINANCEIRO", "CCC"]

cte(
    "long",
    "mart",
    f"""
SELECT CNPJ_CIA, RAZAO_SOCIAL AS DENOM_CIA, SETOR, ANO_FISCAL, COD_INDICADOR, VL_INDICADOR
FROM (UNPIVOT mart ON {', '.join(BENCHMARK_INDICATORS)} INTO NAME COD_INDICADOR VALUE VL_INDICADOR)
""",
)
cte(
    "med_overall",
    "long",
    "SELECT ANO_FISCAL, COD_INDICADOR, quantile_cont(VL_INDICADOR, 0.5) AS MEDIANA_GERAL_ANO FROM long GROUP BY ALL",
)
cte(
    "med_sector",
    "long",
    "SELECT ANO_FISCAL, SETOR, COD_INDICADOR, quantile_cont(VL_INDICADOR, 0.5) AS MEDIANA_SETOR_ANO FROM long GROUP BY ALL",
)

_notes = []
for _note, _x, _zero, _ten in LINEAR_NOTES:
    if _ten > _zero:
        _notes.append(
            f"CASE WHEN {_x} <= {_zero} THEN 0.0 WHEN {_x} >= {_ten} THEN 10.0"
            f" ELSE round(10.0 * ({_x} - CAST({_zero} AS DOUBLE)) / CAST({round(_ten - _zero, 6)} AS DOUBLE), 4) END AS {_note}"
        )
    else:
        _notes.append(
            f"CASE WHEN {_x} >= {_zero} THEN 0.0 WHEN {_x} <= {_ten} THEN 10.0"
            f" ELSE round(10.0 * (CAST({_zero} AS DOUBLE) - {_x}) / CAST({round(_zero - _ten, 6)} AS DOUBLE), 4) END AS {_note}"
        )
for _note, _x, _target in TARGET_NOTES:
    _notes.append(
        f"CASE WHEN {_x} IS NULL THEN NULL WHEN {_x} < 0 THEN 0.0"
        f" ELSE round(greatest(0.0, 10.0 - abs({_x} - CAST({_target} AS DOUBLE)) * (CAST(10.0 AS DOUBLE) / {_target})), 4) END AS {_note}"
    )
NOTE_INPUTS = [n[1] for n in LINEAR_NOTES] + [n[1] for n in TARGET_NOTES]
NOTES = [n[0] for n in LINEAR_NOTES] + [n[0] for n in TARGET_NOTES]
DIMENSIONS = [name for name, _, _ in SCORE_DIMENSIONS]
_typed_notes = ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in NOTES)
cte(
    "notes",
    "mart",
    f"""
SELECT CNPJ_CIA, DENOM_CIA, SETOR, ANO_FISCAL, {', '.join(NOTE_INPUTS)}, {_typed_notes} FROM (
  SELECT CNPJ_CIA, RAZAO_SOCIAL AS DENOM_CIA, SETOR, ANO_FISCAL, {', '.join(NOTE_INPUTS)}, {', '.join(_notes)} FROM mart)
""",
)
_dimensions = ", ".join(
    f"list_sum([{', '.join(notes)}]) / nullif(list_count([{', '.join(notes)}]), 0) AS {name}" for name, _, notes in SCORE_DIMENSIONS
)
_weighted = " + ".join(f"coalesce(CAST({w} AS DOUBLE) * {n}, 0)" for n, w, _ in SCORE_DIMENSIONS)
_weights = " + ".join(f"(CASE WHEN {n} IS NULL THEN 0 ELSE CAST({w} AS DOUBLE) END)" for n, w, _ in SCORE_DIMENSIONS)
_bands = " ".join(f"WHEN SCORE_IPRF >= {floor} THEN '{label}'" for floor, label in SCORE_BANDS)
cte("dimensions", "notes", f"SELECT *, {_dimensions} FROM notes")
cte(
    "scores",
    "dimensions",
    f"""
SELECT *, CASE WHEN SCORE_IPRF IS NULL THEN NULL {_bands} ELSE 'Critico' END AS FAIXA_IPRF
FROM (SELECT *, ({_weighted}) / nullif({_weights}, 0) AS SCORE_IPRF FROM dimensions)
""",
)
cte(
    "peers",
    "scores",
    """
SELECT b.CNPJ_CIA, b.DENOM_CIA, b.SETOR, b.ANO_FISCAL, b.SCORE_IPRF, b.FAIXA_IPRF, m.md AS MEDIANA_IPRF_SETOR_ANO,
       CAST(dense_rank() OVER (PARTITION BY b.ANO_FISCAL, b.SETOR ORDER BY b.SCORE_IPRF DESC) AS INTEGER) AS RANK_IPRF_SETOR_ANO,
       round(100 * percent_rank() OVER (PARTITION BY b.ANO_FISCAL, b.SETOR ORDER BY b.SCORE_IPRF), 2) AS PERCENTIL_IPRF_SETOR_ANO
FROM (SELECT * FROM scores WHERE SCORE_IPRF IS NOT NULL) b
LEFT JOIN (SELECT ANO_FISCAL, SETOR, quantile_cont(SCORE_IPRF, 0.5) AS md FROM scores GROUP BY ALL) m
  ON m.ANO_FISCAL = b.ANO_FISCAL AND m.SETOR = b.SETOR
""",
)

# --- simple mart ------------------------------------------------------------------------------


def _wide(source: str, accounts: dict[str, str]) -> str:
    picks = ", ".join(
        f"max(v) FILTER (WHERE CD_CONTA = '{code}'"
        + (" AND abs(v) <= 10000" if code.startswith("3.99") else "")
        + f") AS {name}"
        for name, code in accounts.items()
    )
    return f"SELECT CNPJ_CIA, DT_REFER, {picks} FROM (SELECT CNPJ_CIA, DT_REFER, CD_CONTA, CAST(v AS DOUBLE) AS v FROM {source} WHERE CD_CONTA IN ({', '.join(repr(c) for c in accounts.values())})) GROUP BY ALL"


cte("simple_bp", "bp_rolled", _wide("bp_rolled", SIMPLE_BALANCE_ACCOUNTS))
cte("simple_dre", "dre_rolled", _wide("dre_rolled", SIMPLE_INCOME_ACCOUNTS))
cte("simple_dfc", "dfc_rolled", _wide("dfc_rolled", {"V23_CAIXA_DFC": "6.05.02"}))
cte(
    "simple_raw",
    "simple_bp simple_dre simple_dfc companies",
    """
SELECT j.*, c.DENOM_SOCIAL AS RAZAO_SOCIAL, c.SETOR_ATIV AS SETOR, c.TP_MERC
FROM (SELECT * FROM simple_bp FULL JOIN simple_dre USING (CNPJ_CIA, DT_REFER) LEFT JOIN simple_dfc USING (CNPJ_CIA, DT_REFER)) j
LEFT JOIN companies c ON c.CNPJ_CIA = j.CNPJ_CIA
""",
)
SIMPLE_RATIOS = [
    ("IND_LIQUIDEZ_GERAL", "V02_ATIVO_CIRC + V04_RLP", "AUX_PASSIVO_TOTAL"),
    ("IND_LIQUIDEZ_CORRENTE", "V02_ATIVO_CIRC", "V10_PASSIVO_CIRC"),
    ("IND_LIQUIDEZ_SECA", "V02_ATIVO_CIRC - V06_ESTOQUES", "V10_PASSIVO_CIRC"),
    ("IND_LIQUIDEZ_IMEDIATA", "V22_CAIXA_BP", "V10_PASSIVO_CIRC"),
    ("IND_PCT_CP", "AUX_PASSIVO_TOTAL", "V12_PL"),
    ("IND_PCT_AT", "AUX_PASSIVO_TOTAL", "V01_ATIVO_TOTAL"),
    ("IND_GARANTIA_CT", "V12_PL", "AUX_PASSIVO_TOTAL"),
    ("IND_COMPOSICAO_ENDIV", "V10_PASSIVO_CIRC", "AUX_PASSIVO_TOTAL"),
    ("IND_IMOB_CP", "V05_IMOBILIZADO", "V12_PL"),
    ("IND_IMOB_AT", "V05_IMOBILIZADO", "V01_ATIVO_TOTAL"),
    ("IND_MARGEM_BRUTA", "V19_LUCRO_BRUTO", "V17_RECEITA_LIQ"),
    ("IND_MARGEM_OPERACIONAL", "V20_EBIT", "V17_RECEITA_LIQ"),
    ("IND_MARGEM_LIQUIDA", "V21_LUCRO_LIQ", "V17_RECEITA_LIQ"),
    ("IND_ROA", "V21_LUCRO_LIQ", "V01_ATIVO_TOTAL"),
    ("IND_ROE", "V21_LUCRO_LIQ", "V12_PL"),
    ("IND_ROI", "V21_LUCRO_LIQ", "AUX_CAPITAL_INVEST"),
    ("IND_GIRO_ESTOQUES", "AUX_CPV_ABS", "V06_ESTOQUES_RAW"),
    ("IND_GIRO_CR", "V17_RECEITA_LIQ", "V07_CONTAS_RECEBER"),
    ("IND_GIRO_CP", "AUX_CPV_ABS", "V09_FORNECEDORES"),
    ("IND_GIRO_AC", "V17_RECEITA_LIQ", "V02_ATIVO_CIRC"),
    ("IND_PMRE", "V06_ESTOQUES_RAW * 360", "AUX_CPV_ABS"),
    ("IND_PMRV", "V07_CONTAS_RECEBER * 360", "V17_RECEITA_LIQ"),
    ("IND_PMPC", "V09_FORNECEDORES * 360", "AUX_CPV_ABS"),
    ("IND_PMRAC", "V02_ATIVO_CIRC * 360", "V17_RECEITA_LIQ"),
]
_simple = ", ".join(f"({n}) / nullif({d}, 0) AS {name}" for name, n, d in SIMPLE_RATIOS)
cte(
    "simple",
    "simple_raw",
    f"""
SELECT *, IND_PMRE + IND_PMRV AS IND_CICLO_ECONOMICO, IND_PMRE + IND_PMRV - IND_PMPC AS IND_CICLO_FINANCEIRO FROM (
 SELECT *, {_simple}, V26_LPA_DILUIDO AS IND_LPA_DILUIDO, V02_ATIVO_CIRC - V10_PASSIVO_CIRC AS IND_CGL,
        V06_ESTOQUES + V07_CONTAS_RECEBER - V09_FORNECEDORES AS IND_NCG, AUX_ACF - V13_EMP_CP AS IND_ST FROM (
  SELECT *, V10_PASSIVO_CIRC + V11_PASSIVO_NCIRC AS AUX_PASSIVO_TOTAL, V22_CAIXA_BP + V15B_APLIC_FIN AS AUX_ACF,
         V13_EMP_CP + V14_EMP_LP AS AUX_DIVIDA_BRUTA, V13_EMP_CP + V14_EMP_LP - V23_CAIXA_DFC AS AUX_DIVIDA_LIQUIDA,
         V12_PL + V13_EMP_CP + V14_EMP_LP AS AUX_CAPITAL_INVEST, abs(V18_CPV) AS AUX_CPV_ABS FROM (
   SELECT * REPLACE (coalesce(V13_EMP_CP, 0) AS V13_EMP_CP, coalesce(V14_EMP_LP, 0) AS V14_EMP_LP,
                     coalesce(V15B_APLIC_FIN, 0) AS V15B_APLIC_FIN),
          coalesce(V06_ESTOQUES_RAW, 0) AS V06_ESTOQUES, coalesce(V26_LPA_DILUIDO_RAW, V25_LPA_BASICO) AS V26_LPA_DILUIDO
   FROM simple_raw)))
""",
)
SIMPLE_MONEY = [
    *SIMPLE_BALANCE_ACCOUNTS, "V06_ESTOQUES", *SIMPLE_INCOME_ACCOUNTS, "V26_LPA_DILUIDO", "V23_CAIXA_DFC",
    "AUX_PASSIVO_TOTAL", "AUX_ACF", "AUX_DIVIDA_BRUTA", "AUX_DIVIDA_LIQUIDA", "AUX_CAPITAL_INVEST", "AUX_CPV_ABS",
    "IND_LPA_DILUIDO", "IND_CGL", "IND_NCG", "IND_ST",
]
SIMPLE_RATIO_NAMES = [n for n, _, _ in SIMPLE_RATIOS] + ["IND_CICLO_ECONOMICO", "IND_CICLO_FINANCEIRO"]
SIMPLE_INDICATORS = [
    *[n for n, _, _ in SIMPLE_RATIOS], "IND_LPA_DILUIDO", "IND_CICLO_ECONOMICO", "IND_CICLO_FINANCEIRO",
    "IND_CGL", "IND_NCG", "IND_ST",
]
cte(
    "prep",
    "simple",
    """
SELECT *, CASE WHEN IND_CGL > 0 AND IND_NCG < 0 AND IND_ST > 0 THEN 'I — Excelente'
               WHEN IND_CGL > 0 AND IND_NCG > 0 AND IND_ST > 0 THEN 'II — Solido'
               WHEN IND_CGL > 0 AND IND_NCG > 0 AND IND_ST < 0 THEN 'III — Insatisfatorio'
               WHEN IND_CGL < 0 AND IND_NCG > 0 AND IND_ST < 0 THEN 'IV — Alto Risco'
               WHEN IND_CGL < 0 AND IND_NCG < 0 AND IND_ST < 0 THEN 'V — Muito Ruim'
               WHEN IND_CGL < 0 AND IND_NCG < 0 AND IND_ST > 0 THEN 'VI — Arriscado' ELSE 'Indefinido' END AS FLEURIET
FROM (SELECT *, CAST(year(DT_REFER) AS INTEGER) AS ANO, coalesce(left(SETOR, 38), 'Não Classificado') AS SETOR_LABEL FROM simple)
""",
)
cte(
    "top10",
    "prep",
    "SELECT SETOR_LABEL, count(*) AS N_OBS FROM prep GROUP BY SETOR_LABEL ORDER BY N_OBS DESC, SETOR_LABEL LIMIT 10",
)
cte("prep_top", "prep top10", "SELECT * FROM prep WHERE SETOR_LABEL IN (SELECT SETOR_LABEL FROM top10)")
