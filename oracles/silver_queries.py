"""Oracle text of the queries over raw, consolidated and curated lines."""

from __future__ import annotations

import oracles.silver  # noqa: F401  (registers the expressions)
from oracles.fixed import VARIABLES
from oracles.base import NON_EXCLUDED, money, query, text

V = "CAST(CAST(VL_CONTA_TRATADO AS DECIMAL(28,2)) AS DOUBLE) AS VL_CONTA_TRATADO"
ORDER = "VERSAO DESC, DT_REFER DESC, LINE_ID DESC, LINE_SEQ DESC, VL_CONTA DESC"


def m(expression: str, name: str) -> str:
    return f"CAST(CAST({expression} AS DECIMAL(28,2)) AS DOUBLE) AS {name}"


_steps = [
    ("all", "TRUE"),
    ("SIT = ATIVO", "SIT = 'ATIVO'"),
    ("TP_MERC = BOLSA", "TP_MERC = 'BOLSA'"),
    ("SIT_EMISSOR = FASE OPERACIONAL", "SIT_EMISSOR = 'FASE OPERACIONAL'"),
] + [
    (f"sector not like {p}", f"coalesce(SETOR_ATIV, '') NOT LIKE '{p}'")
    for p in ("%Emp. Adm. Part%", "%Banc%", "%Segurad%", "%Financeira%", "%Securitiz%")
]
_funnel = " UNION ALL ".join(
    f"SELECT {i} AS PASSO, {text(label)} AS FILTRO, count(*) FILTER (WHERE {' AND '.join(c for _, c in _steps[: i + 1])}) AS N FROM registry"
    for i, (label, _) in enumerate(_steps)
)
_spec = ", ".join(
    f"('{v}', {text(meaning)}, '{st}', '{code}', {expected})"
    for v, meaning, st, codes, expected in VARIABLES
    for code in codes
)
_stacked = "SELECT * FROM n1_bp UNION ALL BY NAME SELECT * FROM n1_dre UNION ALL BY NAME SELECT * FROM n1_dfc"
_spec_table = f"spec AS (SELECT * FROM (VALUES {_spec}) s(VARIAVEL, CONCEITO, g, c, ESPERADO)), stacked AS ({_stacked})"
_used = f"used AS (SELECT * FROM spec JOIN stacked ON g = GRUPO_DFP_TRATADO AND c = CD_CONTA)"


def stacked_query(body: str) -> str:
    return query("n1_bp n1_dre n1_dfc", f", {_spec_table}, {_used} {body}").replace("\n, spec AS", ", spec AS")


def n1(code: str, body: str) -> str:
    return query(f"n1_{code}", body.replace("N1", f"n1_{code}"))


def share(column: str) -> str:
    return f"round({column} * 100.0 / sum({column}) OVER (), 2)"


ORACLES = {
    "scan_projection": query("typed", f"SELECT CNPJ_CIA, DENOM_CIA, DT_REFER, CD_CONTA, {V} FROM typed WHERE GRUPO_DFP_TRATADO = 'BP'"),
    "eligible_entities": query("eligible8", "SELECT * FROM eligible8 WHERE coalesce(SETOR_ATIV, '') NOT LIKE '%Adm.%Imóv%'"),
    "filter_funnel": query(
        "registry", f"SELECT PASSO, FILTRO, N, coalesce(lag(N) OVER (ORDER BY PASSO) - N, 0) AS EXCLUIDAS FROM ({_funnel})"
    ),
    "excluded_by_group": query(
        "registry",
        f"""SELECT SETOR_ATIV, count(*) AS QTD FROM registry
WHERE SIT = 'ATIVO' AND TP_MERC = 'BOLSA' AND SIT_EMISSOR = 'FASE OPERACIONAL' AND NOT ({NON_EXCLUDED}) GROUP BY ALL""",
    ),
    "ilike_filter": query(
        "lines",
        f"""SELECT CNPJ_CIA, DT_REFER, count(*) AS N, {m('sum(VL_CONTA)', 'TOTAL')} FROM lines
WHERE TABLE_NAME = 'dfp_cia_aberta_dmpl_con' AND COLUNA_DF = 'Patrimônio Líquido Consolidado' GROUP BY ALL""",
    ),
    "current_period_filter": query(
        "lines",
        f"""SELECT CNPJ_CIA, DT_REFER, TABLE_NAME, count(*) AS N, {m('sum(VL_CONTA)', 'TOTAL')} FROM lines
WHERE ORDEM_EXERC = 'ÚLTIMO' AND VERSAO = 10 GROUP BY ALL""",
    ),
    "scale_normalise": query(
        "typed",
        f"""SELECT CNPJ_CIA, CD_CONTA, count(*) AS N, {m('sum(VL_CONTA)', 'BRUTO')}, {m('sum(VL_CONTA_TRATADO)', 'TRATADO')}
FROM typed WHERE VL_CONTA_TRATADO <> 0 GROUP BY ALL""",
    ),
    "statement_class": query(
        "typed", "SELECT GRUPO_DFP, GRUPO_DFP_TRATADO, count(*) AS N, count(DISTINCT CNPJ_CIA) AS EMPRESAS FROM typed GROUP BY ALL"
    ),
    "level_filter": query(
        "typed",
        """SELECT CD_CONTA_QTD_DIGITOS AS DIGITOS, GRUPO_DFP_TRATADO, count(*) AS N,
count(*) FILTER (WHERE CD_CONTA_QTD_DIGITOS <= 5) AS ATE_NIVEL_3 FROM typed GROUP BY ALL""",
    ),
    "outlier_null": query(
        "typed",
        f"""SELECT CNPJ_CIA, CD_CONTA, count(*) AS N, count(*) FILTER (WHERE abs(VL_CONTA_TRATADO) <= 10000) AS MANTIDOS,
{m('max(VL_CONTA_TRATADO) FILTER (WHERE abs(VL_CONTA_TRATADO) <= 10000)', 'MAXIMO')}
FROM typed WHERE CD_CONTA IN ('3.99.01.01', '3.99.02.01') GROUP BY ALL""",
    ),
    "sector_label": query(
        "companies", "SELECT coalesce(left(SETOR_ATIV, 38), 'Não Classificado') AS SETOR_LABEL, count(*) AS N FROM companies GROUP BY ALL"
    ),
    "dedup_latest": query(
        "typed",
        f"""SELECT CNPJ_CIA, DT_FIM_EXERC_ANO, CD_CONTA, VERSAO, DT_REFER, {V} FROM (SELECT *,
row_number() OVER (PARTITION BY CNPJ_CIA, DT_FIM_EXERC_ANO, CD_CONTA ORDER BY {ORDER}) AS rn FROM typed) WHERE rn = 1""",
    ),
    "dedup_prefer_original": query(
        "typed",
        f"""SELECT CNPJ_CIA, DT_REFER, CD_CONTA, ORDEM_EXERC <> 'ÚLTIMO' AS SECUNDARIO, VERSAO, {V} FROM (SELECT *,
row_number() OVER (PARTITION BY CNPJ_CIA, DT_REFER, CD_CONTA ORDER BY (ORDEM_EXERC <> 'ÚLTIMO'), {ORDER}) AS rn FROM typed) WHERE rn = 1""",
    ),
    "latest_filing": query(
        "typed",
        f"""SELECT CNPJ_CIA, DT_REFER, VERSAO, count(*) AS N, {m('sum(VL_CONTA_TRATADO)', 'TOTAL')} FROM (SELECT *,
dense_rank() OVER (PARTITION BY CNPJ_CIA, DT_REFER ORDER BY VERSAO DESC) AS dr FROM typed) WHERE dr = 1 GROUP BY ALL""",
    ),
    "distinct_on": query(
        "typed",
        f"""SELECT CNPJ_CIA, CD_CONTA, upper(trim(DS_CONTA)) AS DS_CONTA, VERSAO, DT_REFER FROM (
SELECT DISTINCT ON (CNPJ_CIA, CD_CONTA) * FROM typed ORDER BY CNPJ_CIA, CD_CONTA, {ORDER})""",
    ),
    "distinct_entities": query(
        "lines", "SELECT DISTINCT CNPJ_CIA, DENOM_CIA, DENOM_CIA || ' (' || CNPJ_CIA || ')' AS LABEL FROM lines"
    ),
    "consolidate_sources": query(
        "silver",
        f"""SELECT _origem_tabela, GRUPO_DFP_TRATADO, count(*) AS N, count(DISTINCT CNPJ_CIA) AS EMPRESAS,
{m('sum(VL_CONTA_TRATADO)', 'TOTAL')} FROM silver GROUP BY ALL""",
    ),
    "is_leaf": query("n0", f"SELECT CNPJ_CIA, DT_REFER, VERSAO, CD_CONTA, LINE_ID, LINE_SEQ, {V}, IS_LEAF FROM n0"),
    "join_inner": query(
        "typed eligible8",
        f"""SELECT SETOR_ATIV, count(DISTINCT t.CNPJ_CIA) AS EMPRESAS, count(*) AS LINHAS, {m('sum(VL_CONTA_TRATADO)', 'TOTAL')}
FROM typed t JOIN eligible8 e ON e.CNPJ_CIA = t.CNPJ_CIA WHERE coalesce(SETOR_ATIV, '') NOT LIKE '%Adm.%Imóv%' GROUP BY ALL""",
    ),
    "collapse_duplicates": query(
        "bp_t5",
        f"SELECT CNPJ_CIA, DT_REFER, CD_CONTA, CAST(length(replace(CD_CONTA, '.', '')) AS INTEGER) AS CD_CONTA_QTD_DIGITOS, {m('v', 'VL_CONTA_TRATADO')}, DENOM_CIA FROM bp_t5",
    ),
    "filing_layout": query(
        "bp_rolled dre_rolled",
        f"""SELECT CNPJ_CIA, DT_REFER, CD_CONTA, {m('v', 'VL_CONTA_TRATADO')}, ACAO FROM bp_rolled
UNION ALL SELECT CNPJ_CIA, DT_REFER, CD_CONTA, {m('v', 'VL_CONTA_TRATADO')}, ACAO FROM dre_rolled""",
    ),
    "hierarchy_rollup_safe": query("bp_rolled", f"SELECT CNPJ_CIA, DT_REFER, CD_CONTA, {m('v', 'VL_CONTA_TRATADO')}, ACAO FROM bp_rolled"),
    "hierarchy_rollup_force": query("dre_rolled", f"SELECT CNPJ_CIA, DT_REFER, CD_CONTA, {m('v', 'VL_CONTA_TRATADO')}, ACAO FROM dre_rolled"),
    "rollup_audit": query(
        "bp_rolled dre_rolled dfc_rolled",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS DEMONSTRATIVO, count(*) AS LINHAS, count(*) FILTER (WHERE ACAO IN ('filled', 'forced', 'inserted')) AS RECONSTRUIDAS,
count(*) FILTER (WHERE ACAO = 'inserted') AS INSERIDAS, count(*) FILTER (WHERE ACAO = 'protected') AS PROTEGIDAS FROM {c.lower()}_rolled"""
            for c in ("BP", "DRE", "DFC")
        ),
    ),
    "golden_names": query("dfc_names", "SELECT CD_CONTA, nm AS DS_CONTA FROM dfc_names"),
    "golden_flag": query("bp_flags", "SELECT CD_CONTA, fl AS ST_CONTA_FIXA FROM bp_flags"),
    "modal_scale": query(
        "lines",
        """SELECT CNPJ_CIA, ESCALA FROM (SELECT CNPJ_CIA, ESCALA, row_number() OVER (PARTITION BY CNPJ_CIA ORDER BY n DESC, ESCALA) AS rn
FROM (SELECT CNPJ_CIA, upper(trim(ESCALA_MOEDA)) AS ESCALA, count(*) AS n FROM lines GROUP BY ALL)) WHERE rn = 1""",
    ),
    "trace_flags": n1("dre", "SELECT CNPJ_CIA, DT_REFER, CD_CONTA, DS_CONTA, DS_CONTA_REPORTADA, FLAG_RECONSTRUCAO, FLAG_NORMALIZACAO FROM N1"),
    "level_labels": n1("bp", "SELECT CNPJ_CIA, DT_REFER, CD_CONTA, DS_NIVEL_1, DS_NIVEL_2, DS_NIVEL_3, DS_NIVEL_4, DS_NIVEL_5 FROM N1"),
    "level_names_join": query(
        "silver",
        """, ref AS (SELECT DISTINCT ON (CNPJ_CIA, DT_REFER, GRUPO_DFP_TRATADO, CD_CONTA) CNPJ_CIA, DT_REFER, GRUPO_DFP_TRATADO, CD_CONTA AS pre,
  upper(trim(DS_CONTA)) AS nm FROM silver
  ORDER BY CNPJ_CIA, DT_REFER, GRUPO_DFP_TRATADO, CD_CONTA, VERSAO DESC, LINE_ID DESC, LINE_SEQ DESC, VL_CONTA DESC),
base AS (SELECT DISTINCT CNPJ_CIA, DT_REFER, GRUPO_DFP_TRATADO, CD_CONTA FROM silver)
SELECT b.*, """
        + ", ".join(f"n{i}.nm AS DS_NIVEL_{i}" for i in range(1, 6))
        + " FROM base b "
        + " ".join(
            f"LEFT JOIN ref n{i} ON n{i}.CNPJ_CIA = b.CNPJ_CIA AND n{i}.DT_REFER = b.DT_REFER AND n{i}.GRUPO_DFP_TRATADO = b.GRUPO_DFP_TRATADO"
            f" AND n{i}.pre = CASE WHEN len(string_split(b.CD_CONTA, '.')) >= {i} THEN array_to_string(string_split(b.CD_CONTA, '.')[1:{i}], '.') END"
            for i in range(1, 6)
        ),
    ).replace("\n, ref AS", ", ref AS"),
    "is_leaf_global": n1("bp", "SELECT CD_CONTA, IS_LEAF, count(*) AS N FROM N1 GROUP BY ALL"),
    "is_leaf_entity": n1(
        "bp",
        r"""SELECT CNPJ_CIA, CD_CONTA, NOT EXISTS (SELECT 1 FROM N1 k WHERE k.CNPJ_CIA = r.CNPJ_CIA
AND regexp_replace(k.CD_CONTA, '\.[^.]+$', '') = r.CD_CONTA) AS IS_LEAF, count(*) AS N FROM N1 r GROUP BY ALL""",
    ),
    "metadata_attach": query(
        "silver",
        """SELECT DISTINCT ON (CNPJ_CIA, DT_REFER) CNPJ_CIA, DT_REFER, VERSAO, DENOM_CIA, CD_CVM, DT_FIM_EXERC_TRATADO, DT_FIM_EXERC_ANO, SETOR_ATIV
FROM silver ORDER BY CNPJ_CIA, DT_REFER, VERSAO DESC, LINE_ID DESC, LINE_SEQ DESC, VL_CONTA_TRATADO DESC""",
    ),
    "gap_fill": query(
        "typed",
        """, dated AS (SELECT CNPJ_CIA, DT_REFER, max(CASE WHEN month(DT_REFER) = 12 THEN CD_CVM END) AS c, max(DENOM_CIA) AS DENOM_CIA
  FROM typed GROUP BY ALL)
SELECT CNPJ_CIA, DT_REFER, DENOM_CIA,
  coalesce(last_value(c IGNORE NULLS) OVER (PARTITION BY CNPJ_CIA ORDER BY DT_REFER ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           first_value(c IGNORE NULLS) OVER (PARTITION BY CNPJ_CIA ORDER BY DT_REFER ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS CD_CVM
FROM dated""",
    ).replace("\n, dated AS", ", dated AS"),
    **{f"curated_{c}": n1(c, f"SELECT * EXCLUDE (ACAO) REPLACE ({V}) FROM N1") for c in ("bp", "dre", "dfc")},
    "golden_schema": query(
        "n1_bp n1_dre n1_dfc",
        f"""SELECT GRUPO_DFP_TRATADO, STATUS_MATH, _origem_tabela, count(*) AS N, count(DS_NIVEL_2) AS COM_NIVEL_2,
count(DS_CONTA_REPORTADA) AS REPORTADAS, count(*) FILTER (WHERE IS_LEAF) AS FOLHAS FROM ({_stacked}) GROUP BY ALL""",
    ),
    "stack_statements": query(
        "n1_bp n1_dre n1_dfc", f"SELECT CNPJ_CIA, DT_REFER, GRUPO_DFP_TRATADO, CD_CONTA, {V}, FLAG_RECONSTRUCAO FROM ({_stacked})"
    ),
    "balance_status": n1("bp", "SELECT DISTINCT CNPJ_CIA, DT_REFER, STATUS_MATH FROM N1"),
    "cashflow_status": n1("dfc", "SELECT DISTINCT CNPJ_CIA, DT_REFER, STATUS_MATH FROM N1"),
    "volume_summary": n1(
        "bp",
        """SELECT count(*) AS TOTAL_LINHAS, count(DISTINCT CNPJ_CIA) AS TOTAL_EMPRESAS, count(DISTINCT DT_REFER) AS TOTAL_PERIODOS,
min(DT_REFER) AS PERIODO_MAIS_ANTIGO, max(DT_REFER) AS PERIODO_MAIS_RECENTE, count(DISTINCT CD_CONTA) AS TOTAL_CONTAS,
count(*) FILTER (WHERE VL_CONTA_TRATADO IS NULL) AS NULOS FROM N1""",
    ),
    "balance_equation": n1(
        "bp",
        f"""SELECT CNPJ_CIA, DENOM_CIA, DT_REFER, {money('TOTAL_ATIVO', 'TOTAL_PASSIVO')}, {m('TOTAL_ATIVO - TOTAL_PASSIVO', 'DIFERENCA')},
CASE WHEN abs(TOTAL_ATIVO - TOTAL_PASSIVO) <= 0.01 THEN 'OK' WHEN TOTAL_ATIVO = 0 AND TOTAL_PASSIVO = 0 THEN 'ZERADO' ELSE 'DESBALANCEADO' END AS STATUS_EQUACAO
FROM (SELECT CNPJ_CIA, DENOM_CIA, DT_REFER, coalesce(sum(VL_CONTA_TRATADO) FILTER (WHERE CD_CONTA = '1'), 0) AS TOTAL_ATIVO,
coalesce(sum(VL_CONTA_TRATADO) FILTER (WHERE CD_CONTA = '2'), 0) AS TOTAL_PASSIVO FROM N1 GROUP BY ALL)""",
    ),
    "status_distribution": n1(
        "bp",
        f"""SELECT STATUS_MATH, QTD_LINHAS, QTD_EMPRESA_DATA, {share('QTD_LINHAS')} AS PCT_TOTAL FROM (
SELECT STATUS_MATH, count(*) AS QTD_LINHAS, count(DISTINCT CNPJ_CIA || DT_REFER) AS QTD_EMPRESA_DATA FROM N1 GROUP BY ALL)""",
    ),
    "flag_distribution": n1(
        "dre",
        f"""SELECT FLAG_RECONSTRUCAO, FLAG_NORMALIZACAO, QTD_LINHAS, {share('QTD_LINHAS')} AS PCT_TOTAL FROM (
SELECT FLAG_RECONSTRUCAO, FLAG_NORMALIZACAO, count(*) AS QTD_LINHAS FROM N1 GROUP BY ALL)""",
    ),
    "leaf_distribution": n1(
        "dfc",
        f"""SELECT IS_LEAF, QTD_LINHAS, CONTAS_DISTINTAS, {share('QTD_LINHAS')} AS PCT_TOTAL FROM (
SELECT IS_LEAF, count(*) AS QTD_LINHAS, count(DISTINCT CD_CONTA) AS CONTAS_DISTINTAS FROM N1 GROUP BY ALL)""",
    ),
    "duplicate_keys": query(
        "lines",
        """SELECT CNPJ_CIA, DENOM_CIA, DT_REFER, CD_CONTA, DS_CONTA, count(*) AS OCORRENCIAS FROM lines GROUP BY ALL
HAVING count(*) > 1 ORDER BY OCORRENCIAS DESC, CNPJ_CIA, DENOM_CIA, DT_REFER, CD_CONTA, DS_CONTA LIMIT 20""",
    ),
    "parent_child_check": n1(
        "dre",
        f"""SELECT CNPJ_CIA, DT_REFER, DENOM_CIA, CD_CONTA, {money('VL_PAI', 'SOMA_FILHOS')}, {m('VL_PAI - SOMA_FILHOS', 'DIFERENCA')}, PAI_RECONSTRUIDO,
CASE WHEN abs(VL_PAI - SOMA_FILHOS) <= 1000 THEN 'OK' WHEN VL_PAI = 0 AND SOMA_FILHOS = 0 THEN 'ZERADO' ELSE 'DESBALANCEADO' END AS STATUS_PAR
FROM (SELECT p.CNPJ_CIA, p.DT_REFER, p.DENOM_CIA, p.CD_CONTA, p.VL_CONTA_TRATADO AS VL_PAI, sum(f.VL_CONTA_TRATADO) AS SOMA_FILHOS,
  p.FLAG_RECONSTRUCAO AS PAI_RECONSTRUIDO FROM N1 p JOIN N1 f ON f.CNPJ_CIA = p.CNPJ_CIA AND f.DT_REFER = p.DT_REFER
  AND starts_with(f.CD_CONTA, p.CD_CONTA || '.') AND f.CD_CONTA_QTD_DIGITOS = p.CD_CONTA_QTD_DIGITOS + 2 GROUP BY ALL)""",
    ),
    "parent_child_summary": n1(
        "bp",
        """SELECT CASE WHEN abs(v - s) <= 1000 THEN 'OK' WHEN v = 0 AND s = 0 THEN 'ZERADO' ELSE 'DESBALANCEADO' END AS STATUS_PAR,
PAI_RECONSTRUIDO, count(*) AS QTD FROM (SELECT p.CNPJ_CIA, p.DT_REFER, p.CD_CONTA, p.VL_CONTA_TRATADO AS v, sum(f.VL_CONTA_TRATADO) AS s,
  p.FLAG_RECONSTRUCAO AS PAI_RECONSTRUIDO FROM N1 p JOIN N1 f ON f.CNPJ_CIA = p.CNPJ_CIA AND f.DT_REFER = p.DT_REFER
  AND starts_with(f.CD_CONTA, p.CD_CONTA || '.') AND f.CD_CONTA_QTD_DIGITOS = p.CD_CONTA_QTD_DIGITOS + 2 GROUP BY ALL) GROUP BY ALL""",
    ),
    "coverage_crosscheck": query(
        "dfc_rolled dre_rolled",
        """, a AS (SELECT DISTINCT CNPJ_CIA, DT_REFER FROM dfc_rolled), b AS (SELECT DISTINCT CNPJ_CIA, DT_REFER FROM dre_rolled)
SELECT 'SO_DFC' AS SITUACAO, (SELECT count(*) FROM (FROM a EXCEPT FROM b)) AS QTD_PARES
UNION ALL SELECT 'SO_DRE', (SELECT count(*) FROM (FROM b EXCEPT FROM a))
UNION ALL SELECT 'AMBOS', (SELECT count(*) FROM (FROM a INTERSECT FROM b))""",
    ).replace("\n, a AS", ", a AS"),
    "cash_identity": n1(
        "dfc",
        f"""SELECT CNPJ_CIA, DENOM_CIA, DT_REFER, {money('SOMA_FLUXOS', 'VARIACAO_CAIXA')}, RECONSTRUIDO, {m('SOMA_FLUXOS - VARIACAO_CAIXA', 'DIFERENCA')},
round(abs(SOMA_FLUXOS - VARIACAO_CAIXA) / nullif(abs(VARIACAO_CAIXA), 0) * 100, 4) AS PCT_DIVERGENCIA,
CASE WHEN SOMA_FLUXOS = 0 AND VARIACAO_CAIXA = 0 THEN 'ZERADO' WHEN abs(SOMA_FLUXOS - VARIACAO_CAIXA) <= 1 THEN 'OK'
     WHEN NOT RECONSTRUIDO AND abs(SOMA_FLUXOS - VARIACAO_CAIXA) / nullif(abs(VARIACAO_CAIXA), 0) * 100 <= 1 THEN 'EFEITO_CAMBIAL' ELSE 'DIVERGE' END AS STATUS_IDENTIDADE
FROM (SELECT CNPJ_CIA, DENOM_CIA, DT_REFER, coalesce(sum(VL_CONTA_TRATADO) FILTER (WHERE CD_CONTA <> '6.05'), 0) AS SOMA_FLUXOS,
  coalesce(sum(VL_CONTA_TRATADO) FILTER (WHERE CD_CONTA = '6.05'), 0) AS VARIACAO_CAIXA, bool_or(FLAG_RECONSTRUCAO) AS RECONSTRUIDO
  FROM N1 WHERE CD_CONTA IN ('6.01', '6.02', '6.03', '6.04', '6.05') GROUP BY ALL)""",
    ),
    "cash_reconciliation": query(
        "n1_dfc n1_bp",
        f"""SELECT CNPJ_CIA, DENOM_CIA, DT_REFER, {m('s', 'DFC_6_05_02')}, r AS DFC_RECONSTRUIDO, {m('c1', 'BP_1_01_01')}, {m('c2', 'BP_1_01_02')},
{m('c1 + c2', 'BP_TETO')},
CASE WHEN c1 IS NULL THEN 'SEM_BP' WHEN abs(s - c1) <= 1000 THEN 'IDENTICO' WHEN s > c1 AND s <= c1 + c2 + 1000 THEN 'EQUIVALENTES'
     WHEN s < c1 - 1000 THEN 'CAIXA_RESTRITO' WHEN r THEN 'ERRO_RECONSTRUIDO' ELSE 'MANTIDO_PARA_VENDA' END AS DIAGNOSTICO,
CAST(CASE WHEN r AND s > c1 + c2 + 1000 THEN 0 WHEN s > c1 + c2 + 1000 THEN 1 ELSE 2 END AS INTEGER) AS PRIORIDADE
FROM (SELECT CNPJ_CIA, DENOM_CIA, DT_REFER, sum(VL_CONTA_TRATADO) AS s, bool_or(FLAG_RECONSTRUCAO) AS r FROM n1_dfc WHERE CD_CONTA = '6.05.02' GROUP BY ALL)
LEFT JOIN (SELECT CNPJ_CIA, DT_REFER, coalesce(sum(VL_CONTA_TRATADO) FILTER (WHERE CD_CONTA = '1.01.01'), 0) AS c1,
  coalesce(sum(VL_CONTA_TRATADO) FILTER (WHERE CD_CONTA = '1.01.02'), 0) AS c2 FROM n1_bp WHERE CD_CONTA IN ('1.01.01', '1.01.02') GROUP BY ALL)
USING (CNPJ_CIA, DT_REFER)""",
    ),
    "waterfall_check": query(
        "dre_rolled",
        f"""SELECT CNPJ_CIA, DT_REFER, {', '.join(m(f'c{i}', f'C3_0{i}') for i in range(1, 6))},
abs(c3 - (c1 + c2)) <= 1 OR abs(c3 - (c1 - abs(c2))) <= 1 AS BRUTO_OK, abs(c5 - (c3 + c4)) <= 1 AS EBIT_OK
FROM (SELECT CNPJ_CIA, DT_REFER, {', '.join(f"CAST(coalesce(sum(v) FILTER (WHERE CD_CONTA = '3.0{i}'), 0) AS DOUBLE) AS c{i}" for i in range(1, 6))} FROM dre_rolled GROUP BY ALL)""",
    ),
    "publish_gate": query(
        "dre_rolled",
        f"""SELECT *, CHAVES_DUPLICADAS + FALHAS_BRUTO + FALHAS_EBIT = 0 AS APROVADO FROM (
SELECT (SELECT count(*) FROM (SELECT 1 FROM dre_rolled GROUP BY CNPJ_CIA, DT_REFER, CD_CONTA HAVING count(*) > 1)) AS CHAVES_DUPLICADAS,
 count(*) FILTER (WHERE NOT (abs(c3 - (c1 + c2)) <= 1 OR abs(c3 - (c1 - abs(c2))) <= 1)) AS FALHAS_BRUTO,
 count(*) FILTER (WHERE abs(c5 - (c3 + c4)) > 1) AS FALHAS_EBIT
FROM (SELECT CNPJ_CIA, DT_REFER, {', '.join(f"coalesce(sum(v) FILTER (WHERE CD_CONTA = '3.0{i}'), 0) AS c{i}" for i in range(1, 6))} FROM dre_rolled GROUP BY ALL))""",
    ),
    "gap_candidates": n1(
        "bp",
        f"""SELECT CNPJ_CIA, DT_REFER, CD_CONTA, {V}, {m('g', 'DIFERENCA')} FROM N1 JOIN (
SELECT CNPJ_CIA, DT_REFER, coalesce(sum(VL_CONTA_TRATADO) FILTER (WHERE CD_CONTA = '1'), 0) - coalesce(sum(VL_CONTA_TRATADO) FILTER (WHERE CD_CONTA = '2'), 0) AS g
FROM N1 WHERE CD_CONTA IN ('1', '2') GROUP BY ALL) USING (CNPJ_CIA, DT_REFER)
WHERE abs(g) > 1 AND abs(VL_CONTA_TRATADO) BETWEEN abs(g) * (1 - 0.01::DOUBLE) AND abs(g) * (1 + 0.01::DOUBLE)""",
    ),
    "group_totals": query(
        "bp_rolled",
        f"""SELECT CNPJ_CIA, DT_REFER, RAIZ, {money('VL_RAIZ', 'SOMA_GRUPOS')}, {m('VL_RAIZ - SOMA_GRUPOS', 'DIFERENCA')} FROM (
SELECT CNPJ_CIA, DT_REFER, left(CD_CONTA, 1) AS RAIZ, coalesce(sum(v) FILTER (WHERE length(CD_CONTA) = 1), 0) AS VL_RAIZ,
coalesce(sum(v) FILTER (WHERE length(CD_CONTA) = 4), 0) AS SOMA_GRUPOS FROM bp_rolled GROUP BY ALL)""",
    ),
    "top_divergences": n1(
        "bp",
        f"""SELECT CNPJ_CIA, DENOM_CIA, DT_REFER, {m('a', 'TOTAL_ATIVO')}, {m('p', 'TOTAL_PASSIVO')}, {m('a - p', 'DIFERENCA')}, 'DESBALANCEADO' AS STATUS_EQUACAO
FROM (SELECT CNPJ_CIA, DENOM_CIA, DT_REFER, coalesce(sum(VL_CONTA_TRATADO) FILTER (WHERE CD_CONTA = '1'), 0) AS a,
coalesce(sum(VL_CONTA_TRATADO) FILTER (WHERE CD_CONTA = '2'), 0) AS p FROM N1 GROUP BY ALL) WHERE abs(a - p) > 1
ORDER BY abs(a - p) DESC, CNPJ_CIA, DT_REFER LIMIT 5""",
    ),
    "top_reconstructed": n1(
        "bp",
        """SELECT DT_REFER, DENOM_CIA, count(*) FILTER (WHERE FLAG_RECONSTRUCAO) AS TOTAL_RECONSTRUIDAS FROM N1 GROUP BY ALL
ORDER BY TOTAL_RECONSTRUIDAS DESC, DT_REFER, DENOM_CIA LIMIT 10""",
    ),
    "audit_checklist": n1(
        "bp",
        """SELECT TESTE, round(MEDIDO, 4) AS MEDIDO, CAST(LIMITE AS DOUBLE) AS LIMITE, CASE s WHEN '>' THEN MEDIDO > LIMITE WHEN '<' THEN MEDIDO < LIMITE ELSE MEDIDO <= LIMITE END AS APROVADO
FROM (SELECT 'nulos' AS TESTE, CAST(count(*) FILTER (WHERE VL_CONTA_TRATADO IS NULL) AS DOUBLE) AS MEDIDO, 0 AS LIMITE, '<=' AS s FROM N1
UNION ALL SELECT 'identidade', count(*) FILTER (WHERE STATUS_MATH = 'DESBALANCEADO'), 0, '<=' FROM N1
UNION ALL SELECT 'status_pct', 100.0 * count(*) FILTER (WHERE STATUS_MATH = 'DESBALANCEADO') / count(*), 5, '<=' FROM N1
UNION ALL SELECT 'reconstruidas_pct', 100.0 * count(*) FILTER (WHERE FLAG_RECONSTRUCAO) / count(*), 100, '<' FROM N1
UNION ALL SELECT 'folhas', count(*) FILTER (WHERE IS_LEAF), 0, '>' FROM N1
UNION ALL SELECT 'sinteticas', count(*) FILTER (WHERE NOT IS_LEAF), 0, '>' FROM N1
UNION ALL SELECT 'duplicadas', count(*), 0, '<=' FROM (SELECT 1 FROM N1 GROUP BY CNPJ_CIA, DT_REFER, CD_CONTA, DS_CONTA HAVING count(*) > 1))""",
    ),
    "variable_catalogue": stacked_query(
        """SELECT VARIAVEL, CD_CONTA, DS_CONTA, ST_CONTA_FIXA, IS_LEAF, count(*) AS N_LINHAS, count(DISTINCT CNPJ_CIA) AS N_EMPRESAS,
count(DISTINCT DT_REFER) AS N_PERIODOS FROM used GROUP BY ALL"""
    ),
    "variable_coverage": stacked_query(
        """SELECT VARIAVEL, EMPRESAS_COM_CONTA, TOTAL_EMPRESAS, PCT_EMPRESAS, PCT_EP,
CASE WHEN PCT_EMPRESAS >= ESPERADO THEN 'OK' WHEN PCT_EMPRESAS >= 70 THEN 'PARCIAL' ELSE 'BAIXA' END AS STATUS FROM (
SELECT s.VARIAVEL, ESPERADO, coalesce(e, 0) AS EMPRESAS_COM_CONTA, te AS TOTAL_EMPRESAS, round(coalesce(e, 0) * 100.0 / te, 1) AS PCT_EMPRESAS,
round(coalesce(f, 0) * 100.0 / tf, 1) AS PCT_EP FROM (SELECT DISTINCT VARIAVEL, g, ESPERADO FROM spec) s
LEFT JOIN (SELECT VARIAVEL, count(DISTINCT CNPJ_CIA) AS e, count(DISTINCT CNPJ_CIA || DT_REFER) AS f FROM used GROUP BY ALL) p ON p.VARIAVEL = s.VARIAVEL
LEFT JOIN (SELECT GRUPO_DFP_TRATADO, count(DISTINCT CNPJ_CIA) AS te, count(DISTINCT CNPJ_CIA || DT_REFER) AS tf FROM stacked GROUP BY ALL) u ON u.GRUPO_DFP_TRATADO = s.g)"""
    ),
    "variable_range": stacked_query(
        f"""SELECT VARIAVEL, count(*) AS N_TOTAL, count(*) FILTER (WHERE VL_CONTA_TRATADO = 0) AS N_ZEROS, {m('min(VL_CONTA_TRATADO)', 'MINIMO')},
{m('max(VL_CONTA_TRATADO)', 'MAXIMO')}, round(quantile_cont(VL_CONTA_TRATADO, 0.5), 4) AS MEDIANA FROM used WHERE IS_LEAF GROUP BY ALL"""
    ),
    "variable_dictionary": stacked_query(
        """SELECT s.VARIAVEL, CONCEITO, g AS GRUPO_DFP_TRATADO, CONTAS, coalesce(n, 0) AS N_LINHAS FROM (
SELECT VARIAVEL, CONCEITO, g, string_agg(c, ', ' ORDER BY c) AS CONTAS FROM spec GROUP BY ALL) s
LEFT JOIN (SELECT VARIAVEL, count(*) AS n FROM used GROUP BY ALL) u ON u.VARIAVEL = s.VARIAVEL"""
    ),
    "fallback_origin": query(
        "dre_rolled",
        """, ok AS (SELECT * FROM dre_rolled WHERE ACAO <> 'inserted' AND abs(v) <= 10000), u AS (SELECT DISTINCT CNPJ_CIA, DT_REFER FROM dre_rolled WHERE CD_CONTA = '3.01')
SELECT ORIGEM, QTD_LINHAS, round(QTD_LINHAS * 100.0 / sum(QTD_LINHAS) OVER (), 2) AS PCT_TOTAL FROM (
SELECT CASE WHEN d.v IS NOT NULL THEN 'diluido_direto' WHEN b.v IS NOT NULL THEN 'fallback_basico' ELSE 'sem_lpa' END AS ORIGEM, count(*) AS QTD_LINHAS
FROM u LEFT JOIN ok b ON b.CNPJ_CIA = u.CNPJ_CIA AND b.DT_REFER = u.DT_REFER AND b.CD_CONTA = '3.99.01.01'
LEFT JOIN ok d ON d.CNPJ_CIA = u.CNPJ_CIA AND d.DT_REFER = u.DT_REFER AND d.CD_CONTA = '3.99.02.01' GROUP BY ALL)""",
    ).replace("\n, ok AS", ", ok AS"),
    "missing_periods": query(
        "silver",
        """, have AS (SELECT DISTINCT CNPJ_CIA, GRUPO_DFP_TRATADO AS d, DT_FIM_EXERC_ANO AS y FROM silver WHERE GRUPO_DFP_TRATADO IN ('BP', 'DRE', 'DFC')),
span AS (SELECT CNPJ_CIA, unnest(range(min(y), max(y) + 1)) AS y FROM have GROUP BY CNPJ_CIA)
SELECT s.CNPJ_CIA, CAST(s.y AS INTEGER) AS ANO, k.d AS DEMONSTRATIVO FROM span s, (VALUES ('BP'), ('DRE'), ('DFC')) k(d)
WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.CNPJ_CIA = s.CNPJ_CIA AND h.y = s.y AND h.d = k.d)""",
    ).replace("\n, have AS", ", have AS"),
    "entities_by_dimension": query(
        "companies",
        """SELECT DIMENSAO, VALOR, N, round(N * 100.0 / sum(N) OVER (PARTITION BY DIMENSAO), 2) AS PCT FROM ("""
        + " UNION ALL ".join(
            f"SELECT '{d}' AS DIMENSAO, {d} AS VALOR, count(*) AS N FROM companies GROUP BY ALL"
            for d in ("SETOR_ATIV", "UF", "CONTROLE_ACIONARIO", "CATEG_REG")
        )
        + ")",
    ),
}

ORACLES["coverage_bitmaps"] = ORACLES["variable_coverage"]
