"""Oracle text of the consolidated and the curated tables: joins level by level, where the Spark code uses windows."""

from __future__ import annotations

from oracles.fixed import CASH_FLOW_ROOT_LABEL, FIXED_NAMES, REBUILT_PREFIX
from oracles.base import cte, text

LEVEL = "len(string_split({}, '.'))"
PARENT = r"regexp_replace({}, '\.[^.]+$', '')"

RULES = {"BP": ("safe", 2), "DRE": ("force", 3), "DFC": ("safe", 3)}

cte(
    "n0_parents",
    "silver",
    """
SELECT DISTINCT CNPJ_CIA, DT_REFER, VERSAO, array_to_string(parts[1:i], '.') AS CD_CONTA
FROM (SELECT CNPJ_CIA, DT_REFER, VERSAO, string_split(CD_CONTA, '.') AS parts,
             unnest(range(1, len(string_split(CD_CONTA, '.')))) AS i FROM silver)
""",
)
cte(
    "n0",
    "silver n0_parents",
    """
SELECT s.*, p.CD_CONTA IS NULL AS IS_LEAF
FROM silver s LEFT JOIN n0_parents p USING (CNPJ_CIA, DT_REFER, VERSAO, CD_CONTA)
""",
)

for code, (rule, lowest) in RULES.items():
    low = code.lower()
    keys = "CNPJ_CIA, DT_REFER, CD_CONTA" + ("" if code == "DRE" else ", DS_CONTA, VL_CONTA_TRATADO")
    cte(
        f"{low}_extract",
        "silver",
        f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys}
      ORDER BY VERSAO DESC, LINE_ID DESC, LINE_SEQ DESC, VL_CONTA_TRATADO DESC) AS rn
  FROM silver WHERE GRUPO_DFP_TRATADO = '{code}') WHERE rn = 1
""",
    )
    cte(
        f"{low}_t5",
        f"{low}_extract",
        f"""
SELECT CNPJ_CIA, DT_REFER, CD_CONTA, CAST(sum(VL_CONTA_TRATADO) AS DECIMAL(38,6)) AS v, min(DENOM_CIA) AS DENOM_CIA, 'kept' AS ACAO
FROM {low}_extract GROUP BY ALL
""",
    )
    if rule == "safe":
        replace = "abs(t.v) < 0.01 AND abs(s.calc) > 0.01"
        protect = "abs(t.v) > 0.01 AND NOT abs(CAST(s.calc - t.v AS DOUBLE)) <= 1 + 1e-5 * abs(CAST(t.v AS DOUBLE))"
        action = "filled"
    else:
        replace = "s.calc <> 0 AND NOT abs(CAST(s.calc - t.v AS DOUBLE)) <= 1 + 1e-5 * abs(CAST(t.v AS DOUBLE))"
        protect = "FALSE"
        action = "forced"
    for child in range(5, lowest - 1, -1):
        before, after = f"{low}_t{child}", f"{low}_t{child - 1}"
        cte(
            f"{low}_s{child}",
            before,
            f"""
SELECT CNPJ_CIA, DT_REFER, {PARENT.format('CD_CONTA')} AS CD_CONTA, CAST(sum(v) AS DECIMAL(38,6)) AS calc, min(DENOM_CIA) AS nm
FROM {before} WHERE {LEVEL.format('CD_CONTA')} = {child} GROUP BY ALL
""",
        )
        cte(
            after,
            f"{before} {low}_s{child}",
            f"""
SELECT CNPJ_CIA, DT_REFER, CD_CONTA,
       CASE WHEN t.v IS NULL OR (s.calc IS NOT NULL AND t.ACAO <> 'inserted' AND {replace}) THEN s.calc ELSE t.v END AS v,
       coalesce(t.DENOM_CIA, s.nm) AS DENOM_CIA,
       CASE WHEN t.v IS NULL THEN 'inserted'
            WHEN s.calc IS NOT NULL AND t.ACAO <> 'inserted' AND {replace} THEN '{action}'
            WHEN s.calc IS NOT NULL AND t.ACAO <> 'inserted' AND {protect} THEN 'protected' ELSE t.ACAO END AS ACAO
FROM {before} t FULL JOIN {low}_s{child} s USING (CNPJ_CIA, DT_REFER, CD_CONTA)
""",
        )
    cte(f"{low}_rolled", f"{low}_t{lowest - 1}", f"SELECT * FROM {low}_t{lowest - 1}")
    fixed = FIXED_NAMES.get(code, {})
    values = ", ".join(f"({text(k)}, {text(v)})" for k, v in fixed.items())
    cte(
        f"{low}_names",
        f"{low}_extract",
        f"""
SELECT coalesce(f.c, m.CD_CONTA) AS CD_CONTA, coalesce(f.n, m.nm) AS nm FROM (
  SELECT CD_CONTA, nm FROM (SELECT CD_CONTA, upper(trim(DS_CONTA)) AS nm,
      row_number() OVER (PARTITION BY CD_CONTA ORDER BY count(*) DESC, upper(trim(DS_CONTA))) AS rn
    FROM {low}_extract GROUP BY CD_CONTA, upper(trim(DS_CONTA))) WHERE rn = 1) m
FULL JOIN (VALUES {values}) f(c, n) ON f.c = m.CD_CONTA
""",
    )
    cte(
        f"{low}_flags",
        f"{low}_extract",
        f"""
SELECT CD_CONTA, ST_CONTA_FIXA AS fl FROM (SELECT CD_CONTA, ST_CONTA_FIXA,
    row_number() OVER (PARTITION BY CD_CONTA ORDER BY count(*) DESC, ST_CONTA_FIXA) AS rn
  FROM {low}_extract GROUP BY CD_CONTA, ST_CONTA_FIXA) WHERE rn = 1
""",
    )
    cte(
        f"{low}_reported",
        f"{low}_extract",
        f"""
SELECT DISTINCT ON (CNPJ_CIA, DT_REFER, CD_CONTA) CNPJ_CIA, DT_REFER, CD_CONTA, DS_CONTA, ST_CONTA_FIXA FROM {low}_extract
ORDER BY CNPJ_CIA, DT_REFER, CD_CONTA, VERSAO DESC, LINE_ID DESC, LINE_SEQ DESC, VL_CONTA_TRATADO DESC
""",
    )
    cte(
        f"{low}_meta",
        f"{low}_extract",
        f"""
SELECT CNPJ_CIA, DT_REFER, max(VERSAO) AS VERSAO, max(DT_FIM_EXERC_TRATADO) AS fim, max(DT_FIM_EXERC_ANO) AS ano,
       max(CD_CVM) AS cvm, max(SETOR_ATIV) AS setor FROM {low}_extract GROUP BY ALL
""",
    )
    if code == "BP":
        status = """
SELECT CNPJ_CIA, DT_REFER,
       CASE WHEN count(*) FILTER (WHERE CD_CONTA IN ('1', '2')) = 0 THEN 'ERRO_ESTRUTURA'
            WHEN coalesce(sum(v) FILTER (WHERE CD_CONTA = '1'), 0) = 0 AND coalesce(sum(v) FILTER (WHERE CD_CONTA = '2'), 0) = 0 THEN 'ZERADO'
            WHEN abs(coalesce(sum(v) FILTER (WHERE CD_CONTA = '1'), 0) - coalesce(sum(v) FILTER (WHERE CD_CONTA = '2'), 0)) <= 1 THEN 'OK'
            ELSE 'DESBALANCEADO' END AS st FROM bp_rolled GROUP BY ALL"""
    elif code == "DFC":
        status = """
SELECT CNPJ_CIA, DT_REFER,
       CASE WHEN count(*) FILTER (WHERE CD_CONTA IN ('6.01', '6.02', '6.03', '6.04', '6.05')) = 0 THEN 'OK'
            WHEN coalesce(sum(v) FILTER (WHERE CD_CONTA = '6.05'), 0) = 0 THEN 'SEM_TOTALIZADOR'
            WHEN abs(coalesce(sum(v) FILTER (WHERE CD_CONTA IN ('6.01', '6.02', '6.03', '6.04')), 0)
                     - sum(v) FILTER (WHERE CD_CONTA = '6.05')) <= 1 THEN 'OK'
            ELSE 'DIVERGENTE' END AS st FROM dfc_rolled GROUP BY ALL"""
    else:
        status = "SELECT DISTINCT CNPJ_CIA, DT_REFER, 'NAO_APLICAVEL' AS st FROM dre_rolled"
    cte(f"{low}_status", f"{low}_rolled", status)
    labels = []
    for i in range(1, 6):
        if code == "DFC" and i == 1:
            labels.append(f"{text(CASH_FLOW_ROOT_LABEL)} AS DS_NIVEL_1")
        else:
            labels.append(
                f"(SELECT nm FROM {low}_names g WHERE g.CD_CONTA = CASE WHEN {LEVEL.format('r.CD_CONTA')} >= {i}"
                f" THEN array_to_string(string_split(r.CD_CONTA, '.')[1:{i}], '.') END) AS DS_NIVEL_{i}"
            )
    name = f"coalesce(g.nm, p.DS_CONTA, {text(REBUILT_PREFIX)} || r.CD_CONTA)"
    cte(
        f"n1_{low}",
        f"{low}_rolled {low}_names {low}_flags {low}_reported {low}_meta {low}_status",
        f"""
SELECT r.CNPJ_CIA, m.setor AS SETOR_ATIV, r.DT_REFER, r.DT_REFER AS DT_REFER_TRATADO,
       CAST(year(r.DT_REFER) AS INTEGER) AS DT_REFER_ANO, coalesce(m.VERSAO, 1) AS VERSAO, r.DENOM_CIA, m.cvm AS CD_CVM,
       '{code}' AS GRUPO_DFP_TRATADO, m.fim AS DT_FIM_EXERC_TRATADO, m.ano AS DT_FIM_EXERC_ANO, r.CD_CONTA,
       CAST(length(replace(r.CD_CONTA, '.', '')) AS INTEGER) AS CD_CONTA_QTD_DIGITOS, {name} AS DS_CONTA,
       p.DS_CONTA AS DS_CONTA_REPORTADA,
       p.DS_CONTA IS NOT NULL AND upper(trim({name})) <> upper(trim(coalesce(p.DS_CONTA, ''))) AS FLAG_NORMALIZACAO,
       p.DS_CONTA IS NULL AS FLAG_RECONSTRUCAO, st AS STATUS_MATH, r.CD_CONTA || ' - ' || {name} AS CONTA_NOME_COMPLETO,
       CAST(r.v AS DOUBLE) AS VL_CONTA_TRATADO, coalesce(f.fl, 'S') AS ST_CONTA_FIXA, p.ST_CONTA_FIXA AS ST_CONTA_FIXA_REPORTADA,
       NOT EXISTS (SELECT 1 FROM {low}_rolled k WHERE {PARENT.format('k.CD_CONTA')} = r.CD_CONTA) AS IS_LEAF,
       {', '.join(labels)}, 'layer_02_silver.n0_dfp_cia_aberta ({code})' AS _origem_tabela, r.ACAO
FROM {low}_rolled r LEFT JOIN {low}_names g ON g.CD_CONTA = r.CD_CONTA LEFT JOIN {low}_flags f ON f.CD_CONTA = r.CD_CONTA
LEFT JOIN {low}_reported p ON p.CNPJ_CIA = r.CNPJ_CIA AND p.DT_REFER = r.DT_REFER AND p.CD_CONTA = r.CD_CONTA
LEFT JOIN {low}_meta m ON m.CNPJ_CIA = r.CNPJ_CIA AND m.DT_REFER = r.DT_REFER
LEFT JOIN {low}_status s ON s.CNPJ_CIA = r.CNPJ_CIA AND s.DT_REFER = r.DT_REFER
""",
    )
