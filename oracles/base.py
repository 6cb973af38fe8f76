"""Common table expressions the oracle queries start from, and a helper that chains the ones a query needs."""

from __future__ import annotations

import re

from finledger.plans.ledger import CHART, GRID, GROUP_TABLE, GROUP_TEXT, NATION_SECTOR

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, needs: str, body: str) -> None:
    CTES[name] = (needs.split(), body.strip())


def query(needs: str, body: str) -> str:
    """``WITH`` the named expressions (and what they need, in order) in front of ``body``."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dependency in CTES[name][0]:
            visit(dependency)
        order.append(name)

    for name in needs.split():
        visit(name)
    if not order:
        return body.strip()
    head = ",\n".join(f"{name} AS (\n{CTES[name][1]}\n)" for name in order)
    # AT (total assets) is a keyword in DuckDB.
    return re.sub(r"(?<![\w\"'])AT(?![\w\"'])", '"AT"', f"WITH {head}\n{body.strip()}")


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


_chart = ",\n".join(
    f"({i}, {text(code)}, {text(name)}, '{sign}', '{size}', {text(GROUP_TEXT[code[0]])}, {text(GROUP_TABLE[code[0]])})"
    for i, (code, name, sign, size) in enumerate(CHART)
)
cte(
    "chart",
    "",
    f"SELECT * FROM (VALUES {_chart}) AS t(acct, cd_conta, chart_name, sign, size, group_text, table_name)",
)
cte(
    "lines",
    "chart",
    f"""
SELECT lpad(CAST(l_suppkey AS VARCHAR), 14, '0') AS CNPJ_CIA,
       'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS DENOM_CIA,
       CAST(l_suppkey + 1000 AS INTEGER) AS CD_CVM,
       CASE WHEN l_returnflag = 'R' AND month(l_shipdate) <= 6 THEN make_date(year(l_shipdate), 6, 30)
            ELSE make_date(year(l_shipdate), 12, 31) END AS DT_REFER,
       CASE WHEN l_returnflag = 'R' AND month(l_shipdate) <= 6 THEN make_date(year(l_shipdate), 6, 30)
            ELSE make_date(year(l_shipdate), 12, 31) END AS DT_FIM_EXERC,
       CASE l_orderkey % 5 WHEN 4 THEN 8 WHEN 3 THEN 9 ELSE 10 END AS VERSAO,
       CASE WHEN l_partkey % 3 = 0 THEN ' ' || upper(group_text) || ' ' ELSE group_text END AS GRUPO_DFP,
       'REAL' AS MOEDA,
       CASE WHEN (l_suppkey + year(l_shipdate)) % 3 = 0 THEN 'UNIDADE'
            WHEN l_linenumber % 2 = 1 THEN ' mil ' ELSE 'MIL' END AS ESCALA_MOEDA,
       CASE WHEN l_quantity > 45 THEN 'PENÚLTIMO' ELSE 'ÚLTIMO' END AS ORDEM_EXERC,
       cd_conta AS CD_CONTA,
       CASE l_partkey % 5 WHEN 0 THEN upper(chart_name) WHEN 1 THEN chart_name || ' '
            WHEN 2 THEN 'Outros ' || chart_name ELSE chart_name END AS DS_CONTA,
       CAST((CASE WHEN sign = 'C' OR (sign = 'S' AND l_partkey % (CASE cd_conta WHEN '2.03' THEN 16 ELSE 4 END) = 0)
                  THEN -1 ELSE 1 END)
            * (CASE size WHEN 'E' THEN l_quantity * (l_discount - 0.05) * (CASE WHEN l_partkey % 97 = 0 THEN 10000000 ELSE 1 END)
                         WHEN 'G' THEN floor(l_extendedprice / {GRID}) * {GRID}
                         ELSE l_extendedprice END) AS DECIMAL(28,6)) AS VL_CONTA,
       CASE WHEN (length(cd_conta) <= 7) = (l_partkey % 11 <> 0) THEN 'S' ELSE 'N' END AS ST_CONTA_FIXA,
       CASE WHEN cd_conta LIKE '5%' THEN
            CASE WHEN l_partkey % 2 = 0 THEN 'Patrimônio Líquido Consolidado' ELSE 'Capital Social' END END AS COLUNA_DF,
       table_name AS TABLE_NAME,
       l_orderkey * 8 + l_linenumber AS LINE_ID,
       l_partkey AS LINE_SEQ
FROM lineitem JOIN chart ON acct = (l_partkey * 7 + l_linenumber * 3 + l_orderkey) % {len(CHART)}
""",
)
_sector = " ".join(f"WHEN {key} THEN {text(label)}" for key, label in NATION_SECTOR.items())
cte(
    "registrants",
    "",
    """
SELECT s_suppkey AS k, s_name AS nm, s_nationkey AS nk, s_acctbal AS bal, 2 AS seq FROM supplier
UNION ALL SELECT c_custkey + 90000000000000, c_name, c_nationkey, c_acctbal, 2 FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 1 FROM supplier WHERE s_suppkey % 7 = 0
""",
)
cte(
    "registry",
    "registrants",
    f"""
SELECT lpad(CAST(k AS VARCHAR), 14, '0') AS CNPJ_CIA, nm AS DENOM_SOCIAL,
       CASE WHEN bal < 0 THEN 'CANCELADO(A)' ELSE 'ATIVO' END AS SIT,
       CASE WHEN k % 10 = 7 THEN 'BALCÃO' ELSE 'BOLSA' END AS TP_MERC,
       CASE WHEN k % 13 = 5 THEN 'EM RECUPERAÇÃO JUDICIAL' ELSE 'FASE OPERACIONAL' END AS SIT_EMISSOR,
       CASE n_nationkey {_sector} ELSE 'Setor ' || n_name END AS SETOR_ATIV,
       'UF' || n_regionkey AS UF,
       CASE k % 4 WHEN 0 THEN 'ESTATAL' WHEN 1 THEN 'ESTRANGEIRO' ELSE 'PRIVADO' END AS CONTROLE_ACIONARIO,
       CASE WHEN k % 3 = 0 THEN 'Categoria B' ELSE 'Categoria A' END AS CATEG_REG,
       seq AS REG_SEQ
FROM registrants JOIN nation ON n_nationkey = nk
""",
)

# --- normalised lines and silver --------------------------------------------------------------

cte(
    "typed",
    "lines",
    """
SELECT *, DT_REFER AS DT_REFER_TRATADO, CAST(year(DT_REFER) AS INTEGER) AS DT_REFER_ANO,
       DT_FIM_EXERC AS DT_FIM_EXERC_TRATADO, CAST(year(DT_FIM_EXERC) AS INTEGER) AS DT_FIM_EXERC_ANO,
       CASE WHEN contains(upper(GRUPO_DFP), 'BALANÇO PATRIMONIAL') THEN 'BP'
            WHEN contains(upper(GRUPO_DFP), 'MUTAÇÕES DO PATRIMÔNIO LÍQUIDO') THEN 'DMPL'
            WHEN contains(upper(GRUPO_DFP), 'RESULTADO ABRANGENTE') THEN 'DRA'
            WHEN contains(upper(GRUPO_DFP), 'VALOR ADICIONADO') THEN 'DVA'
            WHEN contains(upper(GRUPO_DFP), 'FLUXO DE CAIXA') THEN 'DFC'
            WHEN contains(upper(GRUPO_DFP), 'DEMONSTRAÇÃO DO RESULTADO') THEN 'DRE'
            ELSE 'VALIDAR' END AS GRUPO_DFP_TRATADO,
       CAST(length(replace(CD_CONTA, '.', '')) AS INTEGER) AS CD_CONTA_QTD_DIGITOS,
       CAST(CASE WHEN starts_with(CD_CONTA, '3.99') THEN VL_CONTA
                 WHEN contains(upper(ESCALA_MOEDA), 'MIL') THEN CAST(trunc(VL_CONTA) * 1000 AS DECIMAL(28,6))
                 ELSE VL_CONTA END AS DECIMAL(28,6)) AS VL_CONTA_TRATADO
FROM lines
""",
)
cte(
    "companies",
    "registry",
    "SELECT DISTINCT ON (CNPJ_CIA) * FROM registry ORDER BY CNPJ_CIA, REG_SEQ DESC",
)
NON_EXCLUDED = " AND ".join(
    f"NOT contains(coalesce(SETOR_ATIV, ''), {text(part)})"
    for part in ("Emp. Adm. Part", "Banc", "Segurad", "Financeira", "Securitiz")
)
cte(
    "eligible8",
    "companies",
    f"""
SELECT * FROM companies WHERE SIT = 'ATIVO' AND TP_MERC = 'BOLSA' AND SIT_EMISSOR = 'FASE OPERACIONAL' AND {NON_EXCLUDED}
""",
)
cte(
    "silver",
    "typed eligible8",
    """
SELECT * FROM (
  SELECT t.*, e.SETOR_ATIV, 'layer_01_bronze.' || TABLE_NAME AS _origem_tabela,
         max(VERSAO) OVER (PARTITION BY TABLE_NAME, t.CNPJ_CIA, DT_REFER) AS newest
  FROM typed t JOIN eligible8 e ON e.CNPJ_CIA = t.CNPJ_CIA
  WHERE ORDEM_EXERC = 'ÚLTIMO'
    AND (TABLE_NAME NOT LIKE '%dmpl%' OR COLUNA_DF ILIKE 'Patrim%nio%L%quido%Consolidado')
) WHERE VERSAO = newest AND VL_CONTA_TRATADO <> 0
""",
)


def money(*columns: str) -> str:
    return ", ".join(f"CAST(CAST({c} AS DECIMAL(28,2)) AS DOUBLE) AS {c}" for c in columns)


def rounded(*columns: str, places: int = 6) -> str:
    return ", ".join(f"round({c}, {places}) + 0.0 AS {c}" for c in columns)
