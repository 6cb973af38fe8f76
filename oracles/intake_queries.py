"""Oracle text of the intake queries: what must come back after writing, reading, staging and logging."""

from __future__ import annotations

from oracles.base import query

TOTAL = "CAST(CAST(sum(VL_CONTA) AS DECIMAL(28,2)) AS DOUBLE) AS TOTAL"
FILE = "TABLE_NAME || '_' || year(DT_REFER) || '.csv'"
_log = """
SELECT *, 1990 + user_id % 20 AS y, CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'SUCCESS' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END AS lv
FROM events"""
_files = """
SELECT k.n AS DATASET, CAST(y AS INTEGER) AS ANO, k.p || '_' || y || '.zip' AS ARQUIVO
FROM (SELECT DISTINCT year(DT_REFER) AS y FROM lines), (VALUES ('FRE', 'fre_cia_aberta'), ('DFP', 'dfp_cia_aberta'), ('ITR', 'itr_cia_aberta')) k(n, p)
UNION ALL SELECT 'CAD', NULL, 'cad_cia_aberta.csv'"""
_known = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_new = [
    "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus", "l_shipdate",
]

_lake = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]

ORACLES = {
    "lake_rows": " UNION ALL ".join(f"SELECT '{t}' AS TABELA, count(*) AS LINHAS FROM {t}" for t in _lake),
    "lake_total": "WITH t AS (" + " UNION ALL ".join(f"SELECT '{t}' AS TABELA, count(*) AS LINHAS FROM {t}" for t in _lake)
    + ") SELECT * FROM t UNION ALL SELECT 'TOTAL', CAST(sum(LINHAS) AS BIGINT) FROM t",
    "scan_delimited": query("lines", f"SELECT CNPJ_CIA, ORDEM_EXERC, count(*) AS LINHAS, {TOTAL} FROM lines GROUP BY ALL"),
    "scan_archive": query(
        "lines", f"SELECT {FILE} AS metadata_membro, CNPJ_CIA, count(*) AS LINHAS, {TOTAL} FROM lines GROUP BY ALL"
    ),
    "archive_events": query("lines", f"SELECT {FILE} AS membro, 'INFO' AS nivel, count(*) AS LINHAS FROM lines GROUP BY ALL"),
    "header_drift": query(
        "lines",
        f"""SELECT DISTINCT {FILE} AS membro, 'NOVA_COLUNA' AS COLUNA, 'NOVA' AS SITUACAO FROM lines WHERE TABLE_NAME LIKE '%\\_dre\\_%' ESCAPE '\\'""",
    ),
    "intake_loop": query(
        "lines",
        f"""SELECT 'INFO' AS nivel_log, 'dfp:' || {FILE} AS tabela_destino, TABLE_NAME = 'dfp_cia_aberta_dre_con' AS schema_drift_detectado,
count(*) AS LINHAS FROM lines WHERE TABLE_NAME <> 'dfp_cia_aberta_dra_con' GROUP BY ALL
UNION ALL SELECT 'TABELA', 'dfp:' || {FILE}, CAST(NULL AS BOOLEAN), count(*) FROM lines WHERE TABLE_NAME <> 'dfp_cia_aberta_dra_con' GROUP BY ALL
UNION ALL SELECT DISTINCT 'ERROR', 'dfp:' || {FILE}, FALSE, 0 FROM lines WHERE TABLE_NAME = 'dfp_cia_aberta_dra_con'
UNION ALL SELECT 'WARNING', 'dfp', FALSE, 0 UNION ALL SELECT 'SUCCESS', 'dfp', TRUE, 0""",
    ),
    "source_catalog": query("lines", _files),
    "derive_table_name": query("lines", f"SELECT {FILE} AS ARQUIVO, TABLE_NAME AS TABELA, count(*) AS LINHAS FROM lines GROUP BY ALL"),
    "stage_text": query(
        "lines",
        f"""SELECT {FILE} AS metadata_arquivo_origem, count(*) AS LINHAS, count(*) AS COM_DATA, CAST(0 AS BIGINT) AS TEXTO_NAN,
count(DISTINCT CD_CONTA) AS CONTAS FROM lines GROUP BY ALL""",
    ),
    "schema_drift": " UNION ALL ".join(
        [f"SELECT '{c}' AS COLUNA, 'NOVA' AS SITUACAO, count({c}) AS PREENCHIDAS FROM lineitem" for c in _new]
        + [f"SELECT '{c}', 'AUSENTE', 0" for c in _known if c != "o_orderkey"]
    ),
    "load_log_counts": f"""SELECT 'tabela_' || event_type AS tabela_destino, lv AS nivel_log, count(*) AS EVENTOS,
CAST(sum(CASE WHEN lv = 'SUCCESS' THEN 0 ELSE event_id % 1000 END) AS BIGINT) AS LINHAS FROM ({_log}) GROUP BY ALL""",
    "pending_files": query(
        "lines",
        f"""SELECT * FROM ({_files}) WHERE ARQUIVO NOT IN (SELECT 'dfp_cia_aberta_' || y || '.zip' FROM ({_log}) WHERE lv = 'SUCCESS')""",
    ),
    "load_events": query(
        "lines",
        f"""SELECT 'INFO' AS nivel_log, CAST(year(DT_REFER) AS INTEGER) AS ano_referencia, {FILE} AS arquivo_origem, 'dfp' AS tabela_destino,
'Carga OK: ' || count(*) || ' linhas.' AS mensagem FROM lines GROUP BY ALL""",
    ),
    "stream_intake": """SELECT 'lineitem.parquet' AS metadata_arquivo_origem, CAST(l_linenumber AS VARCHAR) AS l_linenumber, count(*) AS LINHAS,
count(DISTINCT l_suppkey) AS EMPRESAS FROM lineitem GROUP BY ALL""",
}
