"""Reference data of the ledger domain: table layouts, chart of accounts and indicator specifications.

Everything here is small and fixed. Code that works on data lives in ``operators`` and ``plans``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Staged money keeps six decimals (per-share accounts need them) and 22 integer digits.
MONEY = "decimal(28,6)"

# ---------------------------------------------------------------------------------------------
# The curated ("golden") layout shared by the three statements, in this order.
# ---------------------------------------------------------------------------------------------
GOLDEN_COLUMNS: list[tuple[str, str]] = [
    ("CNPJ_CIA", "string"),
    ("SETOR_ATIV", "string"),
    ("DT_REFER", "date"),
    ("DT_REFER_TRATADO", "date"),
    ("DT_REFER_ANO", "int"),
    ("VERSAO", "int"),
    ("DENOM_CIA", "string"),
    ("CD_CVM", "int"),
    ("GRUPO_DFP_TRATADO", "string"),
    ("DT_FIM_EXERC_TRATADO", "date"),
    ("DT_FIM_EXERC_ANO", "int"),
    ("CD_CONTA", "string"),
    ("CD_CONTA_QTD_DIGITOS", "int"),
    ("DS_CONTA", "string"),
    ("DS_CONTA_REPORTADA", "string"),
    ("FLAG_NORMALIZACAO", "boolean"),
    ("FLAG_RECONSTRUCAO", "boolean"),
    ("STATUS_MATH", "string"),
    ("CONTA_NOME_COMPLETO", "string"),
    ("VL_CONTA_TRATADO", "double"),
    ("ST_CONTA_FIXA", "string"),
    ("ST_CONTA_FIXA_REPORTADA", "string"),
    ("IS_LEAF", "boolean"),
    ("DS_NIVEL_1", "string"),
    ("DS_NIVEL_2", "string"),
    ("DS_NIVEL_3", "string"),
    ("DS_NIVEL_4", "string"),
    ("DS_NIVEL_5", "string"),
    ("_origem_tabela", "string"),
]

# Columns of a raw filing extract, all staged as text.
RAW_COLUMNS: list[str] = [
    "CNPJ_CIA",
    "DT_REFER",
    "VERSAO",
    "DENOM_CIA",
    "CD_CVM",
    "GRUPO_DFP",
    "MOEDA",
    "ESCALA_MOEDA",
    "ORDEM_EXERC",
    "DT_FIM_EXERC",
    "CD_CONTA",
    "DS_CONTA",
    "VL_CONTA",
    "ST_CONTA_FIXA",
]

# Load log layout.
LOAD_LOG = T.StructType(
    [
        T.StructField("log_id", T.LongType()),
        T.StructField("data_execucao", T.TimestampType()),
        T.StructField("nivel_log", T.StringType()),
        T.StructField("ano_referencia", T.IntegerType()),
        T.StructField("arquivo_origem", T.StringType()),
        T.StructField("tabela_destino", T.StringType()),
        T.StructField("mensagem", T.StringType()),
        T.StructField("schema_drift_detectado", T.BooleanType()),
    ]
)

# Filing kinds (name, file prefix, zipped?, one file per year?).
DATASETS: list[tuple[str, str, bool, bool]] = [
    ("FRE", "fre_cia_aberta", True, True),
    ("DFP", "dfp_cia_aberta", True, True),
    ("ITR", "itr_cia_aberta", True, True),
    ("CAD", "cad_cia_aberta", False, False),
]

# The seven statement extracts that make up the consolidated table.
STATEMENT_TABLES: list[str] = [
    "dfp_cia_aberta_bpa_con",
    "dfp_cia_aberta_bpp_con",
    "dfp_cia_aberta_dre_con",
    "dfp_cia_aberta_dra_con",
    "dfp_cia_aberta_dmpl_con",
    "dfp_cia_aberta_dfc_mi_con",
    "dfp_cia_aberta_dva_con",
]

# Eligibility of an entity. Equalities, then sector patterns that exclude it.
ELIGIBLE_STATUS: list[tuple[str, str]] = [
    ("SIT", "ATIVO"),
    ("TP_MERC", "BOLSA"),
    ("SIT_EMISSOR", "FASE OPERACIONAL"),
]
EXCLUDED_SECTORS: list[str] = [
    "%Emp. Adm. Part%",
    "%Banc%",
    "%Segurad%",
    "%Financeira%",
    "%Securitiz%",
]
EXCLUDED_REAL_ESTATE = "%Adm.%Imóv%"

# Statement class by group text, first match wins (DRA has to come before DRE).
STATEMENT_CLASSES: list[tuple[str, str]] = [
    ("%BALANÇO PATRIMONIAL%", "BP"),
    ("%MUTAÇÕES DO PATRIMÔNIO LÍQUIDO%", "DMPL"),
    ("%RESULTADO ABRANGENTE%", "DRA"),
    ("%VALOR ADICIONADO%", "DVA"),
    ("%FLUXO DE CAIXA%", "DFC"),
    ("%DEMONSTRAÇÃO DO RESULTADO%", "DRE"),
]
UNKNOWN_CLASS = "VALIDAR"
CONSOLIDATED_EQUITY = "Patrim%nio%L%quido%Consolidado"

# Canonical names that override the most frequent reported name.
FIXED_NAMES: dict[str, dict[str, str]] = {
    "BP": {"1": "ATIVO TOTAL", "2": "PASSIVO TOTAL"},
    "DRE": {"3": "DEMONSTRAÇÃO DO RESULTADO"},
    "DFC": {
        "6.01": "CAIXA LÍQUIDO ATIVIDADES OPERACIONAIS",
        "6.02": "CAIXA LÍQUIDO ATIVIDADES DE INVESTIMENTO",
        "6.03": "CAIXA LÍQUIDO ATIVIDADES DE FINANCIAMENTO",
        "6.04": "VARIAÇÃO CAMBIAL SOBRE CAIXA E EQUIVALENTES",
        "6.05": "AUMENTO (REDUÇÃO) DE CAIXA E EQUIVALENTES",
    },
}
CASH_FLOW_ROOT_LABEL = "DEMONSTRAÇÃO DO FLUXO DE CAIXA"
REBUILT_PREFIX = "CONTA RECONSTRUÍDA - "

# Mart balances by account code.
MART_ACCOUNTS: dict[str, str] = {
    "AT": "1",
    "AC": "1.01",
    "CAIXA_EQUIV": "1.01.01",
    "APLIC_FIN": "1.01.02",
    "CLIENTES": "1.01.03",
    "ESTOQUES": "1.01.04",
    "AT_BIOLOGICO": "1.01.05",
    "RLP": "1.02.01",
    "IMOBILIZADO": "1.02.03",
    "PC": "2.01",
    "FORNECEDORES": "2.01.02",
    "EMP_FIN_CP": "2.01.04",
    "PNC": "2.02",
    "EMP_FIN_LP": "2.02.01",
    "PL": "2.03",
    "REC_LIQ": "3.01",
    "CPV": "3.02",
    "LUCRO_BRUTO": "3.03",
    "EBIT": "3.05",
    "LUCRO_LIQ": "3.11",
    "LPA_DILUIDO_ON": "3.99.02.01",
    "LPA_BASICO_ON": "3.99.01.01",
    "LPA_3_99": "3.99",
    "CAIXA_OPERACIONAL": "6.01",
    "CAIXA_GERADO_OPERACOES": "6.01.01",
    "CAIXA_INVESTIMENTOS": "6.02",
    "AQUISICAO_IMOBILIZADO_1": "6.02.01",
    "AQUISICAO_INTANGIVEL": "6.02.02",
    "AQUISICAO_IMOBILIZADO_2": "6.02.03",
    "SALDO_FINAL_CAIXA_DFC": "6.05.02",
}
DEPRECIATION_ACCOUNTS = ["6.01.01.02", "6.01.01.03", "6.01.01.04"]

# Inputs of the simple mart, by statement.
SIMPLE_BALANCE_ACCOUNTS: dict[str, str] = {
    "V01_ATIVO_TOTAL": "1",
    "V02_ATIVO_CIRC": "1.01",
    "V03_ATIVO_NCIRC": "1.02",
    "V04_RLP": "1.02.01",
    "V05_IMOBILIZADO": "1.02.03",
    "V06_ESTOQUES_RAW": "1.01.04",
    "V07_CONTAS_RECEBER": "1.01.03",
    "V09_FORNECEDORES": "2.01.02",
    "V10_PASSIVO_CIRC": "2.01",
    "V11_PASSIVO_NCIRC": "2.02",
    "V12_PL": "2.03",
    "V13_EMP_CP": "2.01.04",
    "V14_EMP_LP": "2.02.01",
    "V22_CAIXA_BP": "1.01.01",
    "V15B_APLIC_FIN": "1.01.02",
}
SIMPLE_INCOME_ACCOUNTS: dict[str, str] = {
    "V17_RECEITA_LIQ": "3.01",
    "V18_CPV": "3.02",
    "V19_LUCRO_BRUTO": "3.03",
    "V20_EBIT": "3.05",
    "V21_LUCRO_LIQ": "3.11",
    "V25_LPA_BASICO": "3.99.01.01",
    "V26_LPA_DILUIDO_RAW": "3.99.02.01",
}
PER_SHARE_ACCOUNTS = ["3.99.01.01", "3.99.02.01"]
PER_SHARE_LIMIT = 10000

# The thirty benchmarked indicators.
BENCHMARK_INDICATORS: list[str] = [
    "LIQ_GERAL",
    "LIQ_CORRENTE",
    "LIQ_SECA_AJUSTADA",
    "LIQ_IMEDIATA",
    "ENDIV_CP",
    "ENDIV_TOTAL",
    "GARANTIA_CP_CT",
    "COMPOSICAO_ENDIV",
    "IMOB_PL",
    "IMOB_AT",
    "MARGEM_BRUTA",
    "MARGEM_OPERACIONAL",
    "MARGEM_LIQUIDA",
    "LPA",
    "ROA",
    "ROE",
    "ROI",
    "GIRO_ESTOQUES_AJUSTADO",
    "GIRO_CLIENTES",
    "GIRO_FORNECEDORES",
    "GIRO_AC",
    "PMRE_AJUSTADO",
    "PMRV",
    "PMPC",
    "PMRAC",
    "CICLO_ECONOMICO",
    "CICLO_FINANCEIRO",
    "NCG",
    "ST",
    "CGL",
]

# Risk notes as (note, indicator, value that scores 0, value that scores 10).
LINEAR_NOTES: list[tuple[str, str, float, float]] = [
    ("NOTA_LIQ_CORRENTE", "LIQ_CORRENTE", 0.8, 2.0),
    ("NOTA_LIQ_SECA", "LIQ_SECA_AJUSTADA", 0.6, 1.5),
    ("NOTA_COB_CAIXA_OPERACIONAL", "COB_CAIXA_OPERACIONAL", 0.05, 0.40),
    ("NOTA_MARGEM_EBITDA", "MARGEM_EBITDA", 0.05, 0.35),
    ("NOTA_MARGEM_LIQUIDA", "MARGEM_LIQUIDA", 0.0, 0.20),
    ("NOTA_ROA", "ROA", 0.0, 0.15),
    ("NOTA_DL_EBITDA", "DL_EBITDA", 5.0, 0.5),
    ("NOTA_GRAU_ENDIVIDAMENTO", "GRAU_ENDIVIDAMENTO", 0.90, 0.30),
    ("NOTA_CCC", "CCC", 180.0, 0.0),
    ("NOTA_GIRO_ATIVO_TOTAL", "GIRO_ATIVO_TOTAL", 0.20, 1.20),
    ("NOTA_MARGEM_CAIXA_OPERACIONAL", "MARGEM_CAIXA_OPERACIONAL", 0.03, 0.25),
    ("NOTA_COBERTURA_DIVIDA_CAIXA", "COBERTURA_DIVIDA_CAIXA", 0.05, 0.40),
]
# The one note with a target instead of a direction (note, indicator, target).
TARGET_NOTES: list[tuple[str, str, float]] = [
    ("NOTA_INTENSIDADE_REINVESTIMENTO", "INTENSIDADE_REINVESTIMENTO", 0.30),
]
# Score dimensions as (score, weight, notes).
SCORE_DIMENSIONS: list[tuple[str, float, list[str]]] = [
    ("SCORE_LIQUIDEZ", 0.25, ["NOTA_LIQ_CORRENTE", "NOTA_LIQ_SECA", "NOTA_COB_CAIXA_OPERACIONAL"]),
    ("SCORE_RENTABILIDADE", 0.25, ["NOTA_MARGEM_EBITDA", "NOTA_MARGEM_LIQUIDA", "NOTA_ROA"]),
    ("SCORE_SOLVENCIA", 0.20, ["NOTA_DL_EBITDA", "NOTA_GRAU_ENDIVIDAMENTO"]),
    ("SCORE_EFICIENCIA", 0.15, ["NOTA_CCC", "NOTA_GIRO_ATIVO_TOTAL"]),
    (
        "SCORE_GERACAO_CAIXA",
        0.15,
        ["NOTA_MARGEM_CAIXA_OPERACIONAL", "NOTA_COBERTURA_DIVIDA_CAIXA", "NOTA_INTENSIDADE_REINVESTIMENTO"],
    ),
]
# Score bands, highest floor first.
SCORE_BANDS: list[tuple[float, str]] = [(7.0, "Saudavel"), (5.0, "Moderado"), (3.0, "Alerta")]
LOWEST_BAND = "Critico"

# Working-capital profiles by the signs of CGL, NCG and ST.
WORKING_CAPITAL_PROFILES: list[tuple[int, int, int, str]] = [
    (1, -1, 1, "I — Excelente"),
    (1, 1, 1, "II — Solido"),
    (1, 1, -1, "III — Insatisfatorio"),
    (-1, 1, -1, "IV — Alto Risco"),
    (-1, -1, -1, "V — Muito Ruim"),
    (-1, -1, 1, "VI — Arriscado"),
]
UNDEFINED_PROFILE = "Indefinido"

# Indicators shown first, as (group, code, better when).
PRIORITY_INDICATORS: list[tuple[str, str, str]] = [
    ("Liquidez", "LIQ_SECA_AJUSTADA", "higher"),
    ("Liquidez", "LIQ_CORRENTE", "higher"),
    ("Liquidez", "LIQ_IMEDIATA", "higher"),
    ("Endividamento", "ENDIV_TOTAL", "lower"),
    ("Endividamento", "COMPOSICAO_ENDIV", "lower"),
    ("Endividamento", "GARANTIA_CP_CT", "higher"),
    ("Margens", "MARGEM_BRUTA", "higher"),
    ("Margens", "MARGEM_OPERACIONAL", "higher"),
    ("Margens", "MARGEM_LIQUIDA", "higher"),
    ("Rentabilidade", "ROA", "higher"),
    ("Rentabilidade", "ROE", "higher"),
    ("Rentabilidade", "ROI", "higher"),
    ("Atividade", "GIRO_ESTOQUES_AJUSTADO", "higher"),
    ("Atividade", "PMRE_AJUSTADO", "lower"),
    ("Atividade", "PMRV", "lower"),
    ("Atividade", "PMPC", "higher"),
    ("Ciclos", "CICLO_ECONOMICO", "lower"),
    ("Ciclos", "CICLO_FINANCEIRO", "lower"),
    ("Recursos Financeiros", "NCG", "lower"),
    ("Recursos Financeiros", "ST", "higher"),
    ("Recursos Financeiros", "CGL", "higher"),
]

# Input variables as (variable, meaning, statement, accounts, expected coverage %).
VARIABLES: list[tuple[str, str, str, list[str], float]] = [
    ("V01", "Ativo Total", "BP", ["1"], 100.0),
    ("V02", "Ativo Circulante", "BP", ["1.01"], 100.0),
    ("V03", "Ativo Não Circulante", "BP", ["1.02"], 100.0),
    ("V04", "Realizável a Longo Prazo", "BP", ["1.02.01"], 100.0),
    ("V05", "Imobilizado", "BP", ["1.02.03"], 100.0),
    ("V06", "Estoques", "BP", ["1.01.04"], 85.0),
    ("V07", "Contas a Receber CP", "BP", ["1.01.03"], 100.0),
    ("V09", "Fornecedores", "BP", ["2.01.02"], 100.0),
    ("V10", "Passivo Circulante", "BP", ["2.01"], 100.0),
    ("V11", "Passivo Não Circulante", "BP", ["2.02"], 100.0),
    ("V12", "Patrimônio Líquido", "BP", ["2.03"], 100.0),
    ("V13", "Empréstimos CP", "BP", ["2.01.04"], 95.0),
    ("V14", "Empréstimos LP", "BP", ["2.02.01"], 95.0),
    ("V15", "Ativo Circulante Financeiro", "BP", ["1.01.01", "1.01.02"], 85.0),
    ("V16", "Passivo Circulante Financeiro", "BP", ["2.01.04"], 95.0),
    ("V17", "Receita Líquida", "DRE", ["3.01"], 100.0),
    ("V18", "Custo dos Bens Vendidos", "DRE", ["3.02"], 100.0),
    ("V19", "Lucro Bruto", "DRE", ["3.03"], 100.0),
    ("V20", "Resultado Operacional", "DRE", ["3.05"], 100.0),
    ("V21", "Lucro Líquido", "DRE", ["3.11"], 100.0),
    ("V22", "Caixa e Equivalentes", "BP", ["1.01.01"], 100.0),
    ("V23", "Saldo Final de Caixa", "DFC", ["6.05.02"], 100.0),
    ("V25", "LPA Básico ON", "DRE", ["3.99.01.01"], 80.0),
    ("V26", "LPA Diluído ON", "DRE", ["3.99.02.01"], 80.0),
]
