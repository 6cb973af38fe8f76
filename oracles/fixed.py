"""Fixed values of the definitions, typed for the oracles from the definitions themselves, not taken from the package."""

from __future__ import annotations


def _pairs(text: str) -> dict[str, str]:
    """``NAME code`` pairs, one a line."""
    return dict(line.split() for line in text.strip().splitlines())


# Names that override the most frequent one, by statement.
FIXED_NAMES = {
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

# Mart balances by account.
MART_ACCOUNTS = _pairs("""
AT 1
AC 1.01
CAIXA_EQUIV 1.01.01
APLIC_FIN 1.01.02
CLIENTES 1.01.03
ESTOQUES 1.01.04
AT_BIOLOGICO 1.01.05
RLP 1.02.01
IMOBILIZADO 1.02.03
PC 2.01
FORNECEDORES 2.01.02
EMP_FIN_CP 2.01.04
PNC 2.02
EMP_FIN_LP 2.02.01
PL 2.03
REC_LIQ 3.01
CPV 3.02
LUCRO_BRUTO 3.03
EBIT 3.05
LUCRO_LIQ 3.11
LPA_DILUIDO_ON 3.99.02.01
LPA_BASICO_ON 3.99.01.01
LPA_3_99 3.99
CAIXA_OPERACIONAL 6.01
CAIXA_GERADO_OPERACOES 6.01.01
CAIXA_INVESTIMENTOS 6.02
AQUISICAO_IMOBILIZADO_1 6.02.01
AQUISICAO_INTANGIVEL 6.02.02
AQUISICAO_IMOBILIZADO_2 6.02.03
SALDO_FINAL_CAIXA_DFC 6.05.02
""")
# Inputs of the simple mart.
SIMPLE_BALANCE_ACCOUNTS = _pairs("""
V01_ATIVO_TOTAL 1
V02_ATIVO_CIRC 1.01
V03_ATIVO_NCIRC 1.02
V04_RLP 1.02.01
V05_IMOBILIZADO 1.02.03
V06_ESTOQUES_RAW 1.01.04
V07_CONTAS_RECEBER 1.01.03
V09_FORNECEDORES 2.01.02
V10_PASSIVO_CIRC 2.01
V11_PASSIVO_NCIRC 2.02
V12_PL 2.03
V13_EMP_CP 2.01.04
V14_EMP_LP 2.02.01
V22_CAIXA_BP 1.01.01
V15B_APLIC_FIN 1.01.02
""")
SIMPLE_INCOME_ACCOUNTS = _pairs("""
V17_RECEITA_LIQ 3.01
V18_CPV 3.02
V19_LUCRO_BRUTO 3.03
V20_EBIT 3.05
V21_LUCRO_LIQ 3.11
V25_LPA_BASICO 3.99.01.01
V26_LPA_DILUIDO_RAW 3.99.02.01
""")
# The thirty benchmarked indicators.
BENCHMARK_INDICATORS = """
LIQ_GERAL LIQ_CORRENTE LIQ_SECA_AJUSTADA LIQ_IMEDIATA ENDIV_CP ENDIV_TOTAL GARANTIA_CP_CT COMPOSICAO_ENDIV IMOB_PL IMOB_AT
MARGEM_BRUTA MARGEM_OPERACIONAL MARGEM_LIQUIDA LPA ROA ROE ROI GIRO_ESTOQUES_AJUSTADO GIRO_CLIENTES GIRO_FORNECEDORES GIRO_AC
PMRE_AJUSTADO PMRV PMPC PMRAC CICLO_ECONOMICO CICLO_FINANCEIRO NCG ST CGL
""".split()
# Notes as (note, indicator, scores 0 at, scores 10 at); one note has a target.
LINEAR_NOTES = [
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
TARGET_NOTES = [("NOTA_INTENSIDADE_REINVESTIMENTO", "INTENSIDADE_REINVESTIMENTO", 0.30)]
# Dimensions as (score, weight, notes), and bands from the highest.
SCORE_DIMENSIONS = [
    ("SCORE_LIQUIDEZ", 0.25, ["NOTA_LIQ_CORRENTE", "NOTA_LIQ_SECA", "NOTA_COB_CAIXA_OPERACIONAL"]),
    ("SCORE_RENTABILIDADE", 0.25, ["NOTA_MARGEM_EBITDA", "NOTA_MARGEM_LIQUIDA", "NOTA_ROA"]),
    ("SCORE_SOLVENCIA", 0.20, ["NOTA_DL_EBITDA", "NOTA_GRAU_ENDIVIDAMENTO"]),
    ("SCORE_EFICIENCIA", 0.15, ["NOTA_CCC", "NOTA_GIRO_ATIVO_TOTAL"]),
    ("SCORE_GERACAO_CAIXA", 0.15, ["NOTA_MARGEM_CAIXA_OPERACIONAL", "NOTA_COBERTURA_DIVIDA_CAIXA", "NOTA_INTENSIDADE_REINVESTIMENTO"]),
]
SCORE_BANDS = [(7.0, "Saudavel"), (5.0, "Moderado"), (3.0, "Alerta")]
# Indicators shown first, by group; "-" marks those where lower is better.
_PRIORITY = [
    ("Liquidez", "LIQ_SECA_AJUSTADA LIQ_CORRENTE LIQ_IMEDIATA"),
    ("Endividamento", "-ENDIV_TOTAL -COMPOSICAO_ENDIV GARANTIA_CP_CT"),
    ("Margens", "MARGEM_BRUTA MARGEM_OPERACIONAL MARGEM_LIQUIDA"),
    ("Rentabilidade", "ROA ROE ROI"),
    ("Atividade", "GIRO_ESTOQUES_AJUSTADO -PMRE_AJUSTADO -PMRV PMPC"),
    ("Ciclos", "-CICLO_ECONOMICO -CICLO_FINANCEIRO"),
    ("Recursos Financeiros", "-NCG ST CGL"),
]
PRIORITY_INDICATORS = [
    (group, code.lstrip("-"), "lower" if code.startswith("-") else "higher") for group, codes in _PRIORITY for code in codes.split()
]
# Input variables as (variable, meaning, statement, accounts, expected coverage).
VARIABLES = [
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
