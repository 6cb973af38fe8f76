"""The indicator brief: base balances of a company-year, the long indicator table, the variable contract and formulas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finledger.functions.literals import literal_frame

# Accounts of the base balances.
BASE_ACCOUNTS: dict[str, str] = {
    "ATIVO_TOTAL": "1",
    "ATIVO_CIRCULANTE": "1.01",
    "CAIXA_EQUIVALENTES": "1.01.01",
    "APLICACOES_FINANCEIRAS": "1.01.02",
    "CONTAS_RECEBER": "1.01.03",
    "ESTOQUES": "1.01.04",
    "ATIVOS_BIOLOGICOS": "1.01.05",
    "TRIBUTOS_RECUPERAR": "1.01.06",
    "DESPESAS_ANTECIPADAS": "1.01.07",
    "OUTROS_ATIVOS_CIRCULANTES": "1.01.08",
    "ATIVO_NAO_CIRCULANTE": "1.02",
    "REALIZAVEL_LONGO_PRAZO": "1.02.01",
    "IMOBILIZADO": "1.02.03",
    "PASSIVO_TOTAL": "2",
    "PASSIVO_CIRCULANTE": "2.01",
    "OBRIGACOES_SOCIAIS_TRABALHISTAS": "2.01.01",
    "FORNECEDORES": "2.01.02",
    "OBRIGACOES_FISCAIS": "2.01.03",
    "EMPRESTIMOS_FINANCIAMENTOS_CP": "2.01.04",
    "OUTRAS_OBRIGACOES": "2.01.05",
    "PROVISOES": "2.01.06",
    "PASSIVO_NAO_CIRCULANTE": "2.02",
    "EMPRESTIMOS_FINANCIAMENTOS_LP": "2.02.01",
    "PATRIMONIO_LIQUIDO": "2.03",
    "RECEITA_LIQUIDA": "3.01",
    "CPV": "3.02",
    "LUCRO_BRUTO": "3.03",
    "RESULTADO_OPERACIONAL": "3.05",
    "LUCRO_LIQUIDO": "3.11",
    "LPA_REPORTADO": "3.99",
    "CAIXA_OPERACIONAL": "6.01",
    "SALDO_FINAL_CAIXA_DFC": "6.05.02",
}
# Operating and financial parts of current assets and liabilities; an absent account counts as zero.
BASE_GROUPS: dict[str, list[str]] = {
    "ATIVO_OPERACIONAL_CIRCULANTE": [
        "CONTAS_RECEBER", "ESTOQUES", "ATIVOS_BIOLOGICOS", "TRIBUTOS_RECUPERAR", "DESPESAS_ANTECIPADAS",
        "OUTROS_ATIVOS_CIRCULANTES",
    ],
    "ATIVO_FINANCEIRO_CIRCULANTE": ["CAIXA_EQUIVALENTES", "APLICACOES_FINANCEIRAS"],
    "PASSIVO_OPERACIONAL_CIRCULANTE": [
        "OBRIGACOES_SOCIAIS_TRABALHISTAS", "FORNECEDORES", "OBRIGACOES_FISCAIS", "OUTRAS_OBRIGACOES", "PROVISOES",
    ],
    "PASSIVO_FINANCEIRO_CIRCULANTE": ["EMPRESTIMOS_FINANCIAMENTOS_CP"],
}
COMPANY = ["CNPJ_CIA", "CD_CVM", "DENOM_CIA", "SETOR_ATIV", "DT_FIM_EXERC_ANO"]

_STOCK = "coalesce(ESTOQUES, 0) + coalesce(ATIVOS_BIOLOGICOS, 0)"
_DEBT = "coalesce(EMPRESTIMOS_FINANCIAMENTOS_CP, 0) + coalesce(EMPRESTIMOS_FINANCIAMENTOS_LP, 0)"
_TURN = f"({_STOCK}) * 360 / nullif(abs(CPV), 0)"
_RECEIVE = "CONTAS_RECEBER * 360 / nullif(RECEITA_LIQUIDA, 0)"
_PAY = "FORNECEDORES * 360 / nullif(abs(CPV), 0)"
_THIRD = "PASSIVO_CIRCULANTE + PASSIVO_NAO_CIRCULANTE"
STOCK_NOTE = "Estoques incluem ativos biológicos."
SHARE_NOTE = "Valor reportado; o número de ações não está nas demonstrações."
# Indicators as (group, code, name, numerator, denominator, unit, reading, note).
INDICATORS: list[tuple[str, str, str, str, str, str, str, str | None]] = [
    ("Liquidez", "LIQ_GERAL", "Liquidez Geral", "ATIVO_CIRCULANTE + REALIZAVEL_LONGO_PRAZO", _THIRD, "índice", "maior é melhor", None),
    ("Liquidez", "LIQ_CORRENTE", "Liquidez Corrente", "ATIVO_CIRCULANTE", "PASSIVO_CIRCULANTE", "índice", "maior é melhor", None),
    ("Liquidez", "LIQ_SECA", "Liquidez Seca", f"ATIVO_CIRCULANTE - ({_STOCK})", "PASSIVO_CIRCULANTE", "índice", "maior é melhor", STOCK_NOTE),
    ("Liquidez", "LIQ_IMEDIATA", "Liquidez Imediata", "ATIVO_FINANCEIRO_CIRCULANTE", "PASSIVO_CIRCULANTE", "índice", "maior é melhor", None),
    ("Endividamento", "END_CT_CP", "Capital de Terceiros / Capital Próprio", _THIRD, "PATRIMONIO_LIQUIDO", "índice", "menor é melhor", None),
    ("Endividamento", "END_CT_AT", "Capital de Terceiros / Ativo Total", _THIRD, "ATIVO_TOTAL", "decimal", "menor é melhor", None),
    ("Endividamento", "END_GARANTIA_CP_CT", "Garantia de Capital Próprio ao Capital de Terceiros", "PATRIMONIO_LIQUIDO", _THIRD, "índice", "maior é melhor", None),
    ("Endividamento", "END_COMPOSICAO", "Composição do Endividamento", "PASSIVO_CIRCULANTE", _THIRD, "decimal", "menor é melhor", None),
    ("Endividamento", "END_IMOB_CP", "Imobilização do Capital Próprio", "IMOBILIZADO", "PATRIMONIO_LIQUIDO", "decimal", "menor é melhor", None),
    ("Endividamento", "END_IMOB_AT", "Imobilização do Ativo Total", "IMOBILIZADO", "ATIVO_TOTAL", "decimal", "menor é melhor", None),
    ("Margens", "MARG_BRUTA", "Margem Bruta", "LUCRO_BRUTO", "RECEITA_LIQUIDA", "decimal", "maior é melhor", None),
    ("Margens", "MARG_OPERACIONAL", "Margem Operacional", "RESULTADO_OPERACIONAL", "RECEITA_LIQUIDA", "decimal", "maior é melhor", None),
    ("Margens", "MARG_LIQUIDA", "Margem Líquida", "LUCRO_LIQUIDO", "RECEITA_LIQUIDA", "decimal", "maior é melhor", None),
    ("Margens", "LPA_REPORTADO", "Lucro por Ação reportado", "LPA_REPORTADO", "1", "R$ por ação", "maior é melhor", SHARE_NOTE),
    ("Rentabilidade", "RENT_ROA", "ROA", "LUCRO_LIQUIDO", "ATIVO_TOTAL", "decimal", "maior é melhor", None),
    ("Rentabilidade", "RENT_ROE", "ROE", "LUCRO_LIQUIDO", "PATRIMONIO_LIQUIDO", "decimal", "maior é melhor", None),
    ("Rentabilidade", "RENT_ROI", "ROI", "LUCRO_LIQUIDO", f"{_DEBT} + PATRIMONIO_LIQUIDO", "decimal", "maior é melhor", None),
    ("Atividade", "ATIV_GIRO_ESTOQUES", "Giro dos Estoques Ajustado", "abs(CPV)", _STOCK, "vezes", "maior é melhor", STOCK_NOTE),
    ("Atividade", "ATIV_GIRO_RECEBER", "Giro de Contas a Receber", "RECEITA_LIQUIDA", "CONTAS_RECEBER", "vezes", "maior é melhor", None),
    ("Atividade", "ATIV_GIRO_PAGAR", "Giro de Contas a Pagar", "abs(CPV)", "FORNECEDORES", "vezes", "informativo", None),
    ("Atividade", "ATIV_GIRO_AC", "Giro do Ativo Circulante", "RECEITA_LIQUIDA", "ATIVO_CIRCULANTE", "vezes", "maior é melhor", None),
    ("Atividade", "ATIV_PMRE", "PMRE Ajustado", f"({_STOCK}) * 360", "abs(CPV)", "dias", "menor é melhor", STOCK_NOTE),
    ("Atividade", "ATIV_PMRV", "PMRV", "CONTAS_RECEBER * 360", "RECEITA_LIQUIDA", "dias", "menor é melhor", None),
    ("Atividade", "ATIV_PMPC", "PMPC", "FORNECEDORES * 360", "abs(CPV)", "dias", "maior é melhor", None),
    ("Atividade", "ATIV_PMRAC", "PMRAC", "ATIVO_CIRCULANTE * 360", "RECEITA_LIQUIDA", "dias", "menor é melhor", None),
    ("Ciclos", "CICLO_ECONOMICO", "Ciclo Econômico", f"{_TURN} + {_RECEIVE}", "1", "dias", "menor é melhor", STOCK_NOTE),
    ("Ciclos", "CICLO_FINANCEIRO", "Ciclo Financeiro", f"{_TURN} + {_RECEIVE} - {_PAY}", "1", "dias", "menor é melhor", STOCK_NOTE),
    ("Recursos Financeiros", "FLEURIET_CGL", "Capital de Giro Líquido / CCL", "ATIVO_CIRCULANTE - PASSIVO_CIRCULANTE", "1", "R$", "maior é melhor", None),
    ("Recursos Financeiros", "FLEURIET_NCG", "Necessidade de Capital de Giro Ajustada", "ATIVO_OPERACIONAL_CIRCULANTE - PASSIVO_OPERACIONAL_CIRCULANTE", "1", "R$", "informativo", None),
    ("Recursos Financeiros", "FLEURIET_ST", "Saldo de Tesouraria", "ATIVO_FINANCEIRO_CIRCULANTE - PASSIVO_FINANCEIRO_CIRCULANTE", "1", "R$", "maior é melhor", None),
    ("Recursos Financeiros", "DFC_SALDO_FINAL_CAIXA", "Saldo Final de Caixa DFC", "SALDO_FINAL_CAIXA_DFC", "1", "R$", "informativo", None),
]


def base_balances(stacked: DataFrame) -> DataFrame:
    """A row for each company and year that has a balance sheet: named accounts, and their operating and financial sums.

    The statements are stacked and pivoted in one grouping, in place of a chain of joins.
    """
    sums = [F.sum(F.when(F.col("CD_CONTA") == code, F.col("VL_CONTA_TRATADO"))).alias(name) for name, code in BASE_ACCOUNTS.items()]
    wide = stacked.filter(F.col("CD_CONTA").isin(list(BASE_ACCOUNTS.values())) | (F.col("GRUPO_DFP_TRATADO") == "BP"))
    wide = wide.groupBy("CNPJ_CIA", "DT_FIM_EXERC_ANO").agg(
        F.bool_or(F.col("GRUPO_DFP_TRATADO") == "BP").alias("_bp"),
        F.max("CD_CVM").alias("CD_CVM"),
        F.min("DENOM_CIA").alias("DENOM_CIA"),
        F.max("SETOR_ATIV").alias("SETOR_ATIV"),
        *sums,
    )
    totals = {
        name: sum((F.coalesce(c, F.lit(0.0)) for c in parts[1:]), F.coalesce(parts[0], F.lit(0.0))) for name, parts in BASE_GROUPS.items()
    }
    return wide.filter("_bp").withColumns(totals).select(*COMPANY, *BASE_ACCOUNTS, *BASE_GROUPS)


def indicator_table(balances: DataFrame) -> DataFrame:
    """The long table: company, indicator with its description, numerator, denominator, value and status."""
    entries = [
        F.struct(
            F.lit(group).alias("GRUPO_INDICADOR"),
            F.lit(code).alias("COD_INDICADOR"),
            F.lit(name).alias("NOME_INDICADOR"),
            F.expr(numerator).cast("double").alias("VL_NUMERADOR"),
            F.expr(denominator).cast("double").alias("VL_DENOMINADOR"),
            F.lit(unit).alias("UNIDADE"),
            F.lit(reading).alias("INTERPRETACAO"),
            F.lit(note).cast("string").alias("OBSERVACAO"),
        )
        for group, code, name, numerator, denominator, unit, reading, note in INDICATORS
    ]
    long = balances.select(*COMPANY, F.inline(F.array(*entries)))
    numerator, denominator = F.col("VL_NUMERADOR"), F.col("VL_DENOMINADOR")
    return long.withColumns(
        {
            "VL_INDICADOR": numerator / F.nullif(denominator, F.lit(0.0)),
            "STATUS_CALCULO": F.when(numerator.isNull(), "CONTA_AUSENTE")
            .when(denominator.isNull() | (denominator == 0), "DENOMINADOR_ZERO_OU_NULO")
            .otherwise("OK"),
        }
    )


# --- variable contract ------------------------------------------------------------------------

# Base variables as (variable, title, accounts).
BASE_VARIABLES: list[tuple[str, str, list[str]]] = [
    ("V01", "Ativo Total", ["1"]),
    ("V02", "Ativo Circulante", ["1.01"]),
    ("V03", "Ativo Nao Circulante", ["1.02"]),
    ("V04", "Realizavel a Longo Prazo", ["1.02.01"]),
    ("V05", "Imobilizado", ["1.02.03"]),
    ("V06", "Estoques", ["1.01.04"]),
    ("V07", "Contas a Receber", ["1.01.03"]),
    ("V08", "Fornecedores", ["2.01.02"]),
    ("V09", "Passivo Circulante", ["2.01"]),
    ("V10", "Passivo Nao Circulante", ["2.02"]),
    ("V11", "Patrimonio Liquido", ["2.03"]),
    ("V12", "Emprestimos e Financiamentos CP", ["2.01.04"]),
    ("V13", "Emprestimos e Financiamentos LP", ["2.02.01"]),
    ("V14", "Caixa e Equivalentes BP", ["1.01.01"]),
    ("V15", "Aplicacoes Financeiras", ["1.01.02"]),
    ("V16", "Receita Liquida de Vendas", ["3.01"]),
    ("V17", "CPV CMV COGS", ["3.02"]),
    ("V18", "Lucro Bruto", ["3.03"]),
    ("V19", "EBIT Resultado Operacional", ["3.05"]),
    ("V20", "Lucro Liquido do Exercicio", ["3.11"]),
    ("V21", "LPA Basico ON ou Diluido ON", ["3.99.01.01", "3.99.02.01"]),
    ("V22", "Depreciacao e Amortizacao", ["6.01.01.02", "6.01.01.03", "6.01.01.04"]),
    ("V23", "Caixa Liquido das Atividades Operacionais", ["6.01"]),
    ("V24", "Saldo Final de Caixa DFC", ["6.05.02"]),
]
# Derived variables as (variable, title, inputs).
DERIVED_VARIABLES: list[tuple[str, str, list[str]]] = [
    ("V25", "EBITDA", ["V19", "V22"]),
    ("V26", "Ativo Circulante Financeiro Fleuriet", ["V14", "V15"]),
    ("V27", "Divida Bruta", ["V12", "V13"]),
    ("V28", "Divida Liquida", ["V27", "V24"]),
    ("V29", "Capital Investido", ["V27", "V11"]),
]
# The quick map of indicators as (name, formula, variables).
FORMULAS: list[tuple[str, str, list[str]]] = [
    ("Liquidez Geral", "(AC + RLP) / (PC + ELP)", ["V02", "V04", "V09", "V10"]),
    ("Liquidez Corrente", "AC / PC", ["V02", "V09"]),
    ("Liquidez Seca", "(AC - Estoques) / PC", ["V02", "V06", "V09"]),
    ("Liquidez Imediata", "Disponibilidades / PC", ["V14", "V09"]),
    ("PCT/CP", "(PC + ELP) / PL", ["V09", "V10", "V11"]),
    ("PCT/AT", "(PC + ELP) / AT", ["V09", "V10", "V01"]),
    ("Garantia CP/CT", "PL / (PC + ELP)", ["V11", "V09", "V10"]),
    ("Composicao de Endividamento", "PC / (PC + ELP)", ["V09", "V10"]),
    ("Imobilizacao do CP", "Imobilizado / PL", ["V05", "V11"]),
    ("Imobilizacao do AT", "Imobilizado / AT", ["V05", "V01"]),
    ("Margem Bruta", "Lucro Bruto / Receita Liquida", ["V18", "V16"]),
    ("Margem Operacional", "EBIT / Receita Liquida", ["V19", "V16"]),
    ("Margem Liquida", "Lucro Liquido / Receita Liquida", ["V20", "V16"]),
    ("LPA", "Lucro Liquido / Numero de acoes", ["V21"]),
    ("ROA", "Lucro Liquido / Ativo Total", ["V20", "V01"]),
    ("ROE", "Lucro Liquido / PL", ["V20", "V11"]),
    ("ROI", "Lucro Liquido / Capital Investido", ["V20", "V29"]),
    ("Giro dos Estoques", "CPV / Estoques", ["V17", "V06"]),
    ("Giro de Contas a Receber", "Receita Liquida / Contas a Receber", ["V16", "V07"]),
    ("Giro de Contas a Pagar", "CPV / Fornecedores", ["V17", "V08"]),
    ("Giro do Ativo Circulante", "Receita Liquida / AC", ["V16", "V02"]),
    ("PMRE", "(Estoques * 360) / CPV", ["V06", "V17"]),
    ("PMRV", "(Contas a Receber * 360) / Receita Liquida", ["V07", "V16"]),
    ("PMPC", "(Fornecedores * 360) / CPV", ["V08", "V17"]),
    ("PMRAC", "(AC * 360) / Receita Liquida", ["V02", "V16"]),
    ("Ciclo Economico", "PMRE + PMRV", ["V06", "V07", "V16", "V17"]),
    ("Ciclo Financeiro", "PMRE + PMRV - PMPC", ["V06", "V07", "V08", "V16", "V17"]),
    ("CGL CCL", "AC - PC", ["V02", "V09"]),
    ("NCG", "(AC - Caixa - Aplicacoes) - (PC - Emprestimos CP)", ["V02", "V14", "V15", "V09", "V12"]),
    ("Saldo de Tesouraria", "Ativo Circulante Financeiro - Passivo Circulante Financeiro", ["V26", "V12"]),
]


def _presence() -> dict[str, Column]:
    """Whether a company has a variable: a base one by any of its accounts, a derived one by all of its inputs."""
    has = {v: F.bool_or(F.col("CD_CONTA").isin(codes)) for v, _, codes in BASE_VARIABLES}
    for variable, _, inputs in DERIVED_VARIABLES:
        has[variable] = has[inputs[0]] & has[inputs[1]]
    return has


def _companies_with(stacked: DataFrame, wanted: list[tuple[str, list[str]]]) -> DataFrame:
    """(nome, EMPRESAS): companies that have all variables of each entry, in one pass over the lines."""
    has = _presence()
    flags = stacked.groupBy("CNPJ_CIA").agg(*[has[v].alias(v) for v in has])
    counts = []
    for i, (_, variables) in enumerate(wanted):
        every = F.lit(True)
        for v in variables:
            every = every & F.col(v)
        counts.append(F.count_if(every).alias(f"n{i}"))
    entries = [F.struct(F.lit(name).alias("nome"), F.col(f"n{i}").alias("EMPRESAS")) for i, (name, _) in enumerate(wanted)]
    return flags.agg(*counts).select(F.inline(F.array(*entries)))


def variable_contract(stacked: DataFrame) -> DataFrame:
    """The 29 variables: title, whether base or derived, accounts or inputs, and the companies that have them."""
    rows = [(v, title, "BASE", ", ".join(codes)) for v, title, codes in BASE_VARIABLES]
    rows += [(v, title, "DERIVADA", ", ".join(inputs)) for v, title, inputs in DERIVED_VARIABLES]
    spec = literal_frame(stacked.sparkSession, rows, "VARIAVEL string, TITULO string, TIPO string, ORIGEM string")
    counted = _companies_with(stacked, [(v, [v]) for v, *_ in rows])
    return counted.join(F.broadcast(spec), counted["nome"] == spec["VARIAVEL"]).drop("nome")


def indicator_formulas(stacked: DataFrame) -> DataFrame:
    """The quick map: formula and variables of every indicator, and the companies that have all of them."""
    rows = [(name, formula, ", ".join(variables)) for name, formula, variables in FORMULAS]
    spec = literal_frame(stacked.sparkSession, rows, "INDICADOR string, FORMULA string, VARIAVEIS string")
    counted = _companies_with(stacked, [(name, variables) for name, _, variables in FORMULAS])
    return counted.join(F.broadcast(spec), counted["nome"] == spec["INDICADOR"]).drop("nome")
