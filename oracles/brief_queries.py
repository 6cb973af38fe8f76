"""Oracle text of the indicator brief. Accounts, formulas and variables are typed here again, from the definitions."""

from __future__ import annotations

import oracles.gold  # noqa: F401
import oracles.silver  # noqa: F401
from oracles.base import money, query

_bp = {
    "ATIVO_TOTAL": "1", "ATIVO_CIRCULANTE": "1.01", "CAIXA_EQUIVALENTES": "1.01.01", "APLICACOES_FINANCEIRAS": "1.01.02",
    "CONTAS_RECEBER": "1.01.03", "ESTOQUES": "1.01.04", "ATIVOS_BIOLOGICOS": "1.01.05", "TRIBUTOS_RECUPERAR": "1.01.06",
    "DESPESAS_ANTECIPADAS": "1.01.07", "OUTROS_ATIVOS_CIRCULANTES": "1.01.08", "ATIVO_NAO_CIRCULANTE": "1.02",
    "REALIZAVEL_LONGO_PRAZO": "1.02.01", "IMOBILIZADO": "1.02.03", "PASSIVO_TOTAL": "2", "PASSIVO_CIRCULANTE": "2.01",
    "OBRIGACOES_SOCIAIS_TRABALHISTAS": "2.01.01", "FORNECEDORES": "2.01.02", "OBRIGACOES_FISCAIS": "2.01.03",
    "EMPRESTIMOS_FINANCIAMENTOS_CP": "2.01.04", "OUTRAS_OBRIGACOES": "2.01.05", "PROVISOES": "2.01.06",
    "PASSIVO_NAO_CIRCULANTE": "2.02", "EMPRESTIMOS_FINANCIAMENTOS_LP": "2.02.01", "PATRIMONIO_LIQUIDO": "2.03",
}
_dre = {"RECEITA_LIQUIDA": "3.01", "CPV": "3.02", "LUCRO_BRUTO": "3.03", "RESULTADO_OPERACIONAL": "3.05", "LUCRO_LIQUIDO": "3.11", "LPA_REPORTADO": "3.99"}
_dfc = {"CAIXA_OPERACIONAL": "6.01", "SALDO_FINAL_CAIXA_DFC": "6.05.02"}
_groups = {
    "ATIVO_OPERACIONAL_CIRCULANTE": "CONTAS_RECEBER ESTOQUES ATIVOS_BIOLOGICOS TRIBUTOS_RECUPERAR DESPESAS_ANTECIPADAS OUTROS_ATIVOS_CIRCULANTES",
    "ATIVO_FINANCEIRO_CIRCULANTE": "CAIXA_EQUIVALENTES APLICACOES_FINANCEIRAS",
    "PASSIVO_OPERACIONAL_CIRCULANTE": "OBRIGACOES_SOCIAIS_TRABALHISTAS FORNECEDORES OBRIGACOES_FISCAIS OUTRAS_OBRIGACOES PROVISOES",
    "PASSIVO_FINANCEIRO_CIRCULANTE": "EMPRESTIMOS_FINANCIAMENTOS_CP",
}


def _sums(accounts: dict[str, str]) -> str:
    return ", ".join(f"sum(VL_CONTA_TRATADO) FILTER (WHERE CD_CONTA = '{code}') AS {name}" for name, code in accounts.items())


_base = f"""
SELECT *, {', '.join(' + '.join(f'coalesce({c}, 0)' for c in parts.split()) + f' AS {name}' for name, parts in _groups.items())} FROM (
SELECT CNPJ_CIA, DT_FIM_EXERC_ANO, max(CD_CVM) AS CD_CVM, min(DENOM_CIA) AS DENOM_CIA, max(SETOR_ATIV) AS SETOR_ATIV, {_sums(_bp)} FROM n1_bp GROUP BY ALL)
LEFT JOIN (SELECT CNPJ_CIA, DT_FIM_EXERC_ANO, {_sums(_dre)} FROM n1_dre GROUP BY ALL) USING (CNPJ_CIA, DT_FIM_EXERC_ANO)
LEFT JOIN (SELECT CNPJ_CIA, DT_FIM_EXERC_ANO, {_sums(_dfc)} FROM n1_dfc GROUP BY ALL) USING (CNPJ_CIA, DT_FIM_EXERC_ANO)"""

_stock = "(coalesce(ESTOQUES, 0) + coalesce(ATIVOS_BIOLOGICOS, 0))"
_third = "(PASSIVO_CIRCULANTE + PASSIVO_NAO_CIRCULANTE)"
_cycle = f"{_stock} * 360 / nullif(abs(CPV), 0) + CONTAS_RECEBER * 360 / nullif(RECEITA_LIQUIDA, 0)"
_bio, _lpa = "'Estoques incluem ativos biológicos.'", "'Valor reportado; o número de ações não está nas demonstrações.'"
_up, _down, _info = "maior é melhor", "menor é melhor", "informativo"
_table = [
    ("Liquidez", "LIQ_GERAL", "Liquidez Geral", "ATIVO_CIRCULANTE + REALIZAVEL_LONGO_PRAZO", _third, "índice", _up, "NULL"),
    ("Liquidez", "LIQ_CORRENTE", "Liquidez Corrente", "ATIVO_CIRCULANTE", "PASSIVO_CIRCULANTE", "índice", _up, "NULL"),
    ("Liquidez", "LIQ_SECA", "Liquidez Seca", f"ATIVO_CIRCULANTE - {_stock}", "PASSIVO_CIRCULANTE", "índice", _up, _bio),
    ("Liquidez", "LIQ_IMEDIATA", "Liquidez Imediata", "coalesce(CAIXA_EQUIVALENTES, 0) + coalesce(APLICACOES_FINANCEIRAS, 0)", "PASSIVO_CIRCULANTE", "índice", _up, "NULL"),
    ("Endividamento", "END_CT_CP", "Capital de Terceiros / Capital Próprio", _third, "PATRIMONIO_LIQUIDO", "índice", _down, "NULL"),
    ("Endividamento", "END_CT_AT", "Capital de Terceiros / Ativo Total", _third, "ATIVO_TOTAL", "decimal", _down, "NULL"),
    ("Endividamento", "END_GARANTIA_CP_CT", "Garantia de Capital Próprio ao Capital de Terceiros", "PATRIMONIO_LIQUIDO", _third, "índice", _up, "NULL"),
    ("Endividamento", "END_COMPOSICAO", "Composição do Endividamento", "PASSIVO_CIRCULANTE", _third, "decimal", _down, "NULL"),
    ("Endividamento", "END_IMOB_CP", "Imobilização do Capital Próprio", "IMOBILIZADO", "PATRIMONIO_LIQUIDO", "decimal", _down, "NULL"),
    ("Endividamento", "END_IMOB_AT", "Imobilização do Ativo Total", "IMOBILIZADO", "ATIVO_TOTAL", "decimal", _down, "NULL"),
    ("Margens", "MARG_BRUTA", "Margem Bruta", "LUCRO_BRUTO", "RECEITA_LIQUIDA", "decimal", _up, "NULL"),
    ("Margens", "MARG_OPERACIONAL", "Margem Operacional", "RESULTADO_OPERACIONAL", "RECEITA_LIQUIDA", "decimal", _up, "NULL"),
    ("Margens", "MARG_LIQUIDA", "Margem Líquida", "LUCRO_LIQUIDO", "RECEITA_LIQUIDA", "decimal", _up, "NULL"),
    ("Margens", "LPA_REPORTADO", "Lucro por Ação reportado", "LPA_REPORTADO", "1", "R$ por ação", _up, _lpa),
    ("Rentabilidade", "RENT_ROA", "ROA", "LUCRO_LIQUIDO", "ATIVO_TOTAL", "decimal", _up, "NULL"),
    ("Rentabilidade", "RENT_ROE", "ROE", "LUCRO_LIQUIDO", "PATRIMONIO_LIQUIDO", "decimal", _up, "NULL"),
    ("Rentabilidade", "RENT_ROI", "ROI", "LUCRO_LIQUIDO", "coalesce(EMPRESTIMOS_FINANCIAMENTOS_CP, 0) + coalesce(EMPRESTIMOS_FINANCIAMENTOS_LP, 0) + PATRIMONIO_LIQUIDO", "decimal", _up, "NULL"),
    ("Atividade", "ATIV_GIRO_ESTOQUES", "Giro dos Estoques Ajustado", "abs(CPV)", _stock, "vezes", _up, _bio),
    ("Atividade", "ATIV_GIRO_RECEBER", "Giro de Contas a Receber", "RECEITA_LIQUIDA", "CONTAS_RECEBER", "vezes", _up, "NULL"),
    ("Atividade", "ATIV_GIRO_PAGAR", "Giro de Contas a Pagar", "abs(CPV)", "FORNECEDORES", "vezes", _info, "NULL"),
    ("Atividade", "ATIV_GIRO_AC", "Giro do Ativo Circulante", "RECEITA_LIQUIDA", "ATIVO_CIRCULANTE", "vezes", _up, "NULL"),
    ("Atividade", "ATIV_PMRE", "PMRE Ajustado", f"{_stock} * 360", "abs(CPV)", "dias", _down, _bio),
    ("Atividade", "ATIV_PMRV", "PMRV", "CONTAS_RECEBER * 360", "RECEITA_LIQUIDA", "dias", _down, "NULL"),
    ("Atividade", "ATIV_PMPC", "PMPC", "FORNECEDORES * 360", "abs(CPV)", "dias", _up, "NULL"),
    ("Atividade", "ATIV_PMRAC", "PMRAC", "ATIVO_CIRCULANTE * 360", "RECEITA_LIQUIDA", "dias", _down, "NULL"),
    ("Ciclos", "CICLO_ECONOMICO", "Ciclo Econômico", _cycle, "1", "dias", _down, _bio),
    ("Ciclos", "CICLO_FINANCEIRO", "Ciclo Financeiro", f"{_cycle} - FORNECEDORES * 360 / nullif(abs(CPV), 0)", "1", "dias", _down, _bio),
    ("Recursos Financeiros", "FLEURIET_CGL", "Capital de Giro Líquido / CCL", "ATIVO_CIRCULANTE - PASSIVO_CIRCULANTE", "1", "R$", _up, "NULL"),
    ("Recursos Financeiros", "FLEURIET_NCG", "Necessidade de Capital de Giro Ajustada", "ATIVO_OPERACIONAL_CIRCULANTE - PASSIVO_OPERACIONAL_CIRCULANTE", "1", "R$", _info, "NULL"),
    ("Recursos Financeiros", "FLEURIET_ST", "Saldo de Tesouraria", "ATIVO_FINANCEIRO_CIRCULANTE - PASSIVO_FINANCEIRO_CIRCULANTE", "1", "R$", _up, "NULL"),
    ("Recursos Financeiros", "DFC_SALDO_FINAL_CAIXA", "Saldo Final de Caixa DFC", "SALDO_FINAL_CAIXA_DFC", "1", "R$", _info, "NULL"),
]
_rows = " UNION ALL ".join(
    f"SELECT CNPJ_CIA, CD_CVM, DENOM_CIA, SETOR_ATIV, DT_FIM_EXERC_ANO, '{g}' AS GRUPO_INDICADOR, '{c}' AS COD_INDICADOR, '{t}' AS NOME_INDICADOR,"
    f" CAST({n} AS DOUBLE) AS n, CAST({d} AS DOUBLE) AS d, '{u}' AS UNIDADE, '{i}' AS INTERPRETACAO, CAST({o} AS VARCHAR) AS OBSERVACAO FROM b"
    for g, c, t, n, d, u, i, o in _table
)

_variables = {
    "V01": ("Ativo Total", "1"), "V02": ("Ativo Circulante", "1.01"), "V03": ("Ativo Nao Circulante", "1.02"),
    "V04": ("Realizavel a Longo Prazo", "1.02.01"), "V05": ("Imobilizado", "1.02.03"), "V06": ("Estoques", "1.01.04"),
    "V07": ("Contas a Receber", "1.01.03"), "V08": ("Fornecedores", "2.01.02"), "V09": ("Passivo Circulante", "2.01"),
    "V10": ("Passivo Nao Circulante", "2.02"), "V11": ("Patrimonio Liquido", "2.03"),
    "V12": ("Emprestimos e Financiamentos CP", "2.01.04"), "V13": ("Emprestimos e Financiamentos LP", "2.02.01"),
    "V14": ("Caixa e Equivalentes BP", "1.01.01"), "V15": ("Aplicacoes Financeiras", "1.01.02"),
    "V16": ("Receita Liquida de Vendas", "3.01"), "V17": ("CPV CMV COGS", "3.02"), "V18": ("Lucro Bruto", "3.03"),
    "V19": ("EBIT Resultado Operacional", "3.05"), "V20": ("Lucro Liquido do Exercicio", "3.11"),
    "V21": ("LPA Basico ON ou Diluido ON", "3.99.01.01, 3.99.02.01"),
    "V22": ("Depreciacao e Amortizacao", "6.01.01.02, 6.01.01.03, 6.01.01.04"),
    "V23": ("Caixa Liquido das Atividades Operacionais", "6.01"), "V24": ("Saldo Final de Caixa DFC", "6.05.02"),
}
_derived = {
    "V25": ("EBITDA", "V19, V22"), "V26": ("Ativo Circulante Financeiro Fleuriet", "V14, V15"), "V27": ("Divida Bruta", "V12, V13"),
    "V28": ("Divida Liquida", "V27, V24"), "V29": ("Capital Investido", "V27, V11"),
}
# What a derived variable needs in the end.
_needs = {"V25": "V19 V22", "V26": "V14 V15", "V27": "V12 V13", "V28": "V12 V13 V24", "V29": "V12 V13 V11"}
_formulas = [
    ("Liquidez Geral", "(AC + RLP) / (PC + ELP)", "V02 V04 V09 V10"), ("Liquidez Corrente", "AC / PC", "V02 V09"),
    ("Liquidez Seca", "(AC - Estoques) / PC", "V02 V06 V09"), ("Liquidez Imediata", "Disponibilidades / PC", "V14 V09"),
    ("PCT/CP", "(PC + ELP) / PL", "V09 V10 V11"), ("PCT/AT", "(PC + ELP) / AT", "V09 V10 V01"),
    ("Garantia CP/CT", "PL / (PC + ELP)", "V11 V09 V10"), ("Composicao de Endividamento", "PC / (PC + ELP)", "V09 V10"),
    ("Imobilizacao do CP", "Imobilizado / PL", "V05 V11"), ("Imobilizacao do AT", "Imobilizado / AT", "V05 V01"),
    ("Margem Bruta", "Lucro Bruto / Receita Liquida", "V18 V16"), ("Margem Operacional", "EBIT / Receita Liquida", "V19 V16"),
    ("Margem Liquida", "Lucro Liquido / Receita Liquida", "V20 V16"), ("LPA", "Lucro Liquido / Numero de acoes", "V21"),
    ("ROA", "Lucro Liquido / Ativo Total", "V20 V01"), ("ROE", "Lucro Liquido / PL", "V20 V11"),
    ("ROI", "Lucro Liquido / Capital Investido", "V20 V29"), ("Giro dos Estoques", "CPV / Estoques", "V17 V06"),
    ("Giro de Contas a Receber", "Receita Liquida / Contas a Receber", "V16 V07"), ("Giro de Contas a Pagar", "CPV / Fornecedores", "V17 V08"),
    ("Giro do Ativo Circulante", "Receita Liquida / AC", "V16 V02"), ("PMRE", "(Estoques * 360) / CPV", "V06 V17"),
    ("PMRV", "(Contas a Receber * 360) / Receita Liquida", "V07 V16"), ("PMPC", "(Fornecedores * 360) / CPV", "V08 V17"),
    ("PMRAC", "(AC * 360) / Receita Liquida", "V02 V16"), ("Ciclo Economico", "PMRE + PMRV", "V06 V07 V16 V17"),
    ("Ciclo Financeiro", "PMRE + PMRV - PMPC", "V06 V07 V08 V16 V17"), ("CGL CCL", "AC - PC", "V02 V09"),
    ("NCG", "(AC - Caixa - Aplicacoes) - (PC - Emprestimos CP)", "V02 V14 V15 V09 V12"),
    ("Saldo de Tesouraria", "Ativo Circulante Financeiro - Passivo Circulante Financeiro", "V26 V12"),
]


def _companies(variables: str) -> str:
    """Number of companies that have every variable."""
    wanted = {v for name in variables.split() for v in _needs.get(name, name).split()}
    tests = []
    for v in sorted(wanted):
        codes = ", ".join(f"'{c.strip()}'" for c in _variables[v][1].split(","))
        tests.append(f"count(*) FILTER (WHERE CD_CONTA IN ({codes})) > 0")
    return f"(SELECT count(*) FROM (SELECT CNPJ_CIA FROM lines3 GROUP BY CNPJ_CIA HAVING {' AND '.join(tests)}))"


def _over_lines(body: str) -> str:
    stacked = " UNION ALL ".join(f"SELECT CNPJ_CIA, CD_CONTA FROM n1_{s}" for s in ("bp", "dre", "dfc"))
    return query("n1_bp n1_dre n1_dfc", f"@@lines3 AS ({stacked})\n{body}").replace("\n@@", ",\n")


_priority = [
    ("Liquidez", "LIQ_SECA_AJUSTADA LIQ_CORRENTE LIQ_IMEDIATA"), ("Endividamento", "ENDIV_TOTAL COMPOSICAO_ENDIV GARANTIA_CP_CT"),
    ("Margens", "MARGEM_BRUTA MARGEM_OPERACIONAL MARGEM_LIQUIDA"), ("Rentabilidade", "ROA ROE ROI"),
    ("Atividade", "GIRO_ESTOQUES_AJUSTADO PMRE_AJUSTADO PMRV PMPC"), ("Ciclos", "CICLO_ECONOMICO CICLO_FINANCEIRO"),
    ("Recursos Financeiros", "NCG ST CGL"),
]
_places = [(group, code) for group, codes in _priority for code in codes.split()]
_headlines = {"bp": "'1', '1.01', '1.02', '2.01', '2.02', '2.03'", "dfc": "'6.01', '6.02', '6.03', '6.05'"}
_overview = "AT PL REC_LIQ EBITDA LUCRO_LIQ DIVIDA_LIQUIDA".split()

ORACLES = {
    "base_balances": query("n1_bp n1_dre n1_dfc", f"SELECT * REPLACE ({money(*_bp, *_dre, *_dfc, *_groups)}) FROM ({_base})"),
    "indicator_brief": query("n1_bp n1_dre n1_dfc", f"@@b AS ({_base})\nSELECT * EXCLUDE (n, d), CAST(CAST(n AS DECIMAL(28,2)) AS DOUBLE) AS VL_NUMERADOR,"
        f" CAST(CAST(d AS DECIMAL(28,2)) AS DOUBLE) AS VL_DENOMINADOR, round(n / nullif(d, 0), 4) + 0.0 AS VL_INDICADOR,"
        f" CASE WHEN n IS NULL THEN 'CONTA_AUSENTE' WHEN coalesce(d, 0) = 0 THEN 'DENOMINADOR_ZERO_OU_NULO' ELSE 'OK' END AS STATUS_CALCULO FROM ({_rows})").replace("\n@@", ",\n"),
    "variable_contract": _over_lines(
        " UNION ALL ".join(
            f"SELECT '{v}' AS VARIAVEL, '{t}' AS TITULO, '{kind}' AS TIPO, '{o}' AS ORIGEM, {_companies(v)} AS EMPRESAS"
            for kind, names in (("BASE", _variables), ("DERIVADA", _derived))
            for v, (t, o) in names.items()
        )
    ),
    "indicator_formulas": _over_lines(
        " UNION ALL ".join(
            f"SELECT '{n}' AS INDICADOR, '{f}' AS FORMULA, '{', '.join(v.split())}' AS VARIAVEIS, {_companies(v)} AS EMPRESAS" for n, f, v in _formulas
        )
    ),
    "overview_snapshot": query(
        "mart", f"SELECT CNPJ_CIA, ANO_FISCAL, {money(*_overview)}, EFEITO_TESOURA FROM mart WHERE ANO_FISCAL = (SELECT max(ANO_FISCAL) FROM mart)"
    ),
    "priority_history": query(
        "long",
        f"""SELECT CNPJ_CIA, ANO_FISCAL, i AS ORDEM, g AS GRUPO, COD_INDICADOR, round(VL_INDICADOR, 4) + 0.0 AS VL_INDICADOR
FROM long JOIN (VALUES {', '.join(f"({i}, '{g}', '{c}')" for i, (g, c) in enumerate(_places))}) p(i, g, c) ON c = COD_INDICADOR""",
    ),
    "prefer_reported": query(
        "dre_t5 dre_rolled",
        f"""SELECT CNPJ_CIA, DT_REFER, CD_CONTA, {money('VL_CONTA_TRATADO')}, FLAG_RECONSTRUCAO FROM (
SELECT *, row_number() OVER (PARTITION BY CNPJ_CIA, DT_REFER, CD_CONTA ORDER BY FLAG_RECONSTRUCAO, VL_CONTA_TRATADO DESC) AS rn FROM (
SELECT CNPJ_CIA, DT_REFER, CD_CONTA, v AS VL_CONTA_TRATADO, FALSE AS FLAG_RECONSTRUCAO FROM dre_t5
UNION ALL SELECT CNPJ_CIA, DT_REFER, CD_CONTA, v, TRUE FROM dre_rolled WHERE ACAO IN ('filled', 'forced', 'inserted'))) WHERE rn = 1""",
    ),
} | {
    f"statement_highlights_{s}": query(
        f"n1_{s}",
        f"""SELECT CNPJ_CIA, DT_REFER_ANO AS ANO_FISCAL, CD_CONTA, DS_CONTA, {money('VL_CONTA_TRATADO')} FROM (SELECT *,
row_number() OVER (PARTITION BY CNPJ_CIA, DT_REFER_ANO, CD_CONTA ORDER BY DT_REFER DESC) AS rn FROM n1_{s} WHERE CD_CONTA IN ({codes})) WHERE rn = 1""",
    )
    for s, codes in _headlines.items()
}
