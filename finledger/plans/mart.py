"""Company-year marts: balances pivoted from accounts, second-order terms and ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finledger import schema as S
from finledger.functions.expressions import ratio, zero_if_null
from finledger.operators.rows import newest_first, newest_row

KEYS = ["CNPJ_CIA", "ANO_FISCAL"]
MART_STATEMENTS = ["BP", "DRE", "DFC"]


def stack_statements(statements: dict[str, DataFrame]) -> DataFrame:
    """Statement tables of one layout under each other."""
    stacked = None
    for df in statements.values():
        stacked = df if stacked is None else stacked.unionByName(df, allowMissingColumns=True)
    return stacked


def mart_lines(lines: DataFrame) -> DataFrame:
    """The lines a mart can use: its statements, its accounts, a known fiscal year. Filters reach the scan."""
    wanted = list(S.MART_ACCOUNTS.values()) + S.DEPRECIATION_ACCOUNTS
    return lines.filter(
        F.col("GRUPO_DFP_TRATADO").isin(MART_STATEMENTS)
        & F.col("CD_CONTA").isin(wanted)
        & F.col("DT_FIM_EXERC_ANO").isNotNull()
    ).withColumn("ANO_FISCAL", F.col("DT_FIM_EXERC_ANO"))


def newest_balances(lines: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """Newest line per company, fiscal year and account: highest version, then latest date."""
    order = ["VERSAO", "DT_REFER", *(tie_break if tie_break is not None else ["LINE_ID", "LINE_SEQ", "VL_CONTA"])]
    return newest_row(lines, [*KEYS, "GRUPO_DFP_TRATADO", "CD_CONTA"], newest_first(*order))


def account_pivot(balances: DataFrame) -> DataFrame:
    """First-order mart: one row per company-year, one column per account."""
    value = F.col("VL_CONTA_TRATADO").cast("double")
    accounts = [F.max(F.when(F.col("CD_CONTA") == code, value)).alias(name) for name, code in S.MART_ACCOUNTS.items()]
    sector = [F.max("SETOR_ATIV").alias("SETOR")] if "SETOR_ATIV" in balances.columns else []
    depreciation = F.coalesce(
        F.sum(F.when(F.col("CD_CONTA").isin(S.DEPRECIATION_ACCOUNTS), F.col("VL_CONTA_TRATADO"))).cast("double"),
        F.lit(0.0),
    )
    return balances.groupBy(*KEYS).agg(
        F.max("DT_REFER").alias("DT_REFER"),
        F.max("DENOM_CIA").alias("RAZAO_SOCIAL"),
        *sector,
        F.max("CD_CVM").alias("CD_CVM"),
        F.lit("MERCADO_ABERTO").alias("TP_MERC"),
        *accounts,
        depreciation.alias("DEP_AMORT"),
    )


def with_sector(first_order: DataFrame, companies: DataFrame) -> DataFrame:
    """Sector from the registry, joined at company-year grain rather than per line."""
    sectors = companies.select("CNPJ_CIA", F.col("SETOR_ATIV").alias("SETOR"))
    return first_order.join(sectors, "CNPJ_CIA", "left")


def second_order(first: DataFrame) -> DataFrame:
    """Operating and financial working-capital terms, gross debt and capital expenditure; missing parts count as 0."""
    z = zero_if_null
    terms = {
        "ACF": z("CAIXA_EQUIV") + z("APLIC_FIN"),
        "PCF": z("EMP_FIN_CP"),
        "CGL": z("AC") - z("PC"),
        "CPV_ABS": F.abs(z("CPV")),
        "ESTOQUE_OPERACIONAL": z("ESTOQUES") + z("AT_BIOLOGICO"),
        "DIVIDA_BRUTA": z("EMP_FIN_CP") + z("EMP_FIN_LP"),
        "CAPEX": F.abs(z("AQUISICAO_IMOBILIZADO_1"))
        + F.abs(z("AQUISICAO_IMOBILIZADO_2"))
        + F.abs(z("AQUISICAO_INTANGIVEL")),
    }
    later = {"ACO": z("AC") - F.col("ACF"), "PCO": z("PC") - F.col("PCF")}
    return first.withColumns(terms).withColumns(later)


def _inventory_known() -> Column:
    return F.col("ESTOQUES").isNotNull() | F.col("AT_BIOLOGICO").isNotNull()


def _days(balance: str, flow: str, known: Column | None = None) -> Column:
    days = ratio(F.col(balance) * 360.0, flow)
    return days if known is None else F.when(known, days)


def ratios() -> dict[str, Column]:
    """Every ratio of the strict mart over the second-order columns; NULL where its denominator is unusable."""
    debt = F.col("PC") + F.col("PNC")
    ebitda = F.col("EBIT") + zero_if_null("DEP_AMORT")
    net_debt = F.col("DIVIDA_BRUTA") - zero_if_null("SALDO_FINAL_CAIXA_DFC")
    invested = F.col("DIVIDA_BRUTA") + zero_if_null("PL")
    dry = ratio(F.col("AC") - F.col("ESTOQUE_OPERACIONAL"), "PC")
    leverage = ratio(debt, "AT")
    turnover = ratio("CPV_ABS", "ESTOQUE_OPERACIONAL")
    inventory_days = _days("ESTOQUE_OPERACIONAL", "CPV_ABS", _inventory_known())
    return {
        # liquidity
        "LIQ_CORRENTE": ratio("AC", "PC"),
        "LIQ_SECA": dry,
        "LIQ_SECA_AJUSTADA": dry,
        "LIQ_IMEDIATA": ratio("ACF", "PC"),
        "LIQ_GERAL": ratio(F.col("AC") + F.col("RLP"), debt),
        # debt
        "ENDIV_TOTAL": leverage,
        "GRAU_ENDIVIDAMENTO": leverage,
        "ENDIV_CP": ratio(debt, "PL", "nonzero"),
        "GARANTIA_CP_CT": ratio("PL", debt, "nonzero"),
        "COMPOSICAO_ENDIV": ratio("PC", debt, "nonzero"),
        "IMOB_PL": ratio("IMOBILIZADO", "PL"),
        "IMOB_AT": ratio("IMOBILIZADO", "AT"),
        "DIVIDA_LIQUIDA": net_debt,
        "DL_EBITDA": ratio(net_debt, ebitda),
        # margin
        "EBITDA": ebitda,
        "LPA": F.coalesce("LPA_DILUIDO_ON", "LPA_BASICO_ON", "LPA_3_99"),
        "MARGEM_BRUTA": ratio("LUCRO_BRUTO", "REC_LIQ"),
        "MARGEM_OPERACIONAL": ratio("EBIT", "REC_LIQ"),
        "MARGEM_EBITDA": ratio(ebitda, "REC_LIQ"),
        "MARGEM_LIQUIDA": ratio("LUCRO_LIQ", "REC_LIQ"),
        # return
        "ROA": ratio("LUCRO_LIQ", "AT"),
        "ROE": ratio("LUCRO_LIQ", "PL"),
        "ROI": ratio("LUCRO_LIQ", invested, "nonzero"),
        # activity
        "GIRO_ESTOQUES": turnover,
        "GIRO_ESTOQUES_AJUSTADO": turnover,
        "GIRO_CLIENTES": ratio("REC_LIQ", "CLIENTES"),
        "GIRO_FORNECEDORES": ratio("CPV_ABS", "FORNECEDORES"),
        "GIRO_ATIVO_TOTAL": ratio("REC_LIQ", "AT"),
        "GIRO_AC": ratio("REC_LIQ", "AC"),
        "PMRV": _days("CLIENTES", "REC_LIQ"),
        "PMRE": inventory_days,
        "PMRE_AJUSTADO": inventory_days,
        "PMPC": _days("FORNECEDORES", "CPV_ABS"),
        "PMRAC": _days("AC", "REC_LIQ"),
        # working capital
        "NCG": F.col("ACO") - F.col("PCO"),
        "ST": F.col("ACF") - F.col("PCF"),
        # cash
        "COB_CAIXA_OPERACIONAL": ratio("CAIXA_OPERACIONAL", "PC"),
        "MARGEM_CAIXA_OPERACIONAL": ratio("CAIXA_OPERACIONAL", "REC_LIQ"),
        "COBERTURA_DIVIDA_CAIXA": ratio("CAIXA_OPERACIONAL", "DIVIDA_BRUTA"),
        "INTENSIDADE_REINVESTIMENTO": ratio("CAPEX", "CAIXA_OPERACIONAL"),
    }


def cycles() -> dict[str, Column]:
    economic = F.col("PMRE_AJUSTADO") + F.col("PMRV")
    financial = economic - F.col("PMPC")
    return {"CICLO_ECONOMICO": economic, "CICLO_FINANCEIRO": financial, "CCC": financial}


def scissors_effect(consecutive_years: bool = False) -> Column:
    """Treasury balance negative and falling for three rows in a row; never NULL.

    Like its definition it looks at the previous rows of the company. ``consecutive_years`` also asks that they are
    the previous years. One row per company-year, so the window holds a company's few years.
    """
    years = Window.partitionBy("CNPJ_CIA").orderBy("ANO_FISCAL")
    now, last, before = F.col("ST"), F.lag("ST", 1).over(years), F.lag("ST", 2).over(years)
    falling = (now < 0) & (last < 0) & (before < 0) & (now < last) & (last < before)
    if consecutive_years:
        falling = falling & (F.lag("ANO_FISCAL", 2).over(years) == F.col("ANO_FISCAL") - 2)
    return F.coalesce(falling, F.lit(False))


def indicator_mart(first: DataFrame, consecutive_years: bool = False) -> DataFrame:
    """The strict mart from a first-order mart: terms, ratios, cycles and the scissors effect."""
    wide = second_order(first).withColumns(ratios()).withColumns(cycles())
    return wide.withColumn("EFEITO_TESOURA", scissors_effect(consecutive_years)).drop(
        "LPA_DILUIDO_ON", "LPA_BASICO_ON", "LPA_3_99"
    )


def mart_from_lines(lines: DataFrame, companies: DataFrame | None = None) -> DataFrame:
    """Strict mart straight from normalised lines of any version."""
    first = account_pivot(newest_balances(mart_lines(lines)))
    return indicator_mart(first if companies is None else with_sector(first, companies))


def mart_from_curated(tables: dict[str, DataFrame]) -> DataFrame:
    """Strict mart from the curated statements."""
    stacked = mart_lines(stack_statements(tables))
    return indicator_mart(account_pivot(newest_balances(stacked, tie_break=["VL_CONTA_TRATADO"])))


# --- simple rules -----------------------------------------------------------------------------


def prefer_reported(lines: DataFrame) -> DataFrame:
    """Reported line before a rebuilt one, per company, date and account."""
    order = [F.col("FLAG_RECONSTRUCAO").asc(), F.col("VL_CONTA_TRATADO").desc()]
    return newest_row(lines, ["CNPJ_CIA", "DT_REFER", "CD_CONTA"], order)


def _one_per_account(lines: DataFrame, accounts: list[str]) -> DataFrame:
    return prefer_reported(lines.filter(F.col("CD_CONTA").isin(accounts)))


def drop_outliers(value: Column) -> Column:
    """Per-share amounts beyond the limit are source errors and become NULL."""
    wild = F.col("CD_CONTA").isin(S.PER_SHARE_ACCOUNTS) & (F.abs(value) > S.PER_SHARE_LIMIT)
    return F.when(~wild, value)


def _wide(lines: DataFrame, accounts: dict[str, str]) -> DataFrame:
    value = drop_outliers(F.col("VL_CONTA_TRATADO").cast("double"))
    return lines.groupBy("CNPJ_CIA", "DT_REFER").agg(
        *[F.max(F.when(F.col("CD_CONTA") == code, value)).alias(name) for name, code in accounts.items()]
    )


def assemble_simple(bp: DataFrame, dre: DataFrame, dfc: DataFrame, companies: DataFrame) -> DataFrame:
    """Balance sheet and income outer-joined per date, then cash flow and company attributes where present."""
    keys = ["CNPJ_CIA", "DT_REFER"]
    balance = _wide(_one_per_account(bp, list(S.SIMPLE_BALANCE_ACCOUNTS.values())), S.SIMPLE_BALANCE_ACCOUNTS)
    income = _wide(_one_per_account(dre, list(S.SIMPLE_INCOME_ACCOUNTS.values())), S.SIMPLE_INCOME_ACCOUNTS)
    cash = dfc.filter(F.col("CD_CONTA") == "6.05.02").groupBy(*keys).agg(
        F.max(F.col("VL_CONTA_TRATADO").cast("double")).alias("V23_CAIXA_DFC")
    )
    names = companies.select(
        "CNPJ_CIA", F.col("DENOM_SOCIAL").alias("RAZAO_SOCIAL"), F.col("SETOR_ATIV").alias("SETOR"), "TP_MERC"
    )
    return balance.join(income, keys, "full").join(cash, keys, "left").join(names, "CNPJ_CIA", "left")


def simple_indicators(wide: DataFrame) -> DataFrame:
    """The simple rules: any non-zero denominator, no biological assets, cash only for immediate liquidity."""
    c = F.col
    inputs = wide.withColumns(
        {
            "V06_ESTOQUES": zero_if_null("V06_ESTOQUES_RAW"),
            "V13_EMP_CP": zero_if_null("V13_EMP_CP"),
            "V14_EMP_LP": zero_if_null("V14_EMP_LP"),
            "V15B_APLIC_FIN": zero_if_null("V15B_APLIC_FIN"),
            "V26_LPA_DILUIDO": F.coalesce("V26_LPA_DILUIDO_RAW", "V25_LPA_BASICO"),
        }
    )
    helpers = inputs.withColumns(
        {
            "AUX_PASSIVO_TOTAL": c("V10_PASSIVO_CIRC") + c("V11_PASSIVO_NCIRC"),
            "AUX_ACF": c("V22_CAIXA_BP") + c("V15B_APLIC_FIN"),
            "AUX_DIVIDA_BRUTA": c("V13_EMP_CP") + c("V14_EMP_LP"),
            "AUX_DIVIDA_LIQUIDA": c("V13_EMP_CP") + c("V14_EMP_LP") - c("V23_CAIXA_DFC"),
            "AUX_CAPITAL_INVEST": c("V12_PL") + c("V13_EMP_CP") + c("V14_EMP_LP"),
            "AUX_CPV_ABS": F.abs("V18_CPV"),
        }
    )

    def r(n, d):
        return ratio(n, d, "nonzero")

    first = {
        "IND_LIQUIDEZ_GERAL": r(c("V02_ATIVO_CIRC") + c("V04_RLP"), "AUX_PASSIVO_TOTAL"),
        "IND_LIQUIDEZ_CORRENTE": r("V02_ATIVO_CIRC", "V10_PASSIVO_CIRC"),
        "IND_LIQUIDEZ_SECA": r(c("V02_ATIVO_CIRC") - c("V06_ESTOQUES"), "V10_PASSIVO_CIRC"),
        "IND_LIQUIDEZ_IMEDIATA": r("V22_CAIXA_BP", "V10_PASSIVO_CIRC"),
        "IND_PCT_CP": r("AUX_PASSIVO_TOTAL", "V12_PL"),
        "IND_PCT_AT": r("AUX_PASSIVO_TOTAL", "V01_ATIVO_TOTAL"),
        "IND_GARANTIA_CT": r("V12_PL", "AUX_PASSIVO_TOTAL"),
        "IND_COMPOSICAO_ENDIV": r("V10_PASSIVO_CIRC", "AUX_PASSIVO_TOTAL"),
        "IND_IMOB_CP": r("V05_IMOBILIZADO", "V12_PL"),
        "IND_IMOB_AT": r("V05_IMOBILIZADO", "V01_ATIVO_TOTAL"),
        "IND_MARGEM_BRUTA": r("V19_LUCRO_BRUTO", "V17_RECEITA_LIQ"),
        "IND_MARGEM_OPERACIONAL": r("V20_EBIT", "V17_RECEITA_LIQ"),
        "IND_MARGEM_LIQUIDA": r("V21_LUCRO_LIQ", "V17_RECEITA_LIQ"),
        "IND_LPA_DILUIDO": c("V26_LPA_DILUIDO"),
        "IND_ROA": r("V21_LUCRO_LIQ", "V01_ATIVO_TOTAL"),
        "IND_ROE": r("V21_LUCRO_LIQ", "V12_PL"),
        "IND_ROI": r("V21_LUCRO_LIQ", "AUX_CAPITAL_INVEST"),
        "IND_GIRO_ESTOQUES": r("AUX_CPV_ABS", "V06_ESTOQUES_RAW"),
        "IND_GIRO_CR": r("V17_RECEITA_LIQ", "V07_CONTAS_RECEBER"),
        "IND_GIRO_CP": r("AUX_CPV_ABS", "V09_FORNECEDORES"),
        "IND_GIRO_AC": r("V17_RECEITA_LIQ", "V02_ATIVO_CIRC"),
        "IND_PMRE": r(c("V06_ESTOQUES_RAW") * 360.0, "AUX_CPV_ABS"),
        "IND_PMRV": r(c("V07_CONTAS_RECEBER") * 360.0, "V17_RECEITA_LIQ"),
        "IND_PMPC": r(c("V09_FORNECEDORES") * 360.0, "AUX_CPV_ABS"),
        "IND_PMRAC": r(c("V02_ATIVO_CIRC") * 360.0, "V17_RECEITA_LIQ"),
    }
    last = {
        "IND_CICLO_ECONOMICO": c("IND_PMRE") + c("IND_PMRV"),
        "IND_CICLO_FINANCEIRO": c("IND_PMRE") + c("IND_PMRV") - c("IND_PMPC"),
        "IND_CGL": c("V02_ATIVO_CIRC") - c("V10_PASSIVO_CIRC"),
        "IND_NCG": c("V06_ESTOQUES") + c("V07_CONTAS_RECEBER") - c("V09_FORNECEDORES"),
        "IND_ST": c("AUX_ACF") - c("V13_EMP_CP"),
    }
    ordered = [
        *["CNPJ_CIA", "DT_REFER", "RAZAO_SOCIAL", "SETOR", "TP_MERC"],
        *[n for n in S.SIMPLE_BALANCE_ACCOUNTS],
        "V06_ESTOQUES",
        *[n for n in S.SIMPLE_INCOME_ACCOUNTS],
        "V26_LPA_DILUIDO",
        "V23_CAIXA_DFC",
        *["AUX_PASSIVO_TOTAL", "AUX_ACF", "AUX_DIVIDA_BRUTA", "AUX_DIVIDA_LIQUIDA", "AUX_CAPITAL_INVEST", "AUX_CPV_ABS"],
        *first,
        *last,
    ]
    return helpers.withColumns(first).withColumns(last).select(*ordered)


def simple_mart(bp: DataFrame, dre: DataFrame, dfc: DataFrame, companies: DataFrame) -> DataFrame:
    return simple_indicators(assemble_simple(bp, dre, dfc, companies))
