"""Audits of ledger tables: volume, identities, distributions, duplicates, coverage, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finledger import schema as S
from finledger.functions.expressions import prefix
from finledger.functions.literals import literal_frame
from finledger.operators.distribution import _attach, group_quantiles
from finledger.operators.hierarchy import FILING, pair_status, parent_child_pairs
from finledger.sources.tables import publish

VALUE = "VL_CONTA_TRATADO"


def total_of(*codes: str) -> Column:
    """Sum of some accounts inside a group; 0 when none of them is there."""
    return F.sum(F.when(F.col("CD_CONTA").isin(*codes), F.col(VALUE)).otherwise(0))


def volume_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("TOTAL_LINHAS"),
        F.count_distinct("CNPJ_CIA").alias("TOTAL_EMPRESAS"),
        F.count_distinct("DT_REFER").alias("TOTAL_PERIODOS"),
        F.min("DT_REFER").alias("PERIODO_MAIS_ANTIGO"),
        F.max("DT_REFER").alias("PERIODO_MAIS_RECENTE"),
        F.count_distinct("CD_CONTA").alias("TOTAL_CONTAS"),
        F.count_if(F.col(VALUE).isNull()).alias("NULOS"),
    )


def balance_equation(df: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Assets against liabilities per filing. The two roots are filtered at the scan before anything is grouped."""
    filings = df.groupBy("CNPJ_CIA", "DENOM_CIA", "DT_REFER").agg(
        total_of("1").alias("TOTAL_ATIVO"), total_of("2").alias("TOTAL_PASSIVO")
    )
    difference = F.col("TOTAL_ATIVO") - F.col("TOTAL_PASSIVO")
    status = (
        F.when(F.abs(difference) <= tolerance, "OK")
        .when((F.col("TOTAL_ATIVO") == 0) & (F.col("TOTAL_PASSIVO") == 0), "ZERADO")
        .otherwise("DESBALANCEADO")
    )
    return filings.withColumns({"DIFERENCA": difference, "STATUS_EQUACAO": status})


def distribution(df: DataFrame, by: list[str], measures: dict[str, Column] | None = None) -> DataFrame:
    """Rows per combination with their share of all rows. The share is a window over the grouped result."""
    extra = [c.alias(name) for name, c in (measures or {}).items()]
    counted = df.groupBy(*by).agg(F.count("*").alias("QTD_LINHAS"), *extra)
    total = F.sum("QTD_LINHAS").over(Window.partitionBy())
    return counted.withColumn("PCT_TOTAL", F.round(F.col("QTD_LINHAS") * 100.0 / total, 2))


def duplicate_keys(df: DataFrame, keys: list[str], top: int | None = 20) -> DataFrame:
    """Keys that occur more than once, most frequent first."""
    found = df.groupBy(*keys).agg(F.count("*").alias("OCORRENCIAS")).filter(F.col("OCORRENCIAS") > 1)
    return found if top is None else found.orderBy(F.col("OCORRENCIAS").desc(), *keys).limit(top)


def parent_child_check(df: DataFrame, tolerance: float = 1000.0) -> DataFrame:
    """Every parent with its children's sum, the gap and a status."""
    pairs = parent_child_pairs(df)
    parent, children = F.col(VALUE), F.col("SOMA_FILHOS")
    return pairs.select(
        *FILING,
        "DENOM_CIA",
        "CD_CONTA",
        parent.alias("VL_PAI"),
        "SOMA_FILHOS",
        (parent - children).alias("DIFERENCA"),
        F.col("FLAG_RECONSTRUCAO").alias("PAI_RECONSTRUIDO"),
        pair_status(parent, children, tolerance).alias("STATUS_PAR"),
    )


def parent_child_summary(df: DataFrame, tolerance: float = 1000.0) -> DataFrame:
    return parent_child_check(df, tolerance).groupBy("STATUS_PAR", "PAI_RECONSTRUIDO").agg(F.count("*").alias("QTD"))


def coverage_crosscheck(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Filings present in one statement only, and in both: one grouping in place of two anti joins and a join."""
    sides = left.select(*FILING, F.lit(True).alias("_l"), F.lit(False).alias("_r")).unionByName(
        right.select(*FILING, F.lit(False).alias("_l"), F.lit(True).alias("_r"))
    )
    filings = sides.groupBy(*FILING).agg(F.bool_or("_l").alias("_l"), F.bool_or("_r").alias("_r"))
    counted = filings.agg(
        F.count_if(F.col("_l") & ~F.col("_r")).alias(f"SO_{left_name}"),
        F.count_if(~F.col("_l") & F.col("_r")).alias(f"SO_{right_name}"),
        F.count_if(F.col("_l") & F.col("_r")).alias("AMBOS"),
    )
    return counted.unpivot([], counted.columns, "SITUACAO", "QTD_PARES")


def cash_identity(dfc: DataFrame, fx_share: float = 1.0) -> DataFrame:
    """Operating, investing, financing and currency flows against the change in cash.

    A reported (not rebuilt) gap of up to ``fx_share`` percent is an implicit currency effect.
    """
    flows, change = ["6.01", "6.02", "6.03", "6.04"], "6.05"
    filings = (
        dfc.filter(F.col("CD_CONTA").isin(*flows, change))
        .groupBy("CNPJ_CIA", "DENOM_CIA", "DT_REFER")
        .agg(
            total_of(*flows).alias("SOMA_FLUXOS"),
            total_of(change).alias("VARIACAO_CAIXA"),
            F.bool_or("FLAG_RECONSTRUCAO").alias("RECONSTRUIDO"),
        )
    )
    gap = F.abs(F.col("SOMA_FLUXOS") - F.col("VARIACAO_CAIXA"))
    share = gap.cast("double") / F.nullif(F.abs("VARIACAO_CAIXA").cast("double"), F.lit(0.0)) * 100
    status = (
        F.when((F.col("SOMA_FLUXOS") == 0) & (F.col("VARIACAO_CAIXA") == 0), "ZERADO")
        .when(gap <= 1, "OK")
        .when(~F.col("RECONSTRUIDO") & (share <= fx_share), "EFEITO_CAMBIAL")
        .otherwise("DIVERGE")
    )
    return filings.withColumns(
        {
            "DIFERENCA": F.col("SOMA_FLUXOS") - F.col("VARIACAO_CAIXA"),
            "PCT_DIVERGENCIA": F.round(share, 4),
            "STATUS_IDENTIDADE": status,
        }
    )


def cash_reconciliation(dfc: DataFrame, bp: DataFrame, tolerance: float = 1000.0) -> DataFrame:
    """Final cash of the cash-flow statement against cash and short-term investments of the balance sheet."""
    closing = (
        dfc.filter(F.col("CD_CONTA") == "6.05.02")
        .groupBy("CNPJ_CIA", "DENOM_CIA", "DT_REFER")
        .agg(F.sum(VALUE).alias("DFC_6_05_02"), F.bool_or("FLAG_RECONSTRUCAO").alias("DFC_RECONSTRUIDO"))
    )
    cash = (
        bp.filter(F.col("CD_CONTA").isin("1.01.01", "1.01.02"))
        .groupBy(*FILING)
        .agg(total_of("1.01.01").alias("BP_1_01_01"), total_of("1.01.02").alias("BP_1_01_02"))
    )
    saldo, c1 = F.col("DFC_6_05_02"), F.col("BP_1_01_01")
    ceiling = c1 + F.coalesce("BP_1_01_02", F.lit(0))
    diagnosis = (
        F.when(c1.isNull(), "SEM_BP")
        .when(F.abs(saldo - c1) <= tolerance, "IDENTICO")
        .when((saldo > c1) & (saldo <= ceiling + tolerance), "EQUIVALENTES")
        .when(saldo < c1 - tolerance, "CAIXA_RESTRITO")
        .when(~F.col("DFC_RECONSTRUIDO"), "MANTIDO_PARA_VENDA")
        .when(F.col("DFC_RECONSTRUIDO"), "ERRO_RECONSTRUIDO")
        .otherwise("VERIFICAR")
    )
    # What is looked at first: above the ceiling though rebuilt, above it though reported, the rest; then by the gap.
    above = F.coalesce(saldo > ceiling + tolerance, F.lit(False))
    priority = F.when(above & F.col("DFC_RECONSTRUIDO"), 0).when(above, 1).otherwise(2)
    judged = closing.join(cash, FILING, "left").withColumns(
        {"BP_TETO": ceiling, "DIAGNOSTICO": diagnosis, "PRIORIDADE": priority}
    )
    return judged.orderBy("PRIORIDADE", F.abs(saldo - F.coalesce(c1, F.lit(0))).desc(), *FILING)


def waterfall_check(dre: DataFrame, tolerance: float = 1.0, extra: list[Column] | None = None) -> DataFrame:
    """Gross result and operating result against their parts, per filing."""
    codes = ["3.01", "3.02", "3.03", "3.04", "3.05"]
    totals = [total_of(c).alias(f"C{c.replace('.', '_')}") for c in codes]
    filings = dre.groupBy(*FILING).agg(*totals, *(extra or []))
    revenue, cost, gross, expenses, operating = [F.col(f"C{c.replace('.', '_')}") for c in codes]
    gross_ok = (F.abs(gross - (revenue + cost)) <= tolerance) | (F.abs(gross - (revenue - F.abs(cost))) <= tolerance)
    return filings.withColumns(
        {"BRUTO_OK": gross_ok, "EBIT_OK": F.abs(operating - (gross + expenses)) <= tolerance}
    )


def publish_gate(df: DataFrame) -> DataFrame:
    """One row: duplicated keys, failed waterfall tests, and whether the table may be written.

    The table is grouped by account once; both tests read that.
    """
    accounts = df.groupBy(*FILING, "CD_CONTA").agg(F.count("*").alias("_n"), F.sum(VALUE).alias(VALUE))
    repeated = F.count_if(F.col("_n") > 1).alias("_repetidas")
    failed = waterfall_check(accounts, extra=[repeated]).agg(
        F.sum("_repetidas").alias("CHAVES_DUPLICADAS"),
        F.count_if(~F.col("BRUTO_OK")).alias("FALHAS_BRUTO"),
        F.count_if(~F.col("EBIT_OK")).alias("FALHAS_EBIT"),
    )
    total = F.col("CHAVES_DUPLICADAS") + F.col("FALHAS_BRUTO") + F.col("FALHAS_EBIT")
    return failed.withColumn("APROVADO", total == 0)


def write_if_approved(df: DataFrame, path: str) -> bool:
    """Publish a table only when the gate approves it; tells whether it was. The table is written once, and the gate
    judges what was written."""
    return publish(df, path, lambda written: publish_gate(written).first()["APROVADO"])


def gap_candidates(bp: DataFrame, margin: float = 0.01) -> DataFrame:
    """For every unbalanced filing, the accounts whose size is within ``margin`` of the gap."""
    gaps = balance_equation(bp.filter(F.col("CD_CONTA").isin("1", "2")), 1.0).filter(
        F.col("STATUS_EQUACAO") == "DESBALANCEADO"
    )
    gap = F.abs("DIFERENCA").cast("double")
    size = F.abs(F.col(VALUE)).cast("double")
    return (
        bp.select(*FILING, "CD_CONTA", VALUE)
        .join(gaps.select(*FILING, "DIFERENCA"), FILING)
        .filter(size.between(gap * (1 - margin), gap * (1 + margin)))
    )


def group_totals(bp: DataFrame) -> DataFrame:
    """Roots against the sum of their second-level groups, per filing."""
    level = F.col("CD_CONTA").rlike(r"^[12]\.\d{2}$")
    groups = F.sum(F.when(level, F.col(VALUE)).otherwise(0))
    by_root = bp.groupBy(*FILING, prefix("CD_CONTA", 1).alias("RAIZ")).agg(
        F.sum(F.when(F.col("CD_CONTA").isin("1", "2"), F.col(VALUE)).otherwise(0)).alias("VL_RAIZ"),
        groups.alias("SOMA_GRUPOS"),
    )
    return by_root.withColumn("DIFERENCA", F.col("VL_RAIZ") - F.col("SOMA_GRUPOS"))


def top_divergences(bp: DataFrame, top: int = 5) -> DataFrame:
    """Largest gaps between assets and liabilities."""
    roots = balance_equation(bp.filter(F.col("CD_CONTA").isin("1", "2")), 1.0)
    return (
        roots.filter(F.col("STATUS_EQUACAO") == "DESBALANCEADO")
        .orderBy(F.abs("DIFERENCA").desc(), "CNPJ_CIA", "DT_REFER")
        .limit(top)
    )


def top_reconstructed(df: DataFrame, top: int = 10) -> DataFrame:
    counted = df.groupBy("DT_REFER", "DENOM_CIA").agg(F.count_if("FLAG_RECONSTRUCAO").alias("TOTAL_RECONSTRUIDAS"))
    return counted.orderBy(F.col("TOTAL_RECONSTRUIDAS").desc(), "DT_REFER", "DENOM_CIA").limit(top)


def audit_checklist(df: DataFrame, identity_failures: Column) -> DataFrame:
    """One row per check: what was measured, the limit, and whether it passed.

    ``df`` is a stored curated statement; ``identity_failures`` flags rows that break its arithmetic identity.
    """
    percent = F.lit(100.0) / F.nullif(F.count("*"), F.lit(0))
    measured = df.agg(
        F.count_if(F.col(VALUE).isNull()).cast("double").alias("nulos"),
        F.count_if(identity_failures).cast("double").alias("identidade"),
        (F.count_if(F.col("STATUS_MATH").isin("DESBALANCEADO", "DIVERGENTE")) * percent).alias("status_pct"),
        (F.count_if("FLAG_RECONSTRUCAO") * percent).alias("reconstruidas_pct"),
        F.count_if("IS_LEAF").cast("double").alias("folhas"),
        F.count_if(~F.col("IS_LEAF")).cast("double").alias("sinteticas"),
    )
    long = measured.unpivot([], measured.columns, "TESTE", "MEDIDO")
    duplicates = duplicate_keys(df, [*FILING, "CD_CONTA", "DS_CONTA"], top=None).agg(
        F.count("*").cast("double").alias("MEDIDO")
    )
    rows = long.unionByName(duplicates.select(F.lit("duplicadas").alias("TESTE"), "MEDIDO"))
    limit = F.when(F.col("TESTE") == "status_pct", 5.0).when(F.col("TESTE") == "reconstruidas_pct", 100.0).otherwise(0.0)
    passed = (
        F.when(F.col("TESTE").isin("folhas", "sinteticas"), F.col("MEDIDO") > limit)
        .when(F.col("TESTE") == "reconstruidas_pct", F.col("MEDIDO") < limit)
        .otherwise(F.col("MEDIDO") <= limit)
    )
    return rows.select("TESTE", F.round("MEDIDO", 4).alias("MEDIDO"), limit.alias("LIMITE"), passed.alias("APROVADO"))


# --- input variables --------------------------------------------------------------------------


def variable_spec(spark) -> DataFrame:
    rows = [
        (var, meaning, statement, code, expected)
        for var, meaning, statement, codes, expected in S.VARIABLES
        for code in codes
    ]
    return literal_frame(
        spark,
        rows,
        "VARIAVEL string, CONCEITO string, GRUPO_DFP_TRATADO string, CD_CONTA string, ESPERADO double",
    )


def variable_lines(stacked: DataFrame) -> DataFrame:
    """Lines of the accounts that feed input variables, once per variable."""
    spec = F.broadcast(variable_spec(stacked.sparkSession))
    return stacked.join(spec, ["GRUPO_DFP_TRATADO", "CD_CONTA"])


def variable_catalogue(stacked: DataFrame) -> DataFrame:
    return (
        variable_lines(stacked)
        .groupBy("VARIAVEL", "CD_CONTA", "DS_CONTA", "ST_CONTA_FIXA", "IS_LEAF")
        .agg(
            F.count("*").alias("N_LINHAS"),
            F.count_distinct("CNPJ_CIA").alias("N_EMPRESAS"),
            F.count_distinct("DT_REFER").alias("N_PERIODOS"),
        )
    )


def variable_coverage(stacked: DataFrame) -> DataFrame:
    """Share of companies and of filings that report each input variable, against the expected share.

    One pass for all variables; the universe of a statement is joined from its own one-row-per-statement total.
    """
    counts = [
        F.count_distinct("CNPJ_CIA").alias("EMPRESAS"),
        F.count_distinct("CNPJ_CIA", "DT_REFER").alias("FILINGS"),
    ]
    present = variable_lines(stacked).groupBy("VARIAVEL").agg(*counts)
    universe = stacked.groupBy("GRUPO_DFP_TRATADO").agg(*counts).withColumnsRenamed(
        {"EMPRESAS": "TOTAL_EMPRESAS", "FILINGS": "TOTAL_FILINGS"}
    )
    return coverage_report(present, universe)


def coverage_facts(stacked: DataFrame) -> DataFrame:
    """What is counted: each line for its statement, and for the variables that its account feeds."""
    spec = variable_spec(stacked.sparkSession).groupBy("GRUPO_DFP_TRATADO", "CD_CONTA").agg(F.collect_set("VARIAVEL").alias("_fed"))
    fed = stacked.join(F.broadcast(spec), ["GRUPO_DFP_TRATADO", "CD_CONTA"], "left")
    subject = lambda kind, name: F.struct(F.lit(kind).alias("TIPO"), name.alias("NOME"))
    variables = F.transform(F.coalesce("_fed", F.array().cast("array<string>")), lambda v: subject("VARIAVEL", v))
    counted = F.concat(F.array(subject("GRUPO", F.col("GRUPO_DFP_TRATADO"))), variables)
    return fed.select("CNPJ_CIA", "DT_REFER", F.inline(counted))


def coverage_from_counts(counts: DataFrame) -> DataFrame:
    """The coverage of variables from the counts of their subjects (``coverage.distinct_counts``)."""
    present = counts.filter("TIPO = 'VARIAVEL'").select(F.col("NOME").alias("VARIAVEL"), "EMPRESAS", "FILINGS")
    universe = counts.filter("TIPO = 'GRUPO'").select(
        F.col("NOME").alias("GRUPO_DFP_TRATADO"), F.col("EMPRESAS").alias("TOTAL_EMPRESAS"), F.col("FILINGS").alias("TOTAL_FILINGS")
    )
    return coverage_report(present, universe)


def coverage_report(present: DataFrame, universe: DataFrame) -> DataFrame:
    """The share of a statement's companies and filings that each variable has, against what is expected."""
    spec = variable_spec(present.sparkSession).drop("CD_CONTA").distinct()
    joined = spec.join(universe, "GRUPO_DFP_TRATADO", "left").join(present, "VARIAVEL", "left")
    pct = F.round(F.coalesce("EMPRESAS", F.lit(0)) * 100.0 / F.nullif("TOTAL_EMPRESAS", F.lit(0)), 1)
    pct_ep = F.round(F.coalesce("FILINGS", F.lit(0)) * 100.0 / F.nullif("TOTAL_FILINGS", F.lit(0)), 1)
    return joined.select(
        "VARIAVEL",
        F.coalesce("EMPRESAS", F.lit(0)).alias("EMPRESAS_COM_CONTA"),
        "TOTAL_EMPRESAS",
        pct.alias("PCT_EMPRESAS"),
        pct_ep.alias("PCT_EP"),
        F.when(pct >= F.col("ESPERADO"), "OK").when(pct >= 70, "PARCIAL").otherwise("BAIXA").alias("STATUS"),
    )


def variable_range(stacked: DataFrame) -> DataFrame:
    """Value range of every variable over leaves."""
    leaves = variable_lines(stacked).filter("IS_LEAF").withColumn("_v", F.col(VALUE).cast("double"))
    profile = leaves.groupBy("VARIAVEL").agg(
        F.count("*").alias("N_TOTAL"),
        F.count_if(F.col("_v") == 0).alias("N_ZEROS"),
        F.min("_v").alias("MINIMO"),
        F.max("_v").alias("MAXIMO"),
    )
    return _attach(profile, group_quantiles(leaves, ["VARIAVEL"], "_v", {"MEDIANA": 0.5}), ["VARIAVEL"], "left")


def variable_dictionary(stacked: DataFrame) -> DataFrame:
    """The variables with their meaning, accounts and how much of the ledger they use."""
    used = variable_lines(stacked).groupBy("VARIAVEL").agg(F.count("*").alias("N_LINHAS"))
    spec = variable_spec(stacked.sparkSession).groupBy("VARIAVEL", "CONCEITO", "GRUPO_DFP_TRATADO").agg(
        F.array_join(F.array_sort(F.collect_list("CD_CONTA")), ", ").alias("CONTAS")
    )
    return spec.join(used, "VARIAVEL", "left").withColumn("N_LINHAS", F.coalesce("N_LINHAS", F.lit(0)))


def fallback_origin(dre: DataFrame) -> DataFrame:
    """Where earnings per share come from, per filing with revenue: diluted, basic as fallback, or none.

    One grouping instead of a universe and two left joins.
    """
    usable = ~F.col("FLAG_RECONSTRUCAO") & (F.abs(F.col(VALUE)) <= S.PER_SHARE_LIMIT)

    def seen(code: str, condition: Column = F.lit(True)) -> Column:
        return F.coalesce(F.bool_or((F.col("CD_CONTA") == code) & condition), F.lit(False))

    basic, diluted = S.PER_SHARE_ACCOUNTS
    filings = (
        dre.filter(F.col("CD_CONTA").isin("3.01", basic, diluted))
        .groupBy(*FILING)
        .agg(seen("3.01").alias("_u"), seen(basic, usable).alias("_b"), seen(diluted, usable).alias("_d"))
        .filter("_u")
    )
    origin = F.when(F.col("_d"), "diluido_direto").when(F.col("_b"), "fallback_basico").otherwise("sem_lpa")
    return distribution(filings.withColumn("ORIGEM", origin), ["ORIGEM"])


def mart_quality(mart: DataFrame) -> DataFrame:
    """Counts of suspicious values in the strict mart, and coverage of biological assets."""
    def below_zero(c: str) -> Column:
        return F.count_if(F.col(c) < 0)

    return mart.agg(
        below_zero("LIQ_CORRENTE").alias("LIQ_CORRENTE_NEGATIVA"),
        below_zero("PMRE").alias("PMRE_NEGATIVO"),
        below_zero("PMRV").alias("PMRV_NEGATIVO"),
        below_zero("PMPC").alias("PMPC_NEGATIVO"),
        F.count_if((F.col("PL") < 0) & F.col("ROE").isNotNull()).alias("ROE_COM_PL_NEGATIVO"),
        F.count_if(F.col("LPA").isNull()).alias("LPA_NULO"),
        F.count("AT_BIOLOGICO").alias("LINHAS_COM_BIOLOGICO"),
        F.count_distinct(F.when(F.col("AT_BIOLOGICO").isNotNull(), F.col("CNPJ_CIA"))).alias("EMPRESAS_COM_BIOLOGICO"),
        F.count_if(F.col("AT_BIOLOGICO").isNull()).alias("LINHAS_SEM_BIOLOGICO"),
    )


def missing_periods(tables: dict[str, DataFrame]) -> DataFrame:
    """Fiscal years a company should have (between its first and last year) but lacks, per statement."""
    years = None
    for code, df in tables.items():
        part = df.select("CNPJ_CIA", F.col("DT_FIM_EXERC_ANO").alias("ANO")).distinct().withColumn("DEMONSTRATIVO", F.lit(code))
        years = part if years is None else years.unionByName(part)
    spans = years.groupBy("CNPJ_CIA").agg(F.min("ANO").alias("_a"), F.max("ANO").alias("_b"))
    expected = spans.select("CNPJ_CIA", F.explode(F.sequence("_a", "_b")).alias("ANO")).withColumn(
        "DEMONSTRATIVO", F.explode(F.array(*[F.lit(c) for c in tables]))
    )
    return expected.join(years, ["CNPJ_CIA", "ANO", "DEMONSTRATIVO"], "left_anti")

