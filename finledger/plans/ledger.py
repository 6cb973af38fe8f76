"""Ledger adapter: the TPC-H-like driver tables read as statement lines and as a company registry.

One ``lineitem`` row is one reported statement line. Everything a line needs is in its own row, so the adapter is a
scan with a projection: no join, no shuffle. Company attributes are joined later, at the grain that needs them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finledger.functions.literals import literal_frame
from finledger.schema import MONEY

# Chart of accounts of the adapter as (code, name, sign, size).
# sign: P positive, C cost, S either way. size: G coarse totals, D detail, E per share.
CHART: list[tuple[str, str, str, str]] = [
    ("1", "Ativo Total", "P", "G"),
    ("1.01", "Ativo Circulante", "P", "G"),
    ("1.01.01", "Caixa e Equivalentes de Caixa", "P", "G"),
    ("1.01.02", "Aplicações Financeiras", "P", "G"),
    ("1.01.02.01", "Aplicações a Valor Justo", "P", "D"),
    ("1.01.02.01.02", "Títulos Designados", "P", "D"),
    ("1.01.03", "Contas a Receber", "P", "D"),
    ("1.01.03.01", "Clientes", "P", "D"),
    ("1.01.04", "Estoques", "P", "D"),
    ("1.01.05", "Ativos Biológicos", "P", "D"),
    ("1.01.06", "Tributos a Recuperar", "P", "D"),
    ("1.01.07", "Despesas Antecipadas", "P", "D"),
    ("1.01.08", "Outros Ativos Circulantes", "P", "D"),
    ("1.02", "Ativo Não Circulante", "P", "G"),
    ("1.02.01", "Ativo Realizável a Longo Prazo", "P", "D"),
    ("1.02.02", "Investimentos", "P", "D"),
    ("1.02.03", "Imobilizado", "P", "D"),
    ("1.02.04", "Intangível", "P", "D"),
    ("2", "Passivo Total", "P", "G"),
    ("2.01", "Passivo Circulante", "P", "G"),
    ("2.01.01", "Obrigações Sociais e Trabalhistas", "P", "D"),
    ("2.01.02", "Fornecedores", "P", "D"),
    ("2.01.03", "Obrigações Fiscais", "P", "D"),
    ("2.01.04", "Empréstimos e Financiamentos", "P", "D"),
    ("2.01.04.01", "Empréstimos", "P", "D"),
    ("2.01.04.01.01", "Em Moeda Nacional", "P", "D"),
    ("2.01.05", "Outras Obrigações", "P", "D"),
    ("2.01.06", "Provisões", "P", "D"),
    ("2.02", "Passivo Não Circulante", "P", "G"),
    ("2.02.01", "Empréstimos de Longo Prazo", "P", "D"),
    ("2.03", "Patrimônio Líquido", "S", "G"),
    ("3.01", "Receita de Venda de Bens", "P", "G"),
    ("3.02", "Custo dos Bens Vendidos", "C", "G"),
    ("3.03", "Resultado Bruto", "S", "G"),
    ("3.04", "Despesas Operacionais", "C", "G"),
    ("3.04.01", "Despesas com Vendas", "C", "D"),
    ("3.04.02", "Despesas Gerais", "C", "D"),
    ("3.04.02.01", "Pessoal", "C", "D"),
    ("3.05", "Resultado Antes do Financeiro", "S", "G"),
    ("3.06", "Resultado Financeiro", "S", "G"),
    ("3.06.01", "Receitas Financeiras", "P", "D"),
    ("3.06.02", "Despesas Financeiras", "C", "D"),
    ("3.11", "Lucro do Período", "S", "G"),
    ("3.99", "Lucro por Ação", "S", "E"),
    ("3.99.01.01", "ON Básico", "S", "E"),
    ("3.99.02.01", "ON Diluído", "S", "E"),
    ("4.01", "Lucro Consolidado do Período", "S", "D"),
    ("5.04", "Transações de Capital", "S", "D"),
    ("6.01", "Caixa Líquido Operacional", "S", "G"),
    ("6.01.01", "Caixa Gerado nas Operações", "S", "D"),
    ("6.01.01.02", "Depreciação", "P", "D"),
    ("6.01.01.03", "Amortização", "P", "D"),
    ("6.01.01.04", "Exaustão", "P", "D"),
    ("6.01.02", "Variações nos Ativos", "S", "D"),
    ("6.02", "Caixa Líquido de Investimento", "C", "G"),
    ("6.02.01", "Aquisição de Imobilizado", "C", "D"),
    ("6.02.02", "Aquisição de Intangível", "C", "D"),
    ("6.02.03", "Outras Aquisições", "C", "D"),
    ("6.03", "Caixa Líquido de Financiamento", "S", "G"),
    ("6.04", "Variação Cambial", "S", "G"),
    ("6.05", "Aumento de Caixa", "S", "G"),
    ("6.05.01", "Saldo Inicial", "P", "G"),
    ("6.05.02", "Saldo Final", "P", "G"),
    ("7.01", "Receitas", "P", "D"),
    ("8.01", "Informações Adicionais", "P", "D"),
]

# Group text by first digit of the account.
GROUP_TEXT: dict[str, str] = {
    "1": "DF Consolidado - Balanço Patrimonial Ativo",
    "2": "DF Consolidado - Balanço Patrimonial Passivo",
    "3": "DF Consolidado - Demonstração do Resultado",
    "4": "DF Consolidado - Demonstração de Resultado Abrangente",
    "5": "DF Consolidado - Demonstração das Mutações do Patrimônio Líquido",
    "6": "DF Consolidado - Demonstração do Fluxo de Caixa (Método Indireto)",
    "7": "DF Consolidado - Demonstração de Valor Adicionado",
    "8": "DF Consolidado - Outras Informações",
}

# Staged table by first digit of the account ('8' lines arrive with the value-added table).
GROUP_TABLE: dict[str, str] = {
    "1": "dfp_cia_aberta_bpa_con",
    "2": "dfp_cia_aberta_bpp_con",
    "3": "dfp_cia_aberta_dre_con",
    "4": "dfp_cia_aberta_dra_con",
    "5": "dfp_cia_aberta_dmpl_con",
    "6": "dfp_cia_aberta_dfc_mi_con",
    "7": "dfp_cia_aberta_dva_con",
    "8": "dfp_cia_aberta_dva_con",
}

# Sectors that the registry gives to some nations; the others get 'Setor <nation>'.
NATION_SECTOR: dict[int, str | None] = {
    0: "Bancos",
    1: "Seguradoras e Corretoras",
    2: "Securitização de Recebíveis",
    3: "Emp. Adm. Part. - Sem Setor Principal",
    4: "Intermediação Financeira",
    5: "Emp. Adm. de Imóveis",
    6: None,
    7: "Agricultura (Açúcar, Álcool e Cana)",
    8: "Comércio, Importação e Exportação de Bens de Consumo Duráveis",
}

# Grid of coarse totals. A prime, so that ratios of totals do not end on a rounding tie.
GRID = 9973


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_count(spark: SparkSession, sf_dir: str) -> int:
    """Number of raw statement lines, from the footers of the files."""
    return read_table(spark, sf_dir, "lineitem").count()


def scanned(df: DataFrame, *keys: str) -> DataFrame:
    """A source table in ``spark.finledger.scanPartitions`` parts, where a session sets that.

    For deployments whose files have fewer row groups than there are cores; unset, the scan stays as the files are.
    """
    parts = df.sparkSession.conf.get("spark.finledger.scanPartitions", None)
    return df.repartition(int(parts), *keys) if parts else df


def _chart_frame(spark: SparkSession) -> DataFrame:
    """The chart with the spellings of names and groups that companies use, so that a line only picks one."""
    rows = [
        (
            i,
            code,
            [name.upper(), f"{name} ", f"Outros {name}", name, name],
            [f" {GROUP_TEXT[code[0]].upper()} ", GROUP_TEXT[code[0]], GROUP_TEXT[code[0]]],
            GROUP_TABLE[code[0]],
            *{"P": (1, -1), "C": (1, 0), "S": (16 if code == "2.03" else 4, 0)}[sign],
            *{"D": (1.0, 0.0, 0.0), "G": (1.0, 1.0, 0.0), "E": (0.0, 0.0, 1.0)}[size],
            len(code) <= 7,
        )
        for i, (code, name, sign, size) in enumerate(CHART)
    ]
    return literal_frame(
        spark,
        rows,
        "ACCT int, CD_CONTA string, NAMES array<string>, GROUPS array<string>, TABLE_NAME string,"
        " EACH int, REST int, W_PRICE double, W_GRID double, W_SHARE double, FIXED boolean",
    )


def _value() -> Column:
    """Reported value: the price, the price cut to the grid, or an amount per share; negative for some lines.

    The chart carries the weights and the sign rule, so this is arithmetic without branches. It is copied into
    every filter on the value, which a long CASE would make too large to compile well.
    """
    price = F.col("l_extendedprice")
    per_share = F.col("l_quantity") * (F.col("l_discount") - F.lit(0.05))
    per_share = per_share * F.when(F.col("l_partkey") % 97 == 0, 10000000.0).otherwise(1.0)
    size = price * F.col("W_PRICE") - (price % F.lit(float(GRID))) * F.col("W_GRID") + per_share * F.col("W_SHARE")
    sign = F.when(F.col("l_partkey") % F.col("EACH") == F.col("REST"), -1.0).otherwise(1.0)
    return (size * sign).cast(MONEY)


def statement_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw statement lines, one per ``lineitem`` row, in the layout of a filing extract."""
    items = scanned(read_table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber").withColumn(
        "ACCT", ((F.col("l_partkey") * 7 + F.col("l_linenumber") * 3 + F.col("l_orderkey")) % len(CHART)).cast("int")
    )
    # The chart is a literal of len(CHART) rows, so broadcasting it is bounded by this file.
    lines = items.join(F.broadcast(_chart_frame(spark)), "ACCT").withColumn("_year", F.year("l_shipdate"))
    interim = (F.col("l_returnflag") == "R") & (F.month("l_shipdate") <= 6)
    lines = lines.withColumn(
        "DT_REFER",
        F.make_date("_year", F.when(interim, 6).otherwise(12), F.when(interim, 30).otherwise(31)),
    ).withColumn("CNPJ_CIA", F.lpad(F.col("l_suppkey").cast("string"), 14, "0"))
    part = F.col("l_partkey")
    return lines.select(
        "CNPJ_CIA",
        F.concat(F.lit("Supplier#"), F.right("CNPJ_CIA", F.lit(9))).alias("DENOM_CIA"),
        (F.col("l_suppkey") + 1000).cast("int").alias("CD_CVM"),
        "DT_REFER",
        F.col("DT_REFER").alias("DT_FIM_EXERC"),
        F.when(F.col("l_orderkey") % 5 < 3, 10).when(F.col("l_orderkey") % 5 == 3, 9).otherwise(8).alias("VERSAO"),
        F.get("GROUPS", (part % 3).cast("int")).alias("GRUPO_DFP"),
        F.lit("REAL").alias("MOEDA"),
        F.when((F.col("l_suppkey") + F.col("_year")) % 3 == 0, "UNIDADE")
        .when(F.col("l_linenumber") % 2 == 1, " mil ")
        .otherwise("MIL")
        .alias("ESCALA_MOEDA"),
        F.when(F.col("l_quantity") > 45, "PENÚLTIMO").otherwise("ÚLTIMO").alias("ORDEM_EXERC"),
        "CD_CONTA",
        F.get("NAMES", (part % 5).cast("int")).alias("DS_CONTA"),
        _value().alias("VL_CONTA"),
        F.when(F.col("FIXED") == (part % 11 != 0), "S").otherwise("N").alias("ST_CONTA_FIXA"),
        F.when(
            F.col("CD_CONTA").startswith("5"),
            F.when(part % 2 == 0, "Patrimônio Líquido Consolidado").otherwise("Capital Social"),
        ).alias("COLUNA_DF"),
        "TABLE_NAME",
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("LINE_ID"),
        part.alias("LINE_SEQ"),
    )


# Total order of lines inside a key: newest version and date first, then the line's own identity (trap T5).
NEWEST_FIRST = ["VERSAO", "DT_REFER", "LINE_ID", "LINE_SEQ", "VL_CONTA"]


def _sector(nation_key: Column, nation_name: Column) -> Column:
    sector = F.concat(F.lit("Setor "), nation_name)
    for key, label in NATION_SECTOR.items():
        sector = F.when(nation_key == key, F.lit(label).cast("string")).otherwise(sector)
    return sector


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company registry: suppliers file statements, customers are registered without filing any.

    Some suppliers appear twice with an older record, as registries do (trap T7).
    """
    nations = read_table(spark, sf_dir, "nation").select(
        "n_nationkey", "n_regionkey", _sector(F.col("n_nationkey"), F.col("n_name")).alias("SETOR_ATIV")
    )
    suppliers = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("k"),
        F.col("s_name").alias("DENOM_SOCIAL"),
        F.col("s_nationkey").alias("n_nationkey"),
        F.col("s_acctbal").alias("bal"),
    )
    customers = read_table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 90000000000000).alias("k"),
        F.col("c_name").alias("DENOM_SOCIAL"),
        F.col("c_nationkey").alias("n_nationkey"),
        F.col("c_acctbal").alias("bal"),
    )
    newest = suppliers.unionByName(customers).withColumn("REG_SEQ", F.lit(2))
    older = suppliers.filter(F.col("k") % 7 == 0).withColumn("REG_SEQ", F.lit(1))
    return newest.unionByName(older).join(nations, "n_nationkey").select(
        F.lpad(F.col("k").cast("string"), 14, "0").alias("CNPJ_CIA"),
        "DENOM_SOCIAL",
        F.when(F.col("bal") >= 0, "ATIVO").otherwise("CANCELADO(A)").alias("SIT"),
        F.when(F.col("k") % 10 != 7, "BOLSA").otherwise("BALCÃO").alias("TP_MERC"),
        F.when(F.col("k") % 13 != 5, "FASE OPERACIONAL").otherwise("EM RECUPERAÇÃO JUDICIAL").alias("SIT_EMISSOR"),
        "SETOR_ATIV",
        F.concat(F.lit("UF"), F.col("n_regionkey").cast("string")).alias("UF"),
        F.when(F.col("k") % 4 == 0, "ESTATAL").when(F.col("k") % 4 == 1, "ESTRANGEIRO").otherwise("PRIVADO")
        .alias("CONTROLE_ACIONARIO"),
        F.when(F.col("k") % 3 == 0, "Categoria B").otherwise("Categoria A").alias("CATEG_REG"),
        "REG_SEQ",
    )
