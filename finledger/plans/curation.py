"""From consolidated lines to the curated statement tables (balance sheet, income, cash flow)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finledger import schema as S
from finledger.operators.hierarchy import FILING, collapse_accounts, mark_global_leaves, roll_up, tree_size
from finledger.operators.naming import account_dictionary, name_accounts
from finledger.operators.rows import fill_gaps, newest_first, newest_row
from finledger.session import materialise


@dataclass(frozen=True)
class Statement:
    """How one statement is repaired."""

    code: str
    rule: str
    lowest_child_level: int
    one_line_per_account: bool
    root_label: str | None = None


STATEMENTS = {
    "BP": Statement("BP", "safe", 2, one_line_per_account=False),
    "DRE": Statement("DRE", "force", 3, one_line_per_account=True),
    "DFC": Statement("DFC", "safe", 3, one_line_per_account=False, root_label=S.CASH_FLOW_ROOT_LABEL),
}

LINE_ORDER = ("VERSAO", "LINE_ID", "LINE_SEQ", "VL_CONTA_TRATADO")


def statement_extract(consolidated: DataFrame, statement: Statement) -> DataFrame:
    """Deduplicated lines of one statement.

    Income accounts keep their newest line. Balance and cash lines keep every different name or value of a code,
    because companies do report two lines under one code; the collapse adds them.
    """
    lines = consolidated.filter(F.col("GRUPO_DFP_TRATADO") == statement.code)
    keys = [*FILING, "CD_CONTA"] if statement.one_line_per_account else [*FILING, "CD_CONTA", "DS_CONTA", "VL_CONTA_TRATADO"]
    return newest_row(lines, keys, newest_first(*LINE_ORDER))


def _order() -> Column:
    return F.struct(*LINE_ORDER)


def collapsed_statement(extract: DataFrame) -> DataFrame:
    """One row per account, with the newest reported name, flag and filing metadata taken along in one shuffle."""
    newest = F.struct(
        "DS_CONTA", "ST_CONTA_FIXA", "VERSAO", "DT_FIM_EXERC_TRATADO", "DT_FIM_EXERC_ANO", "CD_CVM", "SETOR_ATIV"
    )
    return collapse_accounts(extract, {"REPORTADO": F.max_by(newest, _order())})


def repaired_statement(
    extract: DataFrame,
    statement: Statement,
    deepest: int | None = None,
    placed: bool = False,
    rows: int | None = None,
    reported: Column | None = None,
) -> DataFrame:
    """The repaired statement. ``REPORTADO`` is what ``collapsed_statement`` takes along, or a narrower aggregate where the
    reader needs less: every level sorts it again."""
    collapsed = collapsed_statement(extract) if reported is None else collapse_accounts(extract, {"REPORTADO": reported})
    return roll_up(collapsed, statement.rule, statement.lowest_child_level, deepest, carry=["REPORTADO"], placed=placed, rows=rows)


def balance_status(assets: Column, liabilities: Column) -> Column:
    return (
        F.when((assets == 0) & (liabilities == 0), "ZERADO")
        .when(F.abs(assets - liabilities) <= 1.0, "OK")
        .otherwise("DESBALANCEADO")
    )


def _account_total(code: str, filing) -> Column:
    return F.sum(F.when(F.col("CD_CONTA") == code, F.col("VL_CONTA_TRATADO"))).over(filing)


def status_column(statement: Statement) -> Column:
    """``STATUS_MATH`` of a filing, as windows over the filing the rows are already grouped by."""
    filing = Window.partitionBy(*FILING)
    if statement.code == "BP":
        assets, liabilities = _account_total("1", filing), _account_total("2", filing)
        status = balance_status(F.coalesce(assets, F.lit(0)), F.coalesce(liabilities, F.lit(0)))
        return F.when(assets.isNull() & liabilities.isNull(), "ERRO_ESTRUTURA").otherwise(status)
    if statement.code == "DFC":
        flows = [F.coalesce(_account_total(c, filing), F.lit(0)) for c in ("6.01", "6.02", "6.03", "6.04")]
        change = F.coalesce(_account_total("6.05", filing), F.lit(0))
        seen = F.bool_or(F.col("CD_CONTA").isin("6.01", "6.02", "6.03", "6.04", "6.05")).over(filing)
        difference = flows[0] + flows[1] + flows[2] + flows[3] - change
        return (
            F.when(~seen, "OK")
            .when(change == 0, "SEM_TOTALIZADOR")
            .when(F.abs(difference) <= 1.0, "OK")
            .otherwise("DIVERGENTE")
        )
    return F.lit("NAO_APLICAVEL")


def to_golden_schema(df: DataFrame) -> DataFrame:
    """The 29 shared columns in their order; missing ones become NULL, flags False, status not applicable."""
    if "STATUS_MATH" not in df.columns:
        for other in ("STATUS_BALANCO", "STATUS_DFC"):
            if other in df.columns:
                df = df.withColumnRenamed(other, "STATUS_MATH")
    defaults = {"STATUS_MATH": F.lit("NAO_APLICAVEL"), "FLAG_NORMALIZACAO": F.lit(False), "FLAG_RECONSTRUCAO": F.lit(False)}
    columns = []
    for name, type_ in S.GOLDEN_COLUMNS:
        if name in df.columns:
            value = F.coalesce(F.col(name), defaults[name]) if name in defaults else F.col(name)
        else:
            value = defaults.get(name, F.lit(None))
        columns.append(value.cast(type_).alias(name))
    return df.select(*columns)


def curate(consolidated: DataFrame, code: str, leaf_scope: str = "table") -> DataFrame:
    """One statement in the golden schema: repaired, named, labelled, flagged and with its arithmetic status.

    The deduplicated extract is written once: the dictionary of account codes, the metadata and the repair read it. The
    dictionary is written too; its measured size lets the planner broadcast it, or shuffle it if it is large. Metadata
    that a filing lacks comes from the company's neighbouring dates.
    """
    statement = STATEMENTS[code]
    extract = materialise(statement_extract(consolidated, statement), f"extract_{code}")
    dictionary = materialise(
        account_dictionary(extract, code, statement.lowest_child_level - 1, statement.root_label), f"accounts_{code}"
    )
    deepest, lines = tree_size(extract)
    spoken = F.max_by(F.struct("DS_CONTA", "ST_CONTA_FIXA"), _order())
    repaired = repaired_statement(extract, statement, deepest, rows=lines, reported=spoken)
    metadata = filing_metadata(extract).withColumnsRenamed({c: f"_{c}" for c in METADATA})
    placed = repaired.withColumn("STATUS_MATH", status_column(statement)).join(metadata, FILING, "left")
    rows = placed.select(
        *FILING,
        "CD_CONTA",
        "CD_CONTA_QTD_DIGITOS",
        "VL_CONTA_TRATADO",
        F.coalesce("DENOM_CIA", "_DENOM_CIA").alias("DENOM_CIA"),
        "STATUS_MATH",
        F.col("REPORTADO.DS_CONTA").alias("DS_CONTA_REPORTADA"),
        F.col("REPORTADO.ST_CONTA_FIXA").alias("ST_CONTA_FIXA_REPORTADA"),
        F.coalesce("_VERSAO", F.lit(1)).alias("VERSAO"),
        *[F.col(f"_{c}").alias(c) for c in METADATA if c not in ("VERSAO", "DENOM_CIA")],
    )
    rows = name_accounts(rows, dictionary)
    if leaf_scope == "entity":
        rows = mark_global_leaves(rows.drop("IS_LEAF"), "entity")
    return to_golden_schema(
        rows.withColumns(
            {
                "DT_REFER_TRATADO": F.col("DT_REFER"),
                "DT_REFER_ANO": F.year("DT_REFER"),
                "GRUPO_DFP_TRATADO": F.lit(code),
                "CONTA_NOME_COMPLETO": F.concat_ws(" - ", "CD_CONTA", "DS_CONTA"),
                "_origem_tabela": F.lit(f"layer_02_silver.n0_dfp_cia_aberta ({code})"),
            }
        )
    )


# What ``repaired_values`` reads of the consolidated lines.
VALUE_COLUMNS = [
    *FILING, "DENOM_CIA", "GRUPO_DFP_TRATADO", "CD_CONTA", "CD_CONTA_QTD_DIGITOS", "DS_CONTA", "VL_CONTA_TRATADO", "VERSAO",
    "LINE_ID", "LINE_SEQ",
]


def repaired_values(
    consolidated: DataFrame, code: str, deepest: int | None = None, placed: bool = False, rows: int | None = None
) -> DataFrame:
    """Repaired balances of a statement without names: all that marts and arithmetic audits need.

    ``deepest``, with ``rows``, a bound on the lines, spares a look at the codes of ``consolidated`` where it is not a
    stored table; lines that are ``placed`` come from a table stored by filing.
    """
    statement = STATEMENTS[code]
    if deepest is None:
        deepest, rows = tree_size(consolidated.filter(F.col("GRUPO_DFP_TRATADO") == code))
    # Of what was reported, only whether it was is asked for.
    extract = statement_extract(consolidated, statement)
    repaired = repaired_statement(extract, statement, deepest, placed, rows, reported=F.max(F.lit(True)))
    return repaired.select(
        *FILING,
        "DENOM_CIA",
        "CD_CONTA",
        F.col("VL_CONTA_TRATADO").cast("double").alias("VL_CONTA_TRATADO"),
        F.col("REPORTADO").isNull().alias("FLAG_RECONSTRUCAO"),
        "ACAO",
    )


METADATA = ["VERSAO", "DENOM_CIA", "CD_CVM", "DT_FIM_EXERC_TRATADO", "DT_FIM_EXERC_ANO", "SETOR_ATIV"]


def filing_metadata(consolidated: DataFrame) -> DataFrame:
    """Newest metadata per entity and date, gaps filled from the company's neighbouring dates."""
    newest = newest_row(consolidated, FILING, newest_first(*LINE_ORDER)).select(*FILING, *METADATA)
    return fill_gaps(newest, "CNPJ_CIA", "DT_REFER", ["SETOR_ATIV", "CD_CVM", "DENOM_CIA"])


def curated_tables(consolidated: DataFrame) -> dict[str, DataFrame]:
    """All statements. Their dictionaries are small independent jobs, so they are submitted together."""
    with ThreadPoolExecutor(len(STATEMENTS)) as pool:
        return dict(zip(STATEMENTS, pool.map(lambda code: curate(consolidated, code), STATEMENTS)))
