"""Registry filters and the normalisation of raw statement lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finledger import schema as S
from finledger.functions.expressions import ancestors, digits, scaled_value, statement_class
from finledger.operators.rows import latest_filing, newest_first, newest_row
from finledger.session import materialise


def _sector_text() -> Column:
    # A missing sector matches no pattern, so the company stays in (trap T3).
    return F.coalesce(F.col("SETOR_ATIV"), F.lit(""))


def eligibility_steps(exclude_real_estate: bool = True) -> list[tuple[str, Column]]:
    """The predicates of an eligible company, in the order of the funnel."""
    steps = [(f"{column} = {value}", F.col(column) == value) for column, value in S.ELIGIBLE_STATUS]
    patterns = S.EXCLUDED_SECTORS + ([S.EXCLUDED_REAL_ESTATE] if exclude_real_estate else [])
    steps += [(f"sector not like {p}", ~_sector_text().like(p)) for p in patterns]
    return steps


def eligible_entities(registry: DataFrame, exclude_real_estate: bool = True) -> DataFrame:
    """Companies that pass every predicate, one row each (the newest registry record, trap T7)."""
    keep = reduce(lambda a, b: a & b, [p for _, p in eligibility_steps(exclude_real_estate)])
    return newest_row(registry.filter(keep), ["CNPJ_CIA"], newest_first("REG_SEQ"))


def filter_funnel(registry: DataFrame, exclude_real_estate: bool = False) -> DataFrame:
    """Rows left and rows dropped after each cumulative predicate, in one pass over the registry."""
    steps = eligibility_steps(exclude_real_estate)
    counters, passed = [F.count("*").alias("s0")], F.lit(True)
    for i, (_, predicate) in enumerate(steps, start=1):
        passed = passed & predicate
        counters.append(F.count_if(passed).alias(f"s{i}"))
    labels = ["all"] + [label for label, _ in steps]
    rows = [
        F.struct(
            F.lit(i).alias("PASSO"),
            F.lit(label).alias("FILTRO"),
            F.col(f"s{i}").alias("N"),
            (F.col(f"s{max(i - 1, 0)}") - F.col(f"s{i}")).alias("EXCLUIDAS"),
        )
        for i, label in enumerate(labels)
    ]
    return registry.agg(*counters).select(F.inline(F.array(*rows)))


def excluded_by_group(registry: DataFrame) -> DataFrame:
    """Listed, active and operating companies that a sector pattern excludes, counted by sector."""
    status = reduce(lambda a, b: a & b, [F.col(c) == v for c, v in S.ELIGIBLE_STATUS])
    excluded = reduce(lambda a, b: a | b, [_sector_text().like(p) for p in S.EXCLUDED_SECTORS])
    return registry.filter(status & excluded).groupBy("SETOR_ATIV").agg(F.count("*").alias("QTD"))


def normalise_lines(lines: DataFrame) -> DataFrame:
    """Typed lines with scaled value, statement class, depth and fiscal year. A narrow projection."""
    # Group and scale are cleaned once, in their own projection, because the rules below test them repeatedly.
    cleaned = lines.withColumns({"_group": F.upper(F.trim("GRUPO_DFP")), "_scale": F.upper(F.trim("ESCALA_MOEDA"))})
    return cleaned.withColumns(
        {
            "DT_REFER_TRATADO": F.col("DT_REFER").cast("date"),
            "DT_REFER_ANO": F.year("DT_REFER"),
            "DT_FIM_EXERC_TRATADO": F.col("DT_FIM_EXERC").cast("date"),
            "DT_FIM_EXERC_ANO": F.year("DT_FIM_EXERC"),
            "GRUPO_DFP_TRATADO": statement_class("_group"),
            "CD_CONTA_QTD_DIGITOS": digits("CD_CONTA"),
            "VL_CONTA_TRATADO": scaled_value("CD_CONTA", "_scale", "VL_CONTA"),
        }
    ).drop("_group", "_scale")


def current_period(lines: DataFrame, extra: Column | None = None) -> DataFrame:
    """Lines of the latest exercise, optionally narrowed by one more predicate."""
    kept = lines.filter(F.col("ORDEM_EXERC") == "ÚLTIMO")
    return kept if extra is None else kept.filter(extra)


def equity_total_only(lines: DataFrame) -> DataFrame:
    """The equity-changes table holds one line per column; only its consolidated total is a balance."""
    total = F.col("COLUNA_DF").ilike(S.CONSOLIDATED_EQUITY)
    return lines.filter(~F.col("TABLE_NAME").contains("dmpl") | F.coalesce(total, F.lit(False)))


def mark_leaves(df: DataFrame) -> DataFrame:
    """``IS_LEAF``: no other account with a value in the same filing lies below this one."""
    filing = ["CNPJ_CIA", "DT_REFER", "VERSAO"]
    parents = (
        df.filter(F.col("VL_CONTA_TRATADO") != 0)
        .select(*filing, F.explode(ancestors("CD_CONTA")).alias("CD_CONTA"))
        .distinct()
        .withColumn("_parent", F.lit(True))
    )
    return df.join(parents, [*filing, "CD_CONTA"], "left").withColumn("IS_LEAF", F.col("_parent").isNull()).drop("_parent")


CONSOLIDATED_COLUMNS = [
    "CNPJ_CIA",
    "DT_REFER",
    "DT_REFER_TRATADO",
    "DT_REFER_ANO",
    "VERSAO",
    "DENOM_CIA",
    "CD_CVM",
    "GRUPO_DFP",
    "GRUPO_DFP_TRATADO",
    "MOEDA",
    "ESCALA_MOEDA",
    "ORDEM_EXERC",
    "DT_FIM_EXERC",
    "DT_FIM_EXERC_TRATADO",
    "DT_FIM_EXERC_ANO",
    "CD_CONTA",
    "CD_CONTA_QTD_DIGITOS",
    "DS_CONTA",
    "VL_CONTA",
    "VL_CONTA_TRATADO",
    "ST_CONTA_FIXA",
    "SETOR_ATIV",
    "_origem_tabela",
    "LINE_ID",
    "LINE_SEQ",
]


def newest_lines(lines: DataFrame, registry: DataFrame, placed: bool = False) -> DataFrame:
    """Newest filing of every eligible company per source table, non-zero values only. Lines that are ``placed`` are
    stored by company and date.

    All source tables go through one pass; the newest version is chosen per table, as each is filed on its own. The
    eligible companies are written first: their measured size decides whether they filter the lines by a broadcast,
    before anything is shuffled, or by a shuffled join. Store the result: curation and the leaf flags read it more
    than once.
    """
    eligible = materialise(
        eligible_entities(registry, exclude_real_estate=False).select("CNPJ_CIA", "SETOR_ATIV"), "eligible"
    )
    listed = current_period(equity_total_only(lines)).join(eligible, "CNPJ_CIA")
    newest = latest_filing(listed, ["TABLE_NAME", "CNPJ_CIA", "DT_REFER"], placed=placed)
    # Derived columns come after the shuffle of the filings: they are not carried through it, nor worked out for
    # lines that an older version loses.
    tagged = newest.withColumn("_origem_tabela", F.concat(F.lit("layer_01_bronze."), F.col("TABLE_NAME")))
    return normalise_lines(tagged).filter(F.col("VL_CONTA_TRATADO") != 0).select(*CONSOLIDATED_COLUMNS)


def consolidated_lines(newest: DataFrame) -> DataFrame:
    """The consolidated table: stored newest lines with their leaf flag."""
    return mark_leaves(newest)
