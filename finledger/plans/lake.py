"""The tables of the lake, built from a folder of driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finledger.operators.hierarchy import FILING
from finledger.operators.normalise import current_period, newest_lines, normalise_lines
from finledger.operators.rows import newest_first, newest_row
from finledger.plans import ledger
from finledger.plans.curation import VALUE_COLUMNS, curate, curated_tables, repaired_values
from finledger.plans.mart import mart_from_lines, simple_mart
from finledger.session import materialise, stored_by


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.statement_lines(spark, sf_dir)


def typed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_lines(raw_lines(spark, sf_dir))


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One registry record per company."""
    return newest_row(ledger.registry(spark, sf_dir), ["CNPJ_CIA"], newest_first("REG_SEQ"))


# Source tables that hold a statement.
STATEMENT_TABLES = {
    "BP": [ledger.GROUP_TABLE["1"], ledger.GROUP_TABLE["2"]],
    "DRE": [ledger.GROUP_TABLE["3"]],
    "DFC": [ledger.GROUP_TABLE["6"]],
}


def chart_depth(code: str) -> int:
    """Levels of a statement's accounts, by the chart that these lines are reported in: no look at the lines."""
    return max(account.count(".") + 1 for account, *_ in ledger.CHART if ledger.GROUP_TABLE[account[0]] in STATEMENT_TABLES[code])


def statement_lines(spark: SparkSession, sf_dir: str, code: str) -> DataFrame:
    """Newest lines of one statement, for a single reader: nothing is written, and other tables are not read past the
    scan. The newest filing is chosen per source table, so the choice of tables commutes with it."""
    raw = raw_lines(spark, sf_dir).filter(F.col("TABLE_NAME").isin(STATEMENT_TABLES[code]))
    return newest_lines(raw, ledger.registry(spark, sf_dir))


def repaired(spark: SparkSession, sf_dir: str, code: str) -> DataFrame:
    """Repaired balances of one statement, from the scan in one pass."""
    return repaired_values(statement_lines(spark, sf_dir, code), code, chart_depth(code), rows=ledger.line_count(spark, sf_dir))


def repaired_below(spark: SparkSession, sf_dir: str, code: str, accounts: list[str]) -> DataFrame:
    """Repaired balances of some accounts and those below them, from the scan in one pass. What happens to an account
    depends on the accounts below it alone, so no other line is needed; accounts above are left out."""
    below = F.lit(False)
    for account in accounts:
        below = below | (F.col("CD_CONTA") == account) | F.col("CD_CONTA").startswith(f"{account}.")
    lines = statement_lines(spark, sf_dir, code).filter(below)
    return repaired_values(lines, code, chart_depth(code)).filter(below)


def bronze_by_filing(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> DataFrame:
    """Raw lines stored by company and date: choosing the newest filing, dropping repeated lines, adding up accounts and
    repairing the tree then go without an exchange."""
    return stored_by(raw_lines(spark, sf_dir), FILING, "bronze", buckets)


def repaired_in_place(bronze: DataFrame, registry: DataFrame, code: str) -> DataFrame:
    """Repaired balances of one statement from lines stored by filing."""
    lines = bronze.filter(F.col("TABLE_NAME").isin(STATEMENT_TABLES[code]))
    return repaired_values(newest_lines(lines, registry, placed=True), code, chart_depth(code), placed=True)


def repaired_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repaired balances of all statements with their statement, without names: what counts of accounts need."""
    lines, out = silver_lines(spark, sf_dir, VALUE_COLUMNS), None
    for code in STATEMENT_TABLES:
        part = repaired_values(lines, code).withColumn("GRUPO_DFP_TRATADO", F.lit(code))
        out = part if out is None else out.unionByName(part)
    return out


def silver_lines(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """Stored newest lines of eligible companies, laid out by statement so that curation reads only its part. Where readers
    need only some ``columns``, the others are not shuffled or written."""
    newest = newest_lines(raw_lines(spark, sf_dir), ledger.registry(spark, sf_dir))
    return materialise(newest.select(columns or newest.columns), "silver_lines", by="GRUPO_DFP_TRATADO")


def curated(spark: SparkSession, sf_dir: str, code: str, leaf_scope: str = "table") -> DataFrame:
    return curate(statement_lines(spark, sf_dir, code), code, leaf_scope)


def curated_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return curated_tables(silver_lines(spark, sf_dir))


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict mart of the current lines, with the registry's sector."""
    lines = normalise_lines(current_period(raw_lines(spark, sf_dir)))
    return mart_from_lines(lines, companies(spark, sf_dir))


def stored_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict mart as a stored table, for consumers that read it more than once."""
    return materialise(mart(spark, sf_dir), "mart")


def simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The simple mart over the repaired statements."""
    lines = silver_lines(spark, sf_dir, VALUE_COLUMNS)
    bp, dre, dfc = (repaired_values(lines, code) for code in ("BP", "DRE", "DFC"))
    return simple_mart(bp, dre, dfc, companies(spark, sf_dir))
