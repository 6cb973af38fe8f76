"""How results are reported: exact money with two decimals, ratios with six."""

from __future__ import annotations

from pyspark.sql import DataFrame

from finledger.functions.expressions import money, rounded


def report(df: DataFrame, money_columns: list[str] = (), ratio_columns: list[str] = (), places: int = 6) -> DataFrame:
    changes = {c: money(c) for c in money_columns} | {c: rounded(c, places) for c in ratio_columns}
    return df.withColumns(changes) if changes else df
