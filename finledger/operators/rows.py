"""Choosing rows: newest per key, latest filing, modal value, latest non-null, gap filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``. ``order`` should be total.

    The planner turns ``row_number() = 1`` into a group limit on the map side, so a key that holds a large share of
    the table sends one row per map task through the shuffle.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def newest_first(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def latest_filing(df: DataFrame, keys: list[str], version: str = "VERSAO", placed: bool = False) -> DataFrame:
    """All rows of the highest version per key.

    A window would put a whole key into one task. The maximum combines on the map side and the semi join is one that
    adaptive execution can split, so a key of any size is fine. Rows that are ``placed``, stored by some of the keys, are
    in one task already: there a window needs no exchange.
    """
    if placed:
        newest = F.max(version).over(Window.partitionBy(*keys))
        return df.withColumn("_newest", newest).filter(F.col(version) == F.col("_newest")).drop("_newest")
    latest = df.groupBy(*keys).agg(F.max(version).alias(version))
    return df.join(latest, [*keys, version], "left_semi")


def modal_value(df: DataFrame, key: str, value: str) -> DataFrame:
    """Most frequent non-NULL ``value`` per ``key``; ties go to the smaller value."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("_freq"))
    return newest_row(counted, [key], [F.col("_freq").desc(), F.col(value).asc()]).drop("_freq")


def latest_non_null(df: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """Per key, each column's value in its own latest row where it is present."""
    picks = [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns
    ]
    return df.groupBy(key).agg(F.max(order).alias(order), *picks)


def fill_gaps(df: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """Missing values per key from the row before, else from the row after.

    Meant for one row per ``(key, order)``; both fills stay inside the key (trap T9).
    """
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy(key).orderBy(order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return df.withColumns(
        {
            c: F.coalesce(F.last(c, ignorenulls=True).over(before), F.first(c, ignorenulls=True).over(after))
            for c in columns
        }
    )
