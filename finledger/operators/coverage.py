"""Exact distinct counts that merge: which companies report what, as bitmaps over company numbers.

A presence row has a subject (a statement or a variable), a reference date and a stretch of 32,768 company numbers as a
bitmap. The companies of a subject are the bits of its bitmaps put together over the dates, and its filings are the bits
of each date added up: both counts come from one table of small rows, which can be kept by year. New or corrected years
replace their part; nothing else is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finledger.operators.distribution import group_positions
from finledger.sources import tables

SUBJECT, YEAR = ["TIPO", "NOME"], "ANO"
PRESENCE = T.StructType().add("TIPO", T.StringType()).add("NOME", T.StringType()).add("DT_REFER", T.DateType())
PRESENCE = PRESENCE.add("BALDE", T.LongType()).add("MAPA", T.BinaryType()).add(YEAR, T.IntegerType())
NUMBERS = T.StructType().add("CNPJ_CIA", T.StringType()).add("NUMERO", T.LongType())


def company_numbers(known: DataFrame, rows: DataFrame) -> DataFrame:
    """(CNPJ_CIA, NUMERO): the numbers that are ``known``, and the next ones for companies of ``rows`` without one.

    Numbers begin at 1 and have no gaps, so bitmaps are dense. New companies are numbered in order by many tasks.
    """
    new = rows.filter(F.col("CNPJ_CIA").isNotNull()).select("CNPJ_CIA").distinct().join(known, "CNPJ_CIA", "left_anti")
    last = known.agg(F.coalesce(F.max("NUMERO"), F.lit(0))).first()[0]
    placed = group_positions(new.withColumn("_all", F.lit(0)), ["_all"], ["CNPJ_CIA"], "_place")
    return known.unionByName(placed.select("CNPJ_CIA", (F.lit(last) + F.col("_place")).cast("long").alias("NUMERO")))


def presence(facts: DataFrame, numbers: DataFrame) -> DataFrame:
    """Presence rows of ``facts``: rows of subject, CNPJ_CIA and DT_REFER, as often as they come. A row without a company
    or a date is no presence."""
    usable = facts.filter(F.col("DT_REFER").isNotNull()).select(*SUBJECT, "CNPJ_CIA", F.col("DT_REFER").cast("date").alias("DT_REFER"))
    # The distinct rows combine in the tasks that read; a bitmap is built from what is left.
    numbered = usable.distinct().join(numbers, "CNPJ_CIA")
    maps = numbered.groupBy(*SUBJECT, "DT_REFER", F.bitmap_bucket_number("NUMERO").alias("BALDE")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("NUMERO")).alias("MAPA")
    )
    return maps.select(*SUBJECT, "DT_REFER", "BALDE", "MAPA", F.year("DT_REFER").alias(YEAR))


def distinct_counts(maps: DataFrame) -> DataFrame:
    """Companies and filings (company and date) of each subject."""
    merged = maps.groupBy(*SUBJECT, "BALDE").agg(
        F.bitmap_or_agg("MAPA").alias("_all"), F.sum(F.bitmap_count("MAPA")).alias("_filings")
    )
    return merged.groupBy(*SUBJECT).agg(F.sum(F.bitmap_count("_all")).alias("EMPRESAS"), F.sum("_filings").alias("FILINGS"))


def keep(facts: DataFrame, path: str) -> None:
    """Store the presence of ``facts`` by year, and the company numbers, under ``path``."""
    spark = facts.sparkSession
    numbers = company_numbers(spark.createDataFrame([], NUMBERS), facts)
    tables.publish(numbers, f"{path}/empresas")
    tables.publish(presence(facts, tables.published(spark, f"{path}/empresas", NUMBERS)), f"{path}/presenca", by=YEAR)


def refresh(facts: DataFrame, years: list[int], path: str) -> None:
    """Replace the presence of ``years`` with that of ``facts``, which has the whole of these years and of no other.
    Other years are neither read nor written."""
    spark = facts.sparkSession
    known = tables.published(spark, f"{path}/empresas", NUMBERS)
    tables.publish(company_numbers(known, facts), f"{path}/empresas")
    maps = presence(facts, tables.published(spark, f"{path}/empresas", NUMBERS))
    tables.replace_parts(maps, f"{path}/presenca", YEAR, years)


def kept_counts(spark: SparkSession, path: str) -> DataFrame:
    """Companies and filings of each subject, from what is stored."""
    return distinct_counts(tables.published(spark, f"{path}/presenca", PRESENCE, by=YEAR))
