"""Canonical account names and fixed flags, and the traceability of what was reported."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finledger import schema as S
from finledger.functions.expressions import ancestors, segments
from finledger.functions.literals import literal_frame
from finledger.operators.hierarchy import level_labels


def spoken_names(lines: DataFrame) -> DataFrame:
    """How often each name and fixed flag was reported per account code: the ledger reduced to its vocabulary."""
    return lines.groupBy("CD_CONTA", F.upper(F.trim("DS_CONTA")).alias("DS_CONTA"), "ST_CONTA_FIXA").agg(
        F.count("*").alias("N")
    )


def account_vocabulary(lines: DataFrame, statement: str | None = None) -> DataFrame:
    """Canonical name and fixed flag per account code, for both in one grouping.

    The most frequent value is the smallest pair of negated count and value, so ties go to the smaller value.
    """
    spoken = spoken_names(lines)
    counted = spoken.groupingSets(
        [[F.col("CD_CONTA"), F.col("DS_CONTA")], [F.col("CD_CONTA"), F.col("ST_CONTA_FIXA")]],
        "CD_CONTA",
        "DS_CONTA",
        "ST_CONTA_FIXA",
    ).agg((-F.sum("N")).alias("_rank"))

    def most_frequent(value: str):
        return F.min(F.when(F.col(value).isNotNull(), F.struct("_rank", value)))[value]

    modal = counted.groupBy("CD_CONTA").agg(
        most_frequent("DS_CONTA").alias("_modal"),
        most_frequent("ST_CONTA_FIXA").alias("_flag"),
        F.lit(True).alias("_reported"),
    )
    fixed = literal_frame(
        lines.sparkSession, list(S.FIXED_NAMES.get(statement, {}).items()), "CD_CONTA string, _fixed string"
    )
    return modal.join(fixed, "CD_CONTA", "full").select(
        "CD_CONTA",
        F.coalesce("_fixed", "_modal").alias("_name"),
        "_flag",
        F.coalesce("_reported", F.lit(False)).alias("_reported"),
    )


def golden_names(lines: DataFrame, statement: str | None = None) -> DataFrame:
    """Canonical name per account code: the most frequent reported one, unless the taxonomy fixes it."""
    named = account_vocabulary(lines, statement).filter(F.col("_name").isNotNull())
    return named.select("CD_CONTA", F.col("_name").alias("DS_CONTA"))


def golden_flags(lines: DataFrame) -> DataFrame:
    """Most frequent fixed-account flag per code."""
    flagged = account_vocabulary(lines).filter(F.col("_flag").isNotNull())
    return flagged.select("CD_CONTA", F.col("_flag").alias("ST_CONTA_FIXA"))


def account_dictionary(lines: DataFrame, statement: str, lowest_level: int, root: str | None = None) -> DataFrame:
    """Everything that depends on the account code alone, one row per code of the repaired table.

    Name, fixed flag, leaf flag and level labels are worked out here, on the vocabulary, and joined to the ledger
    once. Codes that only the repair inserts (ancestors of reported ones) are part of the dictionary.
    """
    vocabulary = account_vocabulary(lines, statement)
    prefixes = F.explode(F.concat(ancestors("CD_CONTA"), F.array("CD_CONTA")))
    codes = (
        vocabulary.filter("_reported")
        .select(F.col("CD_CONTA").alias("_code"), prefixes.alias("CD_CONTA"))
        .groupBy("CD_CONTA")
        .agg(
            F.bool_or(F.col("_code") != F.col("CD_CONTA")).alias("_parent"),
            F.bool_or(F.col("_code") == F.col("CD_CONTA")).alias("_own"),
        )
        .filter(F.col("_own") | (segments("CD_CONTA") >= lowest_level))
    )
    return (
        level_labels(codes, vocabulary.withColumnRenamed("_name", "DS_CONTA"), root=root)
        .join(vocabulary.drop("_reported"), "CD_CONTA", "left")
        .join(codes.select("CD_CONTA", "_parent"), "CD_CONTA")
        .withColumn("IS_LEAF", ~F.col("_parent") & (segments("CD_CONTA") > 1))
        .drop("_parent")
    )


def name_accounts(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Final names and flags, and whether a line was rebuilt or renamed.

    Expects ``DS_CONTA_REPORTADA`` and ``ST_CONTA_FIXA_REPORTADA``; a line without a reported name was rebuilt.
    """
    named = df.join(dictionary, "CD_CONTA", "left")
    final = F.coalesce(
        F.col("_name"), F.col("DS_CONTA_REPORTADA"), F.concat(F.lit(S.REBUILT_PREFIX), F.col("CD_CONTA"))
    )
    rebuilt = F.col("DS_CONTA_REPORTADA").isNull()
    renamed = F.upper(F.trim(final)) != F.upper(F.trim(F.coalesce("DS_CONTA_REPORTADA", F.lit(""))))
    return named.withColumns(
        {
            "DS_CONTA": final,
            "ST_CONTA_FIXA": F.coalesce("_flag", F.lit("S")),
            "FLAG_RECONSTRUCAO": rebuilt,
            "FLAG_NORMALIZACAO": renamed & ~rebuilt,
        }
    ).drop("_name", "_flag")
