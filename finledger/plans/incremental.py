"""The strict mart kept up to date: only company-years that new, corrected or withdrawn filings touch are worked out anew.

What is stored is the first-order mart, a row for each company and year, with a fingerprint of the lines behind it. An
update takes the fingerprints of the lines as they are now, one combining aggregation over a few columns, and compares:
a company-year that appeared, changed or went is touched. Its lines alone are ranked and pivoted, and only the buckets
of companies that have one are written; they replace the old ones in one step. Ratios are a projection over the stored
rows, and the scissors effect looks back over a company's years, so both are worked out as the mart is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finledger.plans import mart
from finledger.session import materialise
from finledger.sources import tables

BUCKET, LINES, PRINT = "_balde", "_linhas", "_impressao"
BUCKETS = 64
# What a first-order row depends on.
CONTENT = [
    "GRUPO_DFP_TRATADO", "CD_CONTA", "VERSAO", "DT_REFER", "LINE_ID", "LINE_SEQ", "VL_CONTA", "VL_CONTA_TRATADO", "DENOM_CIA",
    "CD_CVM", "SETOR_ATIV",
]


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("CNPJ_CIA"), F.lit(buckets)).cast("int").alias(BUCKET)


def fingerprints(lines: DataFrame) -> DataFrame:
    """A row for each company and year: the number of its lines, and a sum over their hashes that their order, and how
    they lie in files, do not change. The same line twice is another fingerprint than once."""
    content = [c for c in CONTENT if c in lines.columns]
    line = F.xxhash64(*content).cast("decimal(20,0)")
    return lines.groupBy(*mart.KEYS).agg(F.count("*").alias(LINES), F.sum(line).cast("decimal(38,0)").alias(PRINT))


def _first_order(lines: DataFrame, prints: DataFrame, buckets: int) -> DataFrame:
    rows = mart.account_pivot(mart.newest_balances(lines)).join(prints, mart.KEYS)
    return rows.withColumn(BUCKET, _bucket(buckets))


def touched(stored: DataFrame, now: DataFrame) -> DataFrame:
    """(CNPJ_CIA, ANO_FISCAL, SITUACAO) of the company-years that appeared, changed or went."""
    old = stored.select(*mart.KEYS, F.col(LINES).alias("_n"), F.col(PRINT).alias("_p"))
    both = old.join(now, mart.KEYS, "full")
    state = F.when(F.col("_n").isNull(), "NOVO").when(F.col(LINES).isNull(), "RETIRADO").otherwise("ALTERADO")
    changed = ~(F.col("_n").eqNullSafe(F.col(LINES)) & F.col("_p").eqNullSafe(F.col(PRINT)))
    return both.filter(changed).select(*mart.KEYS, state.alias("SITUACAO"))


def _schema(lines: DataFrame, buckets: int) -> T.StructType:
    usable = mart.mart_lines(lines)
    return _first_order(usable, fingerprints(usable), buckets).schema


def build(lines: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Publish the first-order mart of normalised lines."""
    usable = mart.mart_lines(lines)
    tables.publish(_first_order(usable, fingerprints(usable), buckets), path, by=BUCKET)


def update(lines: DataFrame, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Bring the stored mart to the lines as they are now; returns the company-years that were touched.

    It does not matter what happened to the lines, nor whether an earlier update broke off: what is stored is compared
    with what is there. Nothing is written where nothing changed.
    """
    spark, schema = lines.sparkSession, _schema(lines, buckets)
    usable = mart.mart_lines(lines)
    prints = materialise(fingerprints(usable), "fingerprints")
    changes = materialise(touched(tables.published(spark, path, schema, by=BUCKET), prints), "touched")
    # At most as many values as there are buckets.
    values = sorted(r[BUCKET] for r in changes.select(_bucket(buckets)).distinct().collect())
    if values:
        keys = changes.select(*mart.KEYS)
        kept = tables.published(spark, path, schema, BUCKET, values).join(keys, mart.KEYS, "left_anti")
        fresh = _first_order(usable.join(keys, mart.KEYS, "left_semi"), prints, buckets)
        tables.replace_parts(kept.unionByName(fresh), path, BUCKET, values)
    return changes


def read(spark: SparkSession, path: str, schema: T.StructType, companies: DataFrame | None = None) -> DataFrame:
    """The strict mart from what is stored; ``schema`` is that of the first-order mart (``first_order_schema``)."""
    first = tables.published(spark, path, schema, by=BUCKET).drop(BUCKET, LINES, PRINT)
    return mart.indicator_mart(first if companies is None else mart.with_sector(first, companies))


def first_order_schema(lines: DataFrame, buckets: int = BUCKETS) -> T.StructType:
    """The schema of the stored table, from the plan alone."""
    return _schema(lines, buckets)
