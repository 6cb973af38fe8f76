"""Helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str | Column, parts: int) -> Column:
    """The fold of a row: CRC-32 of its key as text, modulo ``parts``; a missing key is in fold 0."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts, F.lit(0))


SPACE = 1 << 31


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, training: Column, bound: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """At most ``bound`` labelled texts (``text``, ``label``) of the training rows: those of the smallest key hashes.

    ``training`` is a condition on ``key``. The hash order makes the sample the same in every run and independent of the
    layout of the files. Of many labels only those under a hash that leaves half as much again as the bound are put in
    order, and they are cut before the join, so what one task orders and what is broadcast is bounded by ``bound``. A key
    with two labels is sampled with both; of several texts of a key the smallest counts.
    """
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(SPACE))
    usable = labels.select(F.col(key), F.col(label).cast("int").alias("label"), place.alias("_place"))
    usable = usable.filter(F.col("label").isin(0, 1) & F.col(key).isNotNull() & training).distinct()
    found = usable.count()
    if found > 2 * bound:
        usable = usable.filter(F.col("_place") < int(1.5 * SPACE * bound / found))
    picked = usable.orderBy("_place", key, "label").limit(bound).select(key, "label")
    texts = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(picked), key)
    return joined.groupBy(key, "label").agg(F.min("text").alias("text")).select("text", "label")
