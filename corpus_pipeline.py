"""A corpus pipeline: documents in, token ids out. Each stage works on what the one before it kept, written and reread.

1. quality ranking      documents below the cut go
2. line dedup           blocks of lines that an earlier document holds are cut out
3. SimHash near-dedup   one document of each component stays
4. decontamination      documents that hold a benchmark item go
5. byte-level BPE       packed token ids with the digests of their round trip

The first four return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finledger.llm import bpe, decontaminate, linededup, quality, simhash
from finledger.llm.common import fold, table
from finledger.llm.queries import BPE_FILE
from finledger.session import materialise


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return quality.keep_quality(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_per_component(docs, shingle=3, max_bits=3)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, packed ids, their number, and digests; the decoded bytes' digest equals that of the text."""
    coder = bpe.ByteBpe(spark, public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)
    both = docs.select("doc_id", coder.round_trip("text").alias("both")).select("doc_id", "both.*")
    return both.select(
        "doc_id",
        "ids",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", simhash_stage),
    ("decontamination", decontamination_stage),
    ("tokens", token_stage),
]

# Ranking, fingerprints, alignment and byte-pair merges are beyond SQL; the tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
