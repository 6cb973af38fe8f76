"""The registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finledger.llm import bpe, decontaminate, linededup, packing, phrases, preference, quality, repair, secrets, simhash, toxicity, urls, vptree
from finledger.llm.common import fold, table

BPE_FILE = "byte_bpe_multi_50k.tiktoken"
PACKING_FILES = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")


def quality_model(spark: SparkSession, sf_dir: str) -> quality.QualityModel:
    training = fold("doc_id", 5) != 0
    return quality.fit_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), training)


def op1_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_quality(table(spark, sf_dir, "documents"), quality_model(spark, sf_dir))
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op2_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coder = bpe.ByteBpe(spark, public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)
    return bpe.digests(bpe.tokenised(table(spark, sf_dir, "documents"), coder))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold("doc_id", 3) == 1
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.preference_segments(*preference.swapped_replies(table(spark, sf_dir, "conversations")))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs, report=True)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"), part_at_base=True)
    counts = [secrets.count_of("base", k).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secrets.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(F.concat("base", "added")).alias("spans"),
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.top_collocations(phrases.collocations(table(spark, sf_dir, "documents")))


def op12_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = [public_tokenizers.path(f) for f in PACKING_FILES]
    pieces = packing.packed_sequences(table(spark, sf_dir, "documents"), *files, public_tokenizers.PATTERN)
    crc = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    rows = repair.damaged(conversations)
    return repair.report(conversations, rows, repair.edited(rows))


QUERIES = {
    "op1_quality_ranking": op1_quality_ranking,
    "op2_benchmark_leaks": op2_benchmark_leaks,
    "op3_nearest": op3_nearest,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_toxicity": op5_toxicity,
    "op6_preference_pairs": op6_preference_pairs,
    "op7_url_filter": op7_url_filter,
    "op8_line_dedup": op8_line_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_simhash": op10_simhash,
    "op11_collocations": op11_collocations,
    "op12_retrieval_packing": op12_retrieval_packing,
    "op13_turn_repair": op13_turn_repair,
}
