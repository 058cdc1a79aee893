"""The operators of this folder as queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowhaul.llm import oracle, personal
from rowhaul.llm.byte_pairs import encode_texts, token_digests
from rowhaul.llm.centroids import cluster_vectors
from rowhaul.llm.frames import documents
from rowhaul.llm.language import identify, learn
from rowhaul.llm.lines import drop_frequent_lines
from rowhaul.llm.mixing import mix
from rowhaul.llm.repetition import RESULT as REPETITION
from rowhaul.llm.repetition import repetition_rules
from rowhaul.llm.resampling import importance_sample
from rowhaul.llm.sharding import shard
from rowhaul.llm.shingles import near_duplicates
from rowhaul.llm.substrings import drop_repeated_windows
from rowhaul.llm.variants import spelling_variants
from rowhaul.llm.vectors import near_vectors

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_windows(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op2_semi_markov_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = personal.find_personal(docs, personal.learn(docs))
    return found.select("doc_id", *(f"n_{k}" for k in personal.KINDS), F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_sample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from four of five folds by checksum of the id; predicts all documents."""
    docs = documents(spark, sf_dir)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = learn(docs.where(fold != 0))
    out = identify(docs, model)
    return out.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op5_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", *(f.name for f in REPETITION))


def op6_collision_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir))


def op8_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source")


def op9_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op10_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return token_digests(encode_texts(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN))


def op11_gram_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))


def op12_plane_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_frequent_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_repeated_windows, op2_semi_markov_spans, op3_importance_resampling, op4_string_kernel_language, op5_repetition_rules, op6_collision_vectors,
        op7_ring_shards, op8_weighted_mix, op9_shingle_join, op10_byte_pairs, op11_gram_variants, op12_plane_clusters, op13_line_runs,
    )
}
ORACLE: dict[str, str] = {
    "op1_repeated_windows": oracle.REPEATED_WINDOWS, "op9_shingle_join": oracle.SHINGLE_JOIN, "op11_gram_variants": oracle.SPELLING_VARIANTS,
    "op12_plane_clusters": oracle.CLUSTERS, "op13_line_runs": oracle.FREQUENT_LINES,
}
