"""A corpus from documents to tokens, stage by stage.

Each stage reads what the one before it wrote, and its decisions take effect:
rejected documents go, one document of each group of near copies stays,
personal data is replaced, sources are mixed, and what is left is encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowhaul.llm import personal
from rowhaul.llm.byte_pairs import encode_texts, token_digests
from rowhaul.llm.frames import documents, written
from rowhaul.llm.mixing import apply_mix
from rowhaul.llm.queries import VOCABULARY
from rowhaul.llm.repetition import repetition_rules
from rowhaul.llm.shingles import near_duplicates


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return repetition_rules(docs).where("kept").select(*docs.columns)


def near_duplicate_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of five-word shingles at 0.8 or more connect: the one with the least id.

    Rows with one id are one document: they stay or go together, unlike texts
    all of them. Of rows with one id and one text the least by the other columns,
    compared in order, stays. Documents without an id stay.
    """
    found = near_duplicates(docs, n=5, num=80, den=100)
    first = found.where("doc_id = component_id").select("doc_id").distinct().withColumnRenamed("doc_id", "_id")
    named = docs.where("doc_id IS NOT NULL")
    several = named.groupBy("doc_id").agg(F.count("*").alias("_rows")).where("_rows > 1").select(F.col("doc_id").alias("_several"))
    kept = named.join(first, F.col("doc_id") == F.col("_id"), "left_semi")
    single = kept.join(several, F.col("doc_id") == F.col("_several"), "left_anti")
    repeated = kept.join(several, F.col("doc_id") == F.col("_several"), "left_semi")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    least = repeated.groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0).alias("_"), *others)).alias("_least"))
    once = least.select(*(c if c in ("doc_id", "text") else F.col(f"_least.{c}").alias(c) for c in docs.columns))
    return single.unionByName(once).unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with each piece of personal data replaced by its kind."""
    columns = [F.col("masked").alias("text") if c == "text" else F.col(c) for c in docs.columns]
    return personal.find_personal(docs, personal.learn(docs)).select(*columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return apply_mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each document with its number of tokens and digests of ids and decoded bytes."""
    return token_digests(encode_texts(docs.select("doc_id", "text"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicate_texts", near_duplicate_texts),
    ("personal_data", personal_data),
    ("mixed_sources", mixed_sources),
    ("tokens", tokens),
]

#: Encoding cannot be said in SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
