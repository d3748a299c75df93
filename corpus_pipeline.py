"""Corpus pipeline: language, near copies, repeated passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's docs. All but the last keep the
columns of docs, whatever they are, and work on every row they are given.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.llm import jaccard_join, language, packing, personal_data, suffix_dedup
from larder.llm.common import bloom, keep, parted, read_table, small_batches


def _same_columns(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, with n_chars (where there is one) counting the text as it is now."""
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return out.select(*docs.columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is recognised; those without text or letters, mostly of unknown n-grams, or called hardly above chance, go."""
    small_batches(spark)
    return language.accepted(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the least id stays (once, where rows repeat).

    Documents without an id cannot be grouped and stay. Where different texts share
    an id, each of them is a document of its own.
    """
    small_batches(spark)
    named = docs.filter(F.col("doc_id").isNotNull())
    text = F.xxhash64("text", F.col("text").isNull())
    again = named.groupBy("doc_id").agg(F.count("*").alias("rows"), F.min(text).alias("low"), F.max(text).alias("high")).filter("rows > 1")
    again = keep(again, "again")
    if again.filter("low <> high").isEmpty():
        rows, mark = named, "doc_id"
    else:  # ids do not tell documents apart
        mark = f"mark-{uuid.uuid4().hex}"
        rows = named.withColumn(mark, F.xxhash64("doc_id", "text", F.col("text").isNull()))
        again = rows.groupBy(mark).count().filter("count > 1")
    groups = jaccard_join.join(rows.select(F.col(mark).alias("doc_id"), "text")).select(F.col("doc_id").alias("key"), "component_id")
    moved = keep(groups.filter("key <> component_id"), "groups")
    gone = moved.select("key")
    if mark != "doc_id":  # the least id, not the least mark, stays
        members = moved.unionByName(moved.select(F.col("component_id").alias("key"), "component_id").distinct())
        members = keep(members.join(rows.select(F.col(mark).alias("key"), "doc_id").distinct(), "key"), "members")
        heads = members.groupBy("component_id").agg(F.min(F.struct("doc_id", "key")).getField("key").alias("key"))
        gone = keep(members.select("key").join(heads, "key", "left_anti"), "gone")
    # texts move only where a document may have to go
    doubtful, sure = parted(rows, mark, bloom(keep(gone.unionByName(again.select(F.col(mark).alias("key"))), "doubtful")))
    chosen = doubtful.join(gone.withColumnRenamed("key", mark), mark, "left_anti").dropDuplicates([mark])
    return sure.select(*docs.columns).unionByName(chosen.select(*docs.columns)).unionByName(docs.filter(F.col("doc_id").isNull()))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 400 bytes or more that repeat across the corpus."""
    small_batches(spark)
    return _same_columns(suffix_dedup.deduplicated(docs), docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return _same_columns(personal_data.redact(docs), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document in sequences of 1024 tokens."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", known_language),
    ("near_copies", one_of_near_copies),
    ("suffix_dedup", without_repeats),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: Fitted models and merges of whole texts are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
