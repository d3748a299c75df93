"""Queries that apply the corpus operators to their whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from larder.llm import byte_pairs, divergence, fingerprints, html_text, jaccard_join, language, neighbours, packing, personal_data, quality_rules, spelling, substring_dedup, suffix_dedup
from larder.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_pairs(read_table(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(read_table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return byte_pairs.encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(read_table(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.report(read_table(spark, sf_dir, "documents"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read_table(spark, sf_dir, "embeddings"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(read_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read_table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    return {
        "op1_html_text": op1_html_text,
        "op2_fingerprints": op2_fingerprints,
        "op3_jaccard_join": op3_jaccard_join,
        "op4_byte_bpe": op4_byte_bpe,
        "op5_suffix_dedup": op5_suffix_dedup,
        "op6_personal_data": op6_personal_data,
        "op7_neighbours": op7_neighbours,
        "op8_packing": op8_packing,
        "op9_substring_dedup": op9_substring_dedup,
        "op10_language_id": op10_language_id,
        "op11_source_divergence": op11_source_divergence,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_quality_rules": op13_quality_rules,
    }


def oracle_sql() -> dict[str, str]:
    return {"op11_source_divergence": divergence.ORACLE_SQL, "op12_spelling_variants": spelling.ORACLE_SQL}
