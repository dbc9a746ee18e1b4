"""The ``opN_<name>`` queries: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import documents
from tessera.llm.embedding_links import embedding_links
from tessera.llm.near_duplicates import near_duplicate_classes
from tessera.llm.oracle import OP3, OP11, OP12
from tessera.llm.packing import pack
from tessera.llm.phrase_collocations import collocations
from tessera.llm.quality_classifier import quality_scores
from tessera.llm.quality_rules import quality_rules
from tessera.llm.secret_scan import scan_secrets
from tessera.llm.sentence_pieces import encode_digests
from tessera.llm.sharding import shard_documents
from tessera.llm.spelling_variants import spelling_variants
from tessera.llm.suffix_dedup import remove_repeats
from tessera.llm.token_counts import token_counts
from tessera.llm.toxicity import toxicity


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))


def op2_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "host_rejected", "kept")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_scores(documents(spark, sf_dir), labels).drop("raw")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(documents(spark, sf_dir))


def op6_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op7_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(documents(spark, sf_dir))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(documents(spark, sf_dir))


def op9_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).drop("kept_text")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


LLM_QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_label_propagation_shards, op3_quality_rules, op4_quality_classifier,
    op5_secret_scan, op6_retrieval_packing, op7_sentence_pieces, op8_near_duplicates,
    op9_embedding_links, op10_suffix_dedup, op11_spelling_variants,
    op12_phrase_collocations, op13_toxicity)}

LLM_ORACLE_SQL: dict[str, str] = {
    "op3_quality_rules": OP3, "op11_spelling_variants": OP11, "op12_phrase_collocations": OP12}
