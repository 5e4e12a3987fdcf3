"""Registered queries of the subpackage: each takes (spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from metamart.llm import bpe, decontaminate, embedding_dedup, line_dedup, minhash_dedup, mixing, prefix_trie, quality, sentence_dedup, suffix_dedup, tokens, toxicity, whitening
from metamart.llm.common import read_table, scratch_path
from metamart.llm.oracle import ORACLE_SQL  # noqa: F401 - the entry reads both tables here


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op8_sentence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_dedup.removals(read_table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.toxicity_scores(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.removals(read_table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(read_table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removals(read_table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(read_table(spark, sf_dir, "documents"), path)
    return tokens.digests(spark, path)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.nodes(read_table(spark, sf_dir, "conversations"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_line_dedup": op2_line_dedup,
    "op3_mix_sources": op3_mix_sources,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_token_output": op6_token_output,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_sentence_dedup": op8_sentence_dedup,
    "op9_decontaminate": op9_decontaminate,
    "op10_minhash_dedup": op10_minhash_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_bpe": op12_bpe,
    "op13_whitening": op13_whitening,
}


