"""From raw documents to token files, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes each stage's result as Parquet below the shared folder and
rereads it, so a lost executor never costs more than the running stage.

1. quality   documents that the quality classifier rejects go
2. dedup     one document of every group of near-duplicates stays
3. leaks     documents that hold a benchmark passage go
4. mix       all documents, their rows in the order of the mix
5. tokens    token files in that order; one row per document: its id, its place
             in the token stream, its token count and the checksum of its ids
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from metamart.llm import decontaminate, minhash_dedup, mixing, quality, tokens
from metamart.llm.common import file_place, read_table, scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.drop_rejected(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.drop_near_duplicates(docs)


def leaks_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The order of the mix is that of the files and rows of the previous
    stage; documents that come from no file are ordered by doc_id."""
    try:
        docs = docs.select("doc_id", "text", file_place("_metadata.file_name").alias("file"), "_metadata.row_index")
        order: tuple[str, ...] = ("file", "row_index")
    except AnalysisException:
        order = ("doc_id",)
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(docs, path, order=order)
    return tokens.digests(spark, path)


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", dedup_stage),
    ("benchmark decontamination", leaks_stage),
    ("mixing sources to target weights", mix_stage),
    ("token-ID / binary output", tokens_stage),
]

# a trained classifier and a tokenizer are not SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"stage{i + 1}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
