"""Mapping proposals around a model's answers (N1..N7).

The model call itself is outside the engine: its answers arrive as a table
(SourceId, ModelName, ResponseText).  Everything here stays distributed.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from metamart.operators.silver import active_mapping, unmapped_columns as _unmapped

ANSWER_SCHEMA = StructType([StructField("mappings", ArrayType(StructType([
    StructField("source_column", StringType()),
    StructField("classification", StringType()),
    StructField("code_group", StringType()),
    StructField("confidence", DoubleType()),
    StructField("rationale", StringType()),
])))])


def candidates(pairs: DataFrame, mapping: DataFrame) -> DataFrame:
    """Arrived columns of each source without an active mapping, sorted."""
    return _unmapped(pairs, mapping).orderBy("SourceID", "SourceColumn")


def vocabulary(mapping: DataFrame) -> DataFrame:
    """Allowed classifications and code groups (over all active
    mappings of all sources), as (Kind, Value) rows."""
    m = active_mapping(mapping)
    return (m.select(F.lit("Classification").alias("Kind"), F.col("Classification").alias("Value")).distinct()
            .unionByName(m.select(F.lit("CodeGroup").alias("Kind"), F.col("CodeGroup").alias("Value")).distinct()))


def examples(mapping: DataFrame) -> DataFrame:
    """Every active (column, classification, code group)."""
    return active_mapping(mapping).select("SourceColumn", "Classification", "CodeGroup")


def parse_proposals(responses: DataFrame) -> DataFrame:
    """Text between the first '{' and the last '}', read as JSON, its
    ``mappings`` exploded.  Text without JSON yields no rows, never an error."""
    doc = F.regexp_extract(F.col("ResponseText"), r"(?s)\{.*\}", 0)
    parsed = responses.withColumn("_j", F.from_json(F.nullif(doc, F.lit("")), ANSWER_SCHEMA))
    return (parsed.select("SourceId", "ModelName", F.explode("_j.mappings").alias("m"))
            .select("SourceId", "ModelName",
                    F.col("m.source_column").alias("SourceColumn"),
                    F.col("m.classification").alias("Classification"),
                    F.col("m.code_group").alias("CodeGroup"),
                    F.col("m.confidence").alias("Confidence"),
                    F.col("m.rationale").alias("Rationale")))


def valid_proposals(p: DataFrame, vocab: DataFrame) -> DataFrame:
    """Keep proposals whose classification AND code group are allowed.
    The column is not checked against the candidates (an invented header
    passes), as in the reference."""
    cls = vocab.filter(F.col("Kind") == "Classification").select(F.col("Value").alias("Classification"))
    grp = vocab.filter(F.col("Kind") == "CodeGroup").select(F.col("Value").alias("CodeGroup"))
    return (p.join(F.broadcast(cls), "Classification", "left_semi")
            .join(F.broadcast(grp), "CodeGroup", "left_semi"))


def proposal_stats(p: DataFrame, vocab: DataFrame) -> DataFrame:
    """Per source, proposals received, valid, rejected, and dropped for
    lacking a source column."""
    cls = vocab.filter(F.col("Kind") == "Classification").select(F.col("Value").alias("_c"), F.lit(True).alias("_okc"))
    grp = vocab.filter(F.col("Kind") == "CodeGroup").select(F.col("Value").alias("_g"), F.lit(True).alias("_okg"))
    j = (p.join(F.broadcast(cls), p.Classification == cls._c, "left")
         .join(F.broadcast(grp), p.CodeGroup == grp._g, "left"))
    ok = F.col("_okc").isNotNull() & F.col("_okg").isNotNull()
    return j.groupBy("SourceId").agg(
        F.count(F.lit(1)).alias("Proposed"),
        F.count_if(ok).alias("Valid"),
        F.count_if(~ok).alias("Rejected"),
        F.count_if(ok & F.col("SourceColumn").isNull()).alias("NoColumn"))


def to_queue(p: DataFrame, now: datetime) -> DataFrame:
    """Queue rows -- confidence default 0, rationale default '', one
    timestamp for the whole run; rows without a source column are dropped."""
    return p.filter(F.col("SourceColumn").isNotNull()).select(
        F.col("SourceId").cast("int"), "SourceColumn", "Classification", "CodeGroup",
        F.coalesce(F.col("Confidence").cast("double"), F.lit(0.0)).alias("Confidence"),
        F.coalesce(F.col("Rationale"), F.lit("")).alias("Rationale"),
        "ModelName",
        F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp").alias("ProposedAt"))
