"""Metadata operations (H1..H6): registration, approval, change sets.

Metadata rows are small, but the requests and proposals that feed them
can be many; new ids come from ``dense_keys`` (no one-partition sort) and
every check is a join, never a loop on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metamart.operators.keys import dense_keys
from metamart.operators.silver import header_key

DEFAULT_MIN_CONFIDENCE = 0.90


def _next_base(df: DataFrame, id_col: str) -> DataFrame:
    """One row: COALESCE(MAX(id), 0) + 1."""
    return df.agg((F.coalesce(F.max(id_col), F.lit(0)) + 1).cast("bigint").alias("_base"))


@dataclass(frozen=True)
class Registration:
    result: DataFrame        # every request with Status and the new SourceId
    registry_rows: DataFrame
    key_rows: DataFrame


def register_sources(registry: DataFrame, key_map: DataFrame, requests: DataFrame) -> Registration:
    """H1 for a batch of requests (RequestId, SourceName, FilePath,
    SheetName, PlantColumn, MonthColumn): a path already registered -- or
    requested earlier in the batch -- is rejected; accepted requests get
    ids max + 1, max + 2 ... in request order; an id that already has key
    rows is rejected; each accepted request yields one registry row and two
    key rows (Plant text, Month date)."""
    req = requests.withColumns({
        "PlantColumn": F.coalesce(F.col("PlantColumn"), F.lit("Plant")),
        "MonthColumn": F.coalesce(F.col("MonthColumn"), F.lit("Month")),
    })
    # first request per path: an aggregate (partial on the map side), so a
    # path requested very many times is no hot spot
    firsts = req.groupBy("FilePath").agg(F.min("RequestId").alias("_first_id"))
    req = (req.join(firsts, "FilePath")
           .withColumn("_first", F.col("RequestId") == F.col("_first_id")).drop("_first_id"))
    known = req.join(registry.select("FilePath"), "FilePath", "left_semi").select("RequestId")
    req = req.join(known.withColumn("_known", F.lit(True)), "RequestId", "left")
    ok = req.filter(F.col("_first") & F.col("_known").isNull())
    ids = dense_keys(ok, ["RequestId"], key="NewId",
                     start=_next_base(registry, "SourceId").scalar())
    taken = key_map.select(F.col("SourceId").cast("bigint").alias("NewId")).distinct()
    ids = ids.join(taken.withColumn("_taken", F.lit(True)), "NewId", "left")
    status = (F.when(F.col("_known").isNotNull() | ~F.col("_first"), F.lit("path already registered"))
              .when(F.col("_taken").isNotNull(), F.lit("key columns already exist for this id"))
              .otherwise(F.lit("registered")))
    res = (req.join(ids.select("RequestId", "NewId", "_taken"), "RequestId", "left")
           .select("RequestId", "SourceName", "FilePath", "SheetName", "PlantColumn", "MonthColumn",
                   status.alias("Status"),
                   F.when(status == "registered", F.col("NewId").cast("int")).alias("SourceId")))
    return registration_rows(res)


def registration_rows(result: DataFrame) -> Registration:
    """Registry rows and the two key rows (Plant text, Month date) of every
    request whose Status is 'registered'."""
    accepted = result.filter(F.col("Status") == "registered")
    reg = accepted.select("SourceId", "SourceName", "FilePath", "SheetName", F.lit(True).alias("IsActive"))
    keys = accepted.select("SourceId", F.explode(F.array(
        F.struct(F.col("PlantColumn").alias("SourceColumn"), F.lit("Plant").alias("TargetColumn"),
                 F.lit("text").alias("DataType")),
        F.struct(F.col("MonthColumn").alias("SourceColumn"), F.lit("Month").alias("TargetColumn"),
                 F.lit("date").alias("DataType")))).alias("k")).select("SourceId", "k.*")
    return Registration(result, reg, keys)


def latest_proposals(proposals: DataFrame) -> DataFrame:
    """The most recent proposal per (SourceId, SourceColumn); ties by
    confidence, then values.  One aggregate with map-side partials: the queue is
    read once, and a column with very many proposals is no hot spot."""
    pick = F.max_by(F.struct("Classification", "CodeGroup", "Confidence", "ProposedAt"),
                    F.struct("ProposedAt", "Confidence", "Classification", "CodeGroup"))
    return proposals.groupBy("SourceId", "SourceColumn").agg(pick.alias("_pick")).select("SourceId", "SourceColumn", "_pick.*")


def approvable(proposals: DataFrame, mapping: DataFrame, source_ids: Sequence[int] | None = None,
               min_confidence: float = DEFAULT_MIN_CONFIDENCE) -> DataFrame:
    """What an approval would add, without ids: latest proposal per column first, *then* the
    confidence threshold (a newer weak proposal hides an older strong one),
    then not already mapped (active or not)."""
    p = proposals
    if source_ids is not None:
        p = p.filter(F.col("SourceId").isin([int(s) for s in source_ids]))
    latest = latest_proposals(p).filter(F.col("Confidence") >= F.lit(min_confidence))
    mapped = mapping.select("SourceId", header_key().alias("_k"))
    fresh = latest.withColumn("_k", header_key()).join(mapped, ["SourceId", "_k"], "left_anti")
    return fresh.select(F.col("SourceId").cast("int").alias("SourceId"), "SourceColumn", "Classification", "CodeGroup",
                        F.lit(True).alias("IsActive"))


def approve_proposals(proposals: DataFrame, mapping: DataFrame,
                      source_ids: Sequence[int] | None = None,
                      min_confidence: float = DEFAULT_MIN_CONFIDENCE) -> DataFrame:
    """H2: new mapping rows (see ``approvable``); ids continue after the largest
    MappingId in (SourceId, SourceColumn) order.  Running it again with the
    rows added inserts nothing."""
    fresh = approvable(proposals, mapping, source_ids, min_confidence)
    keyed = dense_keys(fresh, ["SourceId", "SourceColumn"],
                       key="MappingId", start=_next_base(mapping, "MappingId").scalar())
    return keyed.select(F.col("MappingId").cast("int"), "SourceId", "SourceColumn", "Classification", "CodeGroup", "IsActive")


def pending_proposals(proposals: DataFrame, mapping: DataFrame) -> DataFrame:
    """Proposals whose column has no mapping row at all."""
    mapped = mapping.select("SourceId", header_key().alias("_k"))
    return (proposals.withColumn("_k", header_key()).join(mapped, ["SourceId", "_k"], "left_anti")
            .drop("_k").orderBy("SourceId", F.desc("Confidence")))


CHANGE_ACTIONS = ("insert", "activate", "deactivate", "delete")


def apply_mapping_changes(mapping: DataFrame, changes: DataFrame) -> DataFrame:
    """H4: apply a change table (MappingId, Action, SourceId, SourceColumn,
    Classification, CodeGroup) -- insert, activate, deactivate, delete by id.
    One full outer join on MappingId; the last change of an id wins when
    ChangeSeq is given."""
    if "ChangeSeq" in changes.columns:
        cols = [c for c in changes.columns if c not in ("MappingId", "ChangeSeq")]
        changes = (changes.groupBy("MappingId")
                   .agg(F.max_by(F.struct(*cols), F.col("ChangeSeq")).alias("_c"))
                   .select("MappingId", "_c.*"))
    c = changes.select("MappingId", "Action",
                       *[F.col(x).alias(f"c_{x}") for x in ("SourceId", "SourceColumn", "Classification", "CodeGroup")])
    j = mapping.join(c, "MappingId", "full")
    a = F.col("Action")
    active = (F.when(a == "activate", F.lit(True)).when(a == "deactivate", F.lit(False))
              .when(a == "insert", F.coalesce(F.col("IsActive"), F.lit(True))).otherwise(F.col("IsActive")))
    out = j.filter(a.isNull() | (a != "delete")).filter(F.col("SourceId").isNotNull() | (a == "insert"))
    return out.select(
        F.col("MappingId").cast("int"),
        F.coalesce("SourceId", "c_SourceId").cast("int").alias("SourceId"),
        F.coalesce("SourceColumn", "c_SourceColumn").alias("SourceColumn"),
        F.coalesce("Classification", "c_Classification").alias("Classification"),
        F.coalesce("CodeGroup", "c_CodeGroup").alias("CodeGroup"),
        active.alias("IsActive"))


def set_active(registry: DataFrame, ids: DataFrame | Sequence[int], flag: bool) -> DataFrame:
    """H5: set IsActive for the given source ids (a list or a frame of
    SourceId); other rows unchanged."""
    if not isinstance(ids, DataFrame):
        hit = F.col("SourceId").isin([int(i) for i in ids])
        return registry.withColumn("IsActive", F.when(hit, F.lit(flag)).otherwise(F.col("IsActive")))
    marks = ids.select(F.col("SourceId").cast("int").alias("SourceId")).distinct().withColumn("_hit", F.lit(True))
    return (registry.join(F.broadcast(marks), "SourceId", "left")
            .withColumn("IsActive", F.when(F.col("_hit"), F.lit(flag)).otherwise(F.col("IsActive")))
            .drop("_hit").select(*registry.columns))


def meta_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """H6: row count per table, stacked."""
    parts = [df.agg(F.lit(name).alias("TableName"), F.count(F.lit(1)).alias("Rows"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
