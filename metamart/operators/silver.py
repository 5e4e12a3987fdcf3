"""Silver = bronze joined to the active column mappings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def header_key(c: str = "SourceColumn") -> F.Column:
    """A header as compared with another: trailing blanks do not count (the
    source system's string equality pads with blanks); bronze headers are
    trimmed already, mapping rows are stored as typed."""
    return F.rtrim(F.col(c))


def active_mapping(mapping: DataFrame) -> DataFrame:
    """Active mappings keyed like bronze (SourceID bigint, SourceColumn)."""
    return (mapping.filter(F.col("IsActive"))
            .select(F.col("SourceId").cast("bigint").alias("SourceID"),
                    header_key().alias("SourceColumn"), "Classification", "CodeGroup"))


def silver(bronze: DataFrame, mapping: DataFrame) -> DataFrame:
    """Plant, Month, Classification, CodeGroup, Incidents.

    Unmapped rows vanish; duplicate active mappings fan out.  The mapping is
    metadata (a few rows per source): the optimizer broadcasts it on its
    size estimate, so bronze is never shuffled for this join.
    """
    return (bronze.join(active_mapping(mapping), ["SourceID", "SourceColumn"], "inner")
            .select("Plant", "Month", "Classification", "CodeGroup",
                    F.col("Value").alias("Incidents")))


def column_pairs(bronze: DataFrame) -> DataFrame:
    """Distinct (SourceID, SourceColumn) pairs that arrived."""
    return bronze.select("SourceID", "SourceColumn").distinct()


def unmapped_columns(pairs: DataFrame, mapping: DataFrame) -> DataFrame:
    """Arrived columns with no active mapping; a NULL header counts too."""
    m = active_mapping(mapping).select("SourceID", "SourceColumn")
    return pairs.select("SourceID", "SourceColumn").join(m, ["SourceID", "SourceColumn"], "left_anti")


def missing_columns(pairs: DataFrame, mapping: DataFrame,
                    source_ids: Sequence[int] | None = None) -> DataFrame:
    """Active mappings (of the given sources) for which no bronze row arrived.
    Duplicate mappings are kept (they count twice)."""
    m = active_mapping(mapping)
    if source_ids is not None:
        m = m.filter(F.col("SourceID").isin([int(s) for s in source_ids]))
    return (m.select("SourceID", "SourceColumn")
            .join(pairs.select("SourceID", "SourceColumn"), ["SourceID", "SourceColumn"], "left_anti"))
