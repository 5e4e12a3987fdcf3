"""Connected components over a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metamart.llm.common import materialize


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, root) for every id that has a link; root is the smallest id
    reachable.  ``links`` has two long columns in any order of ends.

    Alternating star contraction: every id hands its larger neighbours to its
    smallest neighbour, then its smaller neighbours to the smallest of them.
    Minima are partial aggregates, so a hub with many links is no hot task;
    every round is written to shared storage.  Ends when a round changes
    nothing (logarithmic in the number of ids)."""
    a, b = links.columns
    edges = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .filter("u <> v").distinct())
    edges = materialize(edges, "links")
    seen = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # larger neighbours move to the smallest neighbour
        large = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v"))
        # own smaller neighbours (and the id itself) move to the smallest of them
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct("u", F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").filter("u <> v").distinct())
        edges = materialize(small, "star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components: links still move after {max_rounds} rounds")
    return edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("root"))
