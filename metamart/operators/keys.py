"""Dense surrogate keys over a global order without a one-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE_ROWS = 500_000             # rows a range, about
_WITHIN = (1 << 33) - 1          # the part of a running id that counts inside its partition


def dense_keys(df: DataFrame, order_by: Sequence[str], key: str = "Key",
               start: Column | int = 1) -> DataFrame:
    """``row_number() OVER (ORDER BY order_by)`` (+ start - 1), ascending with
    NULLs first, for a set of any size.

    The input is written once (``spark.checkpoint.dir``) and computed once; all that
    follows reads what was written.  Its rows go to sorted ranges, as many as the row
    count asks for, and are numbered inside their range; the numbers are written with
    the rows, so that the sampled bounds of the ranges play no part in what is read
    later.  The counts of the ranges before (a row a range) give the offsets.
    ``order_by`` must be a total order for the keys to be deterministic.
    """
    rows = df.checkpoint(eager=True)
    ranges = max(1, -(-rows.count() // RANGE_ROWS))
    base = start if isinstance(start, Column) else F.lit(int(start))
    position = F.monotonically_increasing_id().bitwiseAND(F.lit(_WITHIN))
    if ranges == 1:
        return (rows.repartition(1).sortWithinPartitions(*order_by)
                .withColumn(key, (position + base).cast("bigint")))
    placed = (rows.repartitionByRange(ranges, *order_by).sortWithinPartitions(*order_by)
              .withColumns({"_part": F.spark_partition_id(), "_pos": position}).checkpoint(eager=True))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    return (placed.join(offsets, "_part").withColumn(key, (F.col("_off") + F.col("_pos") + base).cast("bigint"))
            .drop("_part", "_pos", "_off"))
