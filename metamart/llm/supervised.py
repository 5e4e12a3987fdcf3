"""What the trained operators share: labels, held-out rows, the training sample, scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metamart.llm.common import binary_column, small_batches

Scores = Callable[[list[bytes | None]], np.ndarray]


def held_out(doc_id: Column | str, folds: int, fold: int) -> Column:
    """True where crc32(doc_id as text) mod folds = fold; a null id is held out."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % folds == fold, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, rows: int) -> DataFrame:
    """(id, y, text) of at most ``rows`` labelled documents that are not held out,
    taken in the order of a hash of the id, so any order of the table gives the
    same sample.  Rows without a 0/1 label are skipped; of a repeated doc_id the
    smallest text counts, so the rows are bounded too."""
    ids = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("y"))
           .filter("id IS NOT NULL AND y IN (0, 1)").filter(~held_out("id", folds, fold))
           .groupBy("id").agg(F.max("y").alias("y"))
           .orderBy(F.xxhash64("id"), "id").limit(rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    # at most ``rows`` ids: the broadcast is bounded by the parameter
    return (texts.join(F.broadcast(ids), "id").groupBy("id").agg(F.max("y").alias("y"), F.min("text").alias("text"))
            .select("id", "y", "text"))


def scored(docs: DataFrame, make_scores: Callable[[], Scores], folds: int, fold: int) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; only the text reaches the model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make_scores()
        for b in small_batches(batches, 200):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score(binary_column(b, 1)), pa.float64())],
                                             names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (rows.mapInArrow(run, "doc_id long, score double")
            .select("doc_id", held_out("doc_id", folds, fold).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))
