"""Repeated runs of lines or sentences: found globally, removed but for the first.

Shared by line dedup (op2) and substring dedup (op8).  Executors cut whole
texts into units, hash the shortest sufficient run that begins and the one that
ends at every unit, and emit one row per run.  One aggregate finds the runs that occur more than once and the smallest
doc_id that has each; a join marks the other occurrences; the units that any of
them covers are merged per document and removed from the text.

A hot run (a third of all rows) is a partial aggregate and a join whose skewed
side the adaptive planner splits.  A document's rows never exceed twice its units.
Every unit of a longer repeated run is in one of the two, so the runs cover it to
both its ends.

Order: the first occurrence is that of the smallest doc_id, there the first
place.  A run that repeats within its first document keeps its first place
whole, also where the two overlap.

Defined results: null and empty texts have no units; rows without a doc_id
neither give nor lose a run; rows with one doc_id are one document.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metamart.llm.common import binary_column, list_array, materialize, small_batches


@dataclass
class Units:
    """Places of a text's units in bytes, their hashes and numbers of words."""

    start: np.ndarray
    end: np.ndarray
    code: np.ndarray
    words: np.ndarray


@dataclass(frozen=True)
class Runs:
    """What a run is: how texts are cut, and its least number of units and words."""

    cut: Callable[[bytes], Units]
    units: int
    words: int = 0

    def of(self, text: bytes | None) -> tuple[Units, np.ndarray, np.ndarray, np.ndarray]:
        """(units, first unit, end unit and 63-bit hash of every run): at every
        unit the shortest runs that are long enough and begin or end there."""
        u = self.cut(text or b"")
        n = len(u.code)
        total = np.concatenate(([0], np.cumsum(u.words)))
        end = np.maximum(np.arange(n) + self.units, np.searchsorted(total, total[:-1] + self.words, "left"))
        first = np.flatnonzero(end <= n)
        until = np.arange(1, n + 1)
        begin = np.minimum(until - self.units, np.searchsorted(total, total[1:] - self.words, "right") - 1)
        until = until[begin >= 0]
        pairs = np.unique(np.concatenate((first * (n + 1) + end[first], begin[begin >= 0] * (n + 1) + until)))
        first, end = pairs // (n + 1), pairs % (n + 1)
        raw = u.code.astype("<u8").tobytes()
        code = np.fromiter((xxhash.xxh3_64_intdigest(raw[8 * a:8 * z]) >> 1 for a, z in zip(first.tolist(), end.tolist(), strict=True)),
                           np.int64, len(first))
        return u, first, end, code


def _emit(runs: Runs):
    def run(batches):
        for b in small_batches(batches):
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for doc_id, text in zip(b.column(0).to_pylist(), binary_column(b, 1), strict=True):
                _, first, end, code = runs.of(text)
                _, at, back = np.unique(code, return_index=True, return_inverse=True)
                for col, x in zip(out, (code, np.full(len(code), doc_id), first, end, first[at][back]), strict=True):
                    col.append(x)
            if out[0]:
                cols = [np.concatenate(c) for c in out]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0].astype(np.int64)), pa.array(cols[1].astype(np.int64)),
                     *[pa.array(c.astype(np.int32)) for c in cols[2:]]], names=["h", "doc_id", "at", "until", "own"])
    return run


def _named(docs: DataFrame) -> DataFrame:
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .filter("doc_id IS NOT NULL AND text IS NOT NULL"))


def covered(docs: DataFrame, runs: Runs) -> DataFrame:
    """(doc_id, covers, first_ids): per document that has a non-first
    occurrence, the covered [from, until) ranges of units less the kept first
    place, and the documents that keep the first occurrences."""
    found = _named(docs).mapInArrow(_emit(runs), "h long, doc_id long, at int, until int, own int")
    found = materialize(found, "runs")
    again = (found.groupBy("h").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("c"))
             .filter("c > 1").select("h", "first_id"))
    later = found.join(again, "h").filter("doc_id <> first_id OR at <> own")
    # units from ``own`` up to the end of the first place stay if the two overlap
    begin = F.expr("if(doc_id = first_id, greatest(at, own + (until - at)), at)")
    return (later.select("doc_id", "first_id", F.struct(begin.alias("a"), F.col("until").alias("z")).alias("c"))
            .filter("c.a < c.z").groupBy("doc_id")
            .agg(F.collect_set("c").alias("covers"), F.array_sort(F.collect_set("first_id")).alias("first_ids")))


def _clean_text(text: bytes, runs: Runs, covers: list[dict]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(text without the covered units, starts and ends in bytes of what went)."""
    u = runs.cut(text)
    n = len(u.code)
    mark = np.zeros(n + 1, np.int64)
    for c in covers:
        if c["z"] <= n:          # another row of the same doc_id may have a shorter text
            mark[c["a"]] += 1
            mark[c["z"]] -= 1
    gone = np.cumsum(mark[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
    start, end = u.start[edge[::2]], u.end[edge[1::2] - 1]
    keep, at = [], 0
    for a, z in zip(start.tolist(), end.tolist(), strict=True):
        keep.append(text[at:a])
        at = z
    keep.append(text[at:])
    return b"".join(keep), start, end


def _clean(runs: Runs, text_at: int, covers_at: int):
    """Replaces the text and appends starts, ends and the number of removed units."""
    def run(batches):
        for b in small_batches(batches):
            texts, starts, ends = [], [], []
            for text, covers in zip(binary_column(b, text_at), b.column(covers_at).to_pylist(), strict=True):
                if text is None or not covers:
                    out = (text, np.empty(0, np.int64), np.empty(0, np.int64))
                else:
                    out = _clean_text(text, runs, covers)
                texts.append(out[0])
                starts.append(out[1])
                ends.append(out[2])
            cols = [c for i, c in enumerate(b.columns) if i != covers_at]
            names = [n for i, n in enumerate(b.schema.names) if i != covers_at]
            cols[text_at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*cols, list_array(starts, pa.int64()), list_array(ends, pa.int64())],
                                             names=[*names, "starts", "ends"])
    return run


def removals(docs: DataFrame, runs: Runs) -> DataFrame:
    """One row per document that loses units: doc_id, first_ids (documents that
    keep the repeated runs), starts and ends (bytes removed), text (what stays)."""
    cov = covered(docs, runs).withColumnRenamed("doc_id", "id")
    rows = _named(docs).join(cov, F.col("doc_id") == F.col("id")).select("doc_id", "text", "first_ids", "covers")
    out = rows.mapInArrow(_clean(runs, 1, 3), "doc_id long, text string, first_ids array<long>, starts array<long>, ends array<long>")
    return out.filter("size(starts) > 0").select("doc_id", "first_ids", "starts", "ends", "text")


def drop_repeats(docs: DataFrame, runs: Runs) -> DataFrame:
    """All documents (all columns), their texts without the repeated runs."""
    cov = covered(docs, runs).select(F.col("doc_id").alias("_span_id"), F.col("covers").alias("_covers"))
    rows = docs.join(cov, docs["doc_id"].cast("long") == cov["_span_id"], "left").drop("_span_id")
    names = docs.columns
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    out = rows.mapInArrow(_clean(runs, names.index("text"), len(names)), kind + ", _starts array<long>, _ends array<long>")
    return out.select(*names)
