"""Helpers shared by the operators: scratch tables, word hashes, Arrow batches."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metamart.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``."""
    root = ensure_checkpoint_dir(spark)
    return f"{root}/metamart-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:8]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to shared storage and read it back: the lineage is cut,
    a lost executor costs no recomputation, and it is computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_place(name: Column | str) -> Column:
    """Order of the files that Spark wrote, by name: the task's number, then the
    number of the file among the task's (with a limit of records a file)."""
    name = F.col(name) if isinstance(name, str) else name
    part = F.regexp_extract(name, r"part-(\d+)", 1).cast("long")
    return part * 1_000_000 + F.regexp_extract(F.concat(name, F.lit("-c0.")), r"-c(\d+)\.", 1).cast("long")


@contextmanager
def arrow_rows(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for the jobs run inside: a batch of
    whole texts is held by the JVM and by its worker at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


# --------------------------------------------------------- a worker's memory
# Spark gives the workers of one step to the next: what a step remembers there
# must not add up with what later steps need
_REMEMBERED: dict[str, Callable[[], None]] = {}


def remembered(name: str, forget: Callable[[], None]) -> None:
    """Names something that workers remember between tasks, and how to free it."""
    _REMEMBERED[name] = forget


def give_back() -> None:
    """Returns the freed memory of this worker to the system: Arrow and the C
    library keep it otherwise, next to the executor's heap."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):    # glibc has it
        trim(0)


def begin_step(names: tuple[str, ...]) -> None:
    """Frees what this worker remembers apart from ``names``."""
    for name, forget in _REMEMBERED.items():
        if name not in names:
            forget()
    give_back()


def remembering(*names: str):
    """Decorates the function of a ``mapInArrow``: its task begins without what
    steps remembered apart from ``names``, and ends without memory in reserve
    (memory only: what is forgotten changes no result)."""
    def wrap(run):
        def task(batches):
            begin_step(names)       # by name: a pickled copy would forget for itself alone
            try:
                yield from run(batches)
            finally:
                give_back()
        return task
    return wrap


# ------------------------------------------------------------------- words
class WordHashes(dict):
    """word bytes -> 64-bit hash, remembered up to ``limit`` words of at most
    ``longest`` bytes (memory only: an emptied cache changes no result)."""

    def __init__(self, limit: int = 200_000, longest: int = 100):
        super().__init__()
        self.limit = limit
        self.longest = longest

    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh3_64_intdigest(word)
        if len(word) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[word] = code
        return code


_WORDS = WordHashes()
remembered("words", _WORDS.clear)
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text, A-Z lower-cased; None has none."""
    return text.lower().split() if text else []


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=len(words))


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalising mixer of 64-bit values (bijective)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(_MIX[1])
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(_MIX[2])
    return h ^ (h >> np.uint64(32))


def run_codes(codes: np.ndarray, n: int, offsets: range | tuple[int, ...] | None = None) -> np.ndarray:
    """Hash of the run starting at every position that has ``n`` items left.
    ``offsets`` names the items of a run that count (default: all n)."""
    m = len(codes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    acc = np.zeros(m, np.uint64)
    for i in range(n) if offsets is None else offsets:
        mult = np.uint64((_MIX[0] * (2 * i + 1) + 2 * i * _MIX[2]) & 0xFFFFFFFFFFFFFFFF | 1)
        acc += mix64(codes[i:i + m] * mult)
    return mix64(acc)


def as_long(h: np.ndarray) -> np.ndarray:
    """63-bit non-negative longs in the order of the 64-bit hashes."""
    return (h >> np.uint64(1)).astype(np.int64)


# ------------------------------------------------------------ Arrow batches
def binary_column(batch: pa.RecordBatch, i: int) -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding."""
    col = batch.column(i)
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return col.cast(kind).to_pylist()


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows: bounds the working memory of a task."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
