"""Landing scans and the all-source ingest."""

from __future__ import annotations

import csv
import io
import posixpath
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import islice
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metamart.functions.text import WHITESPACE, trim_header
from metamart.operators.reshape import (MissingHeaderError, dedupe_names, key_positions, name_blanks, roles, to_int64,
                                        wide_to_bronze)
from metamart.schemas import BRONZE
from metamart.sources.literal import local_frame


def active_sources(registry: DataFrame) -> DataFrame:
    """Registry rows that are reloaded (inactive ones keep their bronze rows)."""
    return registry.filter(F.col("IsActive")).select("SourceId", "SourceName", "FilePath", "SheetName")


def read_wide(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Open one landing file; the first record holds the headers, all columns kept.

    CSV columns stay strings: typing happens from metadata (keys) and in the
    unpivot (values, half-even rounding).  An empty cell is null, quoted or not.
    """
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    # quotes inside quotes are doubled; line breaks inside quotes stay in their cell
    reader = spark.read.option("inferSchema", False).option("multiLine", True).option("escape", '"')
    # Spark would rename repeated or case-only-different headers: take the first
    # record as it is and name the columns by position
    first = reader.csv(path).first()
    data = reader.option("header", True).csv(path)
    if first is None:
        return data
    names = [None if h is None else h.lstrip("\ufeff") if i == 0 else h for i, h in enumerate(first)]
    inner = [f"_c{i}" for i in range(len(names))]
    # with a line break inside the first quotes the reader takes a bare \n for the end of
    # a record and leaves the \r of \r\n in the last cell
    names[-1] = None if names[-1] is None else names[-1].rstrip("\r")
    ends = {inner[-1]: F.rtrim(F.col(inner[-1]), F.lit("\r"))}
    cells = data.toDF(*inner).select(*[F.nullif(ends.get(c, F.col(c)), F.lit("")).alias(c) for c in inner])
    return cells.toDF(*name_blanks(names))


def key_meta(key_map: DataFrame, source_id: int) -> list:
    """Key-column rows of one source (metadata: a few rows, read once)."""
    return (key_map.filter(F.col("SourceId") == F.lit(source_id))
            .select("SourceColumn", "TargetColumn", "DataType").collect())


def key_meta_all(key_map: DataFrame, source_ids) -> dict[int, list]:
    """Key-column rows of many sources in one small read."""
    rows = (key_map.filter(F.col("SourceId").isin(list(source_ids)))
            .select("SourceId", "SourceColumn", "TargetColumn", "DataType").collect())
    out: dict[int, list] = {int(s): [] for s in source_ids}
    for r in rows:
        out[int(r["SourceId"])].append(r)
    return out


def ingest(frames: Mapping[int, DataFrame], key_map: DataFrame) -> DataFrame:
    """All sources as one lazy bronze frame: per-source reshape, one union.

    Each source keeps its own headers and header language; nothing is
    executed here.  The result is written once (see ``warehouse``).
    """
    keys = key_meta_all(key_map, frames.keys())
    parts = [wide_to_bronze(df, sid, keys[int(sid)]) for sid, df in frames.items()]
    if not parts:
        raise ValueError("no source to ingest")
    return reduce(DataFrame.unionByName, parts)


def empty_bronze(spark: SparkSession) -> DataFrame:
    return local_frame(spark, [], BRONZE)


def replace_rows(current: DataFrame, new: DataFrame, source_ids) -> DataFrame:
    """Replace-by-source as a frame: the rows of the given sources are
    dropped and the new rows of those sources added (an empty new frame
    empties the source); other sources are untouched."""
    ids = [int(s) for s in source_ids]
    keep = current.filter(~F.col("SourceID").isin(ids))
    return keep.unionByName(new.filter(F.col("SourceID").isin(ids)))


# ---------------------------------------------------------------------------
# One-scan ingest of many CSV landing files (any headers, any number of files)
# ---------------------------------------------------------------------------
_CELLS = "SourceID bigint, Plant string, Month string, SourceColumn string, Cell string"
ROWS_AT_ONCE = 20_000


@dataclass(frozen=True)
class FileRoles:
    """What the metadata says about the columns of one source's files."""
    source_id: int
    key_rows: tuple[dict, ...]

    def header(self, names: Sequence[str | None], file: str) -> tuple[dict[str, int], list[tuple[int, str]]]:
        """Key positions by bronze name, and (position, trimmed header) of every
        column to unpivot."""
        heads = dedupe_names(name_blanks(names))
        try:
            keys = key_positions(heads, roles(self.key_rows), self.key_rows)
        except MissingHeaderError as e:
            raise MissingHeaderError(f"{file}: {e}") from None
        if absent := {"Plant", "Month"} - keys.keys():
            raise MissingHeaderError(f"{file}: no key column names {sorted(absent)}")
        taken = set(keys.values())
        return keys, [(i, trim_header(h)) for i, h in enumerate(heads) if i not in taken]


def location(uri: str) -> str:
    """The path of a file without scheme and authority, percent-decoded."""
    path = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "", uri)
    return "/" + unquote(path).strip("/")


def _records(content: bytes) -> Iterator[list[str]]:
    """CSV records; line breaks inside quotes belong to their cell."""
    csv.field_size_limit(2**31 - 1)
    text = io.TextIOWrapper(io.BytesIO(content), encoding="utf-8-sig", newline="")
    return (r for r in csv.reader(text, strict=True) if r)


def _unpivoted(content: bytes, file: str, source: FileRoles) -> Iterator[pa.RecordBatch]:
    """One file's non-empty cells in long form, a bounded number of rows at a time."""
    records = _records(content)
    names = next(records, None)
    if names is None:                    # an empty file has no header and no rows
        return
    keys, measures = source.header(names, file)
    trimmed = set(roles(source.key_rows).text)
    width = len(names)
    while rows := list(islice(records, ROWS_AT_ONCE)):
        for r in rows:
            if len(r) < width:           # cells left out at the end are empty
                r.extend([""] * (width - len(r)))
            elif len(r) > width:
                raise ValueError(f"{file}: cells behind the last header: {r[width:]}")
        columns = list(zip(*rows, strict=True))

        def cells(i: int) -> pa.Array:
            column = pa.array(columns[i], pa.string())
            return pc.if_else(pc.equal(column, ""), pa.scalar(None, pa.string()), column)

        id_cells = {}
        for name in ("Plant", "Month"):
            column = cells(keys[name])
            id_cells[name] = pc.utf8_trim(column, characters=WHITESPACE) if name in trimmed else column
        for i, head in measures:
            column = cells(i)
            at = pc.indices_nonzero(pc.is_valid(column))
            yield pa.RecordBatch.from_arrays([
                pa.repeat(pa.scalar(source.source_id, pa.int64()), len(at)), id_cells["Plant"].take(at),
                id_cells["Month"].take(at), pa.repeat(pa.scalar(head, pa.string()), len(at)), column.take(at),
            ], ["SourceID", "Plant", "Month", "SourceColumn", "Cell"])


def _reader(by_location: Mapping[str, FileRoles]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0), b.column(1), strict=True):
                at = file = location(path.as_py())
                while at and at not in by_location:       # a file, or a part file of a registered folder
                    at = at.rpartition("/")[0]
                if not at:
                    raise ValueError(f"landing file not registered: {file}")
                yield from _unpivoted(content.as_py(), file, by_location[at])

    return run


def ingest_landing(spark: SparkSession, sources: DataFrame, key_map: DataFrame,
                   root: str = "") -> DataFrame:
    """All registered CSV files as bronze rows in one lazy plan, each byte read once.

    ``sources`` holds (SourceId, FilePath); paths are relative to ``root`` (a path
    may be a folder of part files, each with its header).  Spark lists and reads
    the files, whatever file system they are on, and hands every file whole to a
    task; its first record is its header, so files with different headers, header
    languages or widths need no plan of their own and the driver sees no file.
    The task finds the file's source by its location, splits records (line breaks
    inside quotes stay in their cell), names blank headers ``Column<n>``, and turns
    the columns that the metadata does not name as keys into rows.  Text keys are
    trimmed, every other type is cast by Spark: the same rows as ``ingest`` gives.

    What the tasks are told is the registry and its key columns: a row a source, not
    a file.  A file is held in memory by its task (spreadsheet exports; Spark's
    limit for a file read whole is 2 GB), so larger ones belong in part folders.
    """
    base = root.rstrip("/") + "/" if root else ""
    by_path: dict[str, int] = {}
    for r in sources.select("SourceId", "FilePath").collect():
        place = base + posixpath.normpath(r["FilePath"])
        if place in by_path:
            raise ValueError(f"sources {by_path[place]} and {r['SourceId']} name the same file: {r['FilePath']}")
        by_path[place] = int(r["SourceId"])
    if not by_path:
        return empty_bronze(spark)
    keys = key_meta_all(key_map, by_path.values())
    by_location = {location(quote(p, safe="/:")): FileRoles(s, tuple(r.asDict() for r in keys[s])) for p, s in by_path.items()}
    files = spark.read.format("binaryFile").load(list(by_path)).select("path", "content")
    cells = files.mapInArrow(_reader(by_location), _CELLS)
    return cells.select("SourceID", "Plant", F.col("Month").cast("date").alias("Month"), "SourceColumn",
                        to_int64(F.col("Cell"), False).alias("Value"))
