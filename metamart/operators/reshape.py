"""Wide source -> long bronze rows (rename, type, unpivot, trim, stamp)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from metamart.functions.text import trim_header, trim_ws

BRONZE_COLUMNS = ("SourceID", "Plant", "Month", "SourceColumn", "Value")


class MissingHeaderError(ValueError):
    """A key header named by the metadata is absent from the file."""


def q(name: str) -> Column:
    """Column by exact name (headers may hold dots, spaces, accents)."""
    return F.col("`" + name.replace("`", "``") + "`")


def dedupe_names(names: Sequence[str]) -> list[str]:
    """Make header names unique the way header promotion does: a repeated
    name (exact, case-sensitive) gets ``_1``, ``_2`` ... in order."""
    seen: set[str] = set()
    count: dict[str, int] = {}
    out = []
    for c in names:
        if c in seen:
            n = count.get(c, 0)
            candidate = c
            while candidate in seen:
                n += 1
                candidate = f"{c}_{n}"
            count[c] = n
            c = candidate
        seen.add(c)
        out.append(c)
    return out


def name_blanks(cells: Sequence[str | None]) -> list[str]:
    """Names of a header record: an empty cell is ``Column<n>`` by its position."""
    return [c if c else f"Column{i}" for i, c in enumerate(cells, 1)]


def positional(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """The frame with internal names ``_c0 .. _cN`` and its headers, exact.

    Spark resolves names case-insensitively and rejects duplicates, while
    headers are case-sensitive and may repeat: columns are therefore
    addressed by position and the header text only travels as a label.
    """
    headers = dedupe_names(df.columns)
    return df.toDF(*[f"_c{i}" for i in range(len(headers))]), headers


@dataclass(frozen=True)
class KeyRoles:
    """Role split of the identifying columns of one source (B2)."""
    renames: tuple[tuple[str, str], ...]   # (file header, bronze name), unequal pairs only
    ids: tuple[str, ...]                   # every identifying column (bronze names)
    text: tuple[str, ...]                  # DataType 'text'
    dates: tuple[str, ...]                 # DataType 'date'


def roles(key_rows: Sequence) -> KeyRoles:
    """Split key-metadata rows (SourceColumn, TargetColumn, DataType) by role.

    The rows are metadata (a handful per source), read on the driver once.
    """
    rows = [(r["SourceColumn"], r["TargetColumn"], r["DataType"]) for r in key_rows]
    return KeyRoles(
        renames=tuple((s, t) for s, t, _ in rows if s != t),
        ids=tuple(t for _, t, _ in rows),
        text=tuple(t for _, t, d in rows if d == "text"),
        dates=tuple(t for _, t, d in rows if d == "date"),
    )


def key_positions(headers: Sequence[str], r: "KeyRoles", key_rows: Sequence) -> dict[str, int]:
    """Bronze key name -> position of its file header (exact match).  A
    header named by the metadata but absent from the file is an error."""
    want = {t: s for s, t, _ in ((k["SourceColumn"], k["TargetColumn"], k["DataType"]) for k in key_rows)}
    pos = {}
    missing = []
    for target, source in want.items():
        if source not in headers:
            missing.append(source)
        elif source != target and target in headers and target not in want.values():
            raise MissingHeaderError(f"renaming {source!r} would collide with the file's column {target!r}")
        else:
            pos[target] = headers.index(source)
    if missing:
        raise MissingHeaderError(f"key header(s) not in the file: {missing}")
    return pos


def to_int64(c: Column, is_integral: bool) -> Column:
    """Whole number as bigint; fractions round half to even (2.5 -> 2).
    Through decimals: whole numbers above 2 ** 53 stay exact."""
    if is_integral:
        return c.cast("bigint")
    return F.bround(c.cast("decimal(38,10)"), 0).cast("bigint")


def unpivot_others(df: DataFrame, headers: Sequence[str], id_positions: dict[str, int],
                   var: str = "SourceColumn", val: str = "Value") -> DataFrame:
    """Every non-identifying column becomes a (header, value) row; null cells
    produce no row.  ``df`` has positional names (see ``positional``); the
    id columns come out under their bronze names.  Headers are trimmed here,
    once, at plan time (they are schema, not data): no per-row string work.
    """
    fields = df.schema.fields
    ids = {i: name for name, i in id_positions.items()}
    id_cols = [F.col(fields[i].name).alias(name) for i, name in sorted(ids.items())]
    others = [(i, f) for i, f in enumerate(fields) if i not in ids]
    if not others:
        return (df.select(*id_cols).withColumns({var: F.lit(None).cast("string"),
                                                 val: F.lit(None).cast("bigint")}).filter(F.lit(False)))
    base = df.select(*id_cols, *[F.col(f.name) for _, f in others])
    values = [to_int64(F.col(f.name), isinstance(f.dataType, IntegralType)).alias(trim_header(headers[i]))
              for i, f in others]
    return (base.unpivot([F.col(n) for _, n in sorted(ids.items())], values, var, val)
            .filter(F.col(val).isNotNull()))


def trim_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Whitespace trim (tabs too) of text keys, both ends."""
    return df.withColumns({c: trim_ws(q(c)) for c in cols}) if cols else df


def stamp(df: DataFrame, source_id: int) -> DataFrame:
    """Add SourceID and project the fixed bronze layout.  Bronze has its own column
    types: a key that the metadata types otherwise, or not at all, is cast here;
    identifying columns that bronze does not have end here."""
    return df.select(F.lit(int(source_id)).cast("bigint").alias("SourceID"), q("Plant").cast("string").alias("Plant"),
                     q("Month").cast("date").alias("Month"), q("SourceColumn"), q("Value").cast("bigint").alias("Value"))


def type_keys(df: DataFrame, r: KeyRoles) -> DataFrame:
    """Cast text keys to string and date keys to date (bad dates raise)."""
    casts = {c: F.col(c).cast("string") for c in r.text}
    casts.update({c: F.col(c).cast("date") for c in r.dates})
    return df.withColumns(casts) if casts else df


def wide_to_bronze(df: DataFrame, source_id: int, key_rows: Sequence) -> DataFrame:
    """B1..B6 for one wide source frame: find and rename the key headers,
    type them, unpivot every other column, trim text keys, stamp the source."""
    r = roles(key_rows)
    pdf, headers = positional(df)
    pos = key_positions(headers, r, key_rows)
    out = unpivot_others(pdf, headers, pos)
    out = type_keys(out, r)
    out = trim_cols(out, r.text)
    return stamp(out, source_id)
