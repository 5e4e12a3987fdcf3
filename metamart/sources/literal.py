"""Small literal tables as local relations.

``spark.createDataFrame(list)`` gives a plan whose size the optimizer does
not know (it assumes the maximum), so a join to even a three-row metadata
table would shuffle both sides.  A ``VALUES`` relation carries its exact
size, so the optimizer's own size check broadcasts it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return f"{v}L" if abs(v) > 2**31 - 1 else str(v)
    if isinstance(v, float):
        return f"CAST('{v!r}' AS DOUBLE)"
    if isinstance(v, Decimal):
        return f"{v}BD"
    if isinstance(v, datetime):
        return f"TIMESTAMP '{v.isoformat(sep=' ')}'"
    if isinstance(v, date):
        return f"DATE '{v.isoformat()}'"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def local_frame(spark: SparkSession, rows: Sequence[Sequence], schema: StructType) -> DataFrame:
    """A DataFrame over literal rows with the given schema, as a local
    relation whose size the optimizer knows."""
    names = [f.name for f in schema.fields]
    cols = ", ".join(f"CAST(c{i} AS {f.dataType.simpleString()}) AS `{f.name}`"
                     for i, f in enumerate(schema.fields))
    aliases = ", ".join(f"c{i}" for i in range(len(names)))
    if not rows:
        nulls = ", ".join("NULL" for _ in names)
        return spark.sql(f"SELECT {cols} FROM VALUES ({nulls}) AS t({aliases}) WHERE FALSE")
    body = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT {cols} FROM VALUES {body} AS t({aliases})")
