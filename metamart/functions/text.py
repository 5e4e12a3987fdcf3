"""Text expressions: whitespace trim, blank tests, labels, run ids."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters removed by a whitespace trim of a header or a
# text key (the Unicode White_Space set, in code-point order).
WHITESPACE = ("\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
              "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
              "\u2028\u2029\u202f\u205f\u3000")


def trim_header(name: str | None) -> str | None:
    """Trim one header string (plan time, driver side): headers are schema."""
    return None if name is None else name.strip(WHITESPACE)


def trim_ws(c: Column | str) -> Column:
    """Trim all whitespace at both ends (a tab too), on the JVM, no regex."""
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(WHITESPACE))


def blank_text(c: Column | str) -> Column:
    """NULL or only blanks (spaces): the not-null rule's test for text."""
    col = F.col(c) if isinstance(c, str) else c
    return col.isNull() | (F.trim(col) == F.lit(""))


def concat_blank(*cols: Column) -> Column:
    """CONCAT where NULL counts as the empty string."""
    return F.concat_ws("", *cols)


def type_label(classification: Column | str, code_group: Column | str) -> Column:
    """'Int <group>' for Internal, 'Ext <group>' for anything else."""
    cls = F.col(classification) if isinstance(classification, str) else classification
    grp = F.col(code_group) if isinstance(code_group, str) else code_group
    return concat_blank(F.when(cls == F.lit("Internal"), F.lit("Int")).otherwise(F.lit("Ext")),
                        F.lit(" "), grp)


def run_id(now: datetime, source_id: Column | str) -> Column:
    """ISO seconds of the run, '-', source id (two runs in one second collide)."""
    sid = F.col(source_id) if isinstance(source_id, str) else source_id
    return F.concat(F.lit(now.strftime("%Y-%m-%dT%H:%M:%S")), F.lit("-"), sid.cast("string"))
