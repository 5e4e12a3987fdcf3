"""Blank-aware arithmetic and display formats of the measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_minus(cur: Column, prior: Column) -> Column:
    """Blank when the prior value is blank, else current (blank as 0) minus prior."""
    return F.when(prior.isNotNull(), F.coalesce(cur, F.lit(0)) - prior)


def blank_divide(a: Column, b: Column) -> Column:
    """a / b as double; blank when b is blank or zero, or a is blank."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def pct_one_decimal(x: Column) -> Column:
    """'12.3%' of abs(x) (x a ratio)."""
    return F.format_string("%.1f%%", F.abs(x.cast("double")) * F.lit(100.0))


def signed_pct(x: Column) -> Column:
    """Mask '+0.0%;-0.0%;0.0%' (a value that rounds to zero takes the third
    section); blank stays blank."""
    r = F.round(x.cast("double") * F.lit(100.0), 1)
    return (F.when(r > 0, F.format_string("+%.1f%%", r))
            .when(r < 0, F.format_string("-%.1f%%", F.abs(r)))
            .when(r == 0, F.lit("0.0%")))


def arrow_number(x: Column) -> Column:
    """Mask '▲ #,##0;▼ #,##0;0'; blank stays blank."""
    r = F.round(x.cast("double"), 0)
    return (F.when(r > 0, F.concat(F.lit("▲ "), F.format_number(r, 0)))
            .when(r < 0, F.concat(F.lit("▼ "), F.format_number(F.abs(r), 0)))
            .when(r == 0, F.lit("0")))
