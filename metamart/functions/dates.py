"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d: Column | str) -> Column:
    """yyyymmdd as an int."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_short(d: Column | str) -> Column:
    """English three-letter month name ('Jan')."""
    return F.date_format(_c(d), "MMM")


def month_name(d: Column | str) -> Column:
    """English full month name ('January')."""
    return F.date_format(_c(d), "MMMM")


def calendar_columns(df: DataFrame, date_col: str = "Date") -> DataFrame:
    """Add DateKey, Year, MonthNumber, MonthShort derived from ``date_col``."""
    d = F.col(date_col)
    return df.withColumns({
        "DateKey": date_key(d),
        "Year": F.year(d).cast("int"),
        "MonthNumber": F.month(d).cast("int"),
        "MonthShort": month_short(d),
    })
