"""Scalar column expressions (all built-in Spark functions, no UDF)."""

from metamart.functions.dates import calendar_columns, date_key, month_name, month_short
from metamart.functions.formats import (arrow_number, blank_divide, blank_minus,
                                        pct_one_decimal, signed_pct)
from metamart.functions.text import (WHITESPACE, blank_text, concat_blank, run_id,
                                     trim_header, trim_ws, type_label)

__all__ = [
    "WHITESPACE", "arrow_number", "blank_divide", "blank_minus", "blank_text",
    "calendar_columns", "concat_blank", "date_key", "month_name", "month_short",
    "pct_one_decimal", "run_id", "signed_pct", "trim_header", "trim_ws", "type_label",
]
