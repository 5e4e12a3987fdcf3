"""Small literal frames for the hand fixtures."""

from __future__ import annotations

from datetime import date

from metamart import schemas


def mapping(spark, rows):
    return spark.createDataFrame(rows, schemas.COLUMN_MAPPING)


def rules(spark, rows):
    return spark.createDataFrame(rows, schemas.DQ_RULES)


def key_map(spark, rows):
    return spark.createDataFrame(rows, schemas.KEY_COLUMN_MAPPING)


def bronze(spark, rows):
    return spark.createDataFrame(rows, schemas.BRONZE)


SIX_RULES = [
    (1, None, "Headers known to the mapping", "SchemaDrift", None, "{}", "Warning", True),
    (2, None, "Some rows arrived", "RowCount", None, '{"min": 1}', "Error", True),
    (3, None, "Every row has a plant", "NotNull", "Plant", "{}", "Error", True),
    (4, None, "Counts from zero up", "Range", "Value", '{"min": 0}', "Error", True),
    (5, None, "One row per plant, month and type", "Unique", None, '{"cols": []}', "Error", True),
    (6, None, "Mapped headers arrived", "MissingColumn", None, "{}", "Error", True),
]

D = date
