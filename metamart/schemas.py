"""Table schemas of the warehouse (meta, bronze, audit, gold, proposals)."""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DateType, DoubleType, IntegerType,
                               LongType, StringType, StructField, StructType,
                               TimestampType)


def _s(*fields: tuple[str, object, bool]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


SOURCE_REGISTRY = _s(("SourceId", IntegerType(), False), ("SourceName", StringType(), False),
                     ("FilePath", StringType(), False), ("SheetName", StringType(), False),
                     ("IsActive", BooleanType(), False))

KEY_COLUMN_MAPPING = _s(("SourceId", IntegerType(), False), ("SourceColumn", StringType(), False),
                        ("TargetColumn", StringType(), False), ("DataType", StringType(), False))

COLUMN_MAPPING = _s(("MappingId", IntegerType(), False), ("SourceId", IntegerType(), False),
                    ("SourceColumn", StringType(), False), ("Classification", StringType(), False),
                    ("CodeGroup", StringType(), False), ("IsActive", BooleanType(), False))

DQ_RULES = _s(("RuleId", IntegerType(), False), ("SourceId", IntegerType(), True),
              ("RuleName", StringType(), False), ("RuleType", StringType(), False),
              ("TargetColumn", StringType(), True), ("RuleParameters", StringType(), False),
              ("Severity", StringType(), False), ("IsActive", BooleanType(), False))

BRONZE = _s(("SourceID", LongType(), True), ("Plant", StringType(), True),
            ("Month", DateType(), True), ("SourceColumn", StringType(), True),
            ("Value", LongType(), True))

VALIDATION_LOG = _s(("RunId", StringType(), False), ("RunTimestamp", TimestampType(), False),
                    ("SourceId", IntegerType(), False), ("RuleId", IntegerType(), False),
                    ("RuleName", StringType(), False), ("Severity", StringType(), False),
                    ("Passed", BooleanType(), False), ("Details", StringType(), True))

DIM_PLANT = _s(("PlantKey", LongType(), False), ("PlantCode", StringType(), False))

DIM_INCIDENT_TYPE = _s(("IncidentTypeKey", LongType(), False), ("Classification", StringType(), False),
                       ("CodeGroup", StringType(), False), ("IncidentTypeName", StringType(), False),
                       ("SortOrder", LongType(), False))

DIM_DATE = _s(("DateKey", IntegerType(), False), ("Date", DateType(), False),
              ("Year", IntegerType(), False), ("MonthNumber", IntegerType(), False),
              ("MonthShort", StringType(), False), ("Period", StringType(), False))

FACT_INCIDENTS = _s(("PlantKey", LongType(), False), ("DateKey", IntegerType(), False),
                    ("IncidentTypeKey", LongType(), False), ("Incidents", IntegerType(), False))

PROPOSALS = _s(("SourceId", IntegerType(), True), ("SourceColumn", StringType(), True),
               ("Classification", StringType(), True), ("CodeGroup", StringType(), True),
               ("Confidence", DoubleType(), True), ("Rationale", StringType(), True),
               ("ModelName", StringType(), True), ("ProposedAt", TimestampType(), True))

# Length limits of the warehouse DDL (VARCHAR(n)) enforced by the gold contract.
GOLD_LENGTHS = {
    "dim_plant": {"PlantCode": 100},
    "dim_incident_type": {"Classification": 50, "CodeGroup": 50, "IncidentTypeName": 100},
    "dim_date": {"MonthShort": 3, "Period": 30},
    "fact": {},
}

GOLD_SCHEMAS = {
    "dim_plant": DIM_PLANT,
    "dim_incident_type": DIM_INCIDENT_TYPE,
    "dim_date": DIM_DATE,
    "fact": FACT_INCIDENTS,
}

# Length limits of the metadata DDL (VARCHAR(n)); NOT NULL comes from the
# schemas above.  Checked when a metadata table is rewritten.
META_LENGTHS = {
    "source_registry": {"SourceName": 100, "FilePath": 500, "SheetName": 100},
    "key_column_mapping": {"SourceColumn": 200, "TargetColumn": 50, "DataType": 20},
    "column_mapping": {"SourceColumn": 200, "Classification": 50, "CodeGroup": 50},
    "dq_rules": {"RuleName": 200, "RuleType": 50, "TargetColumn": 200, "RuleParameters": 1000,
                 "Severity": 20},
}
