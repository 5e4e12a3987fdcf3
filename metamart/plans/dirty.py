"""A second binding whose landing files are as untidy as real ones, and the queries on it.

Five registered sources, derived from ``lineitem``, ``supplier`` and ``nation``:
1 to 3 in three header languages with empty, blank and multi-line plants, missing
months, fractions, negative values and a column without a header; 4 repeats plants of
the others, types its month as text and has an identifying column that bronze lacks;
5 has a header only.  The mapping is derived from the tables too.  The files go through
the one-scan ingest into a warehouse, are validated, then source 1 is reloaded from a
shorter file, source 2 from an empty one, source 3 is deleted, and the remaining ones
are validated again, twice.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from metamart import schemas
from metamart.operators import dq, gold, silver as S
from metamart.plans import binding as B, jobs, pipeline
from metamart.session import ensure_checkpoint_dir
from metamart.sources import landing, warehouse as W
from metamart.sources.literal import local_frame

# Fixed values of the binding: source 4's third key, the first month of the reloaded
# source 1, the ids of each run.
COUNTRY_HEADER = "Pais"
RELOAD_FROM = "1995-01-01"
FIRST_RUN, SECOND_RUN = (1, 2, 3, 4, 5), (1, 2, 4)
SECOND_NOW = B.RUN_NOW + timedelta(hours=1)
QUEUE_NOW = datetime(2024, 3, 1, 9, 0, 0)

# (RuleId, SourceId, RuleName, RuleType, TargetColumn, RuleParameters, Severity, IsActive)
RULES = [
    *B.RULES,
    (7, None, "Every row has a month", "NotNull", "Month", "{}", "Warning", True),
    (8, None, "Every row has a header", "NotNull", "SourceColumn", "{}", "Error", True),
    (9, None, "Every row has a value", "NotNull", "Value", "{}", "Error", True),
    (10, 1, "A region for every row", "NotNull", "Region", "{}", "Warning", True),
    (11, 4, "Source 4 is large", "RowCount", None, '{"min": 100000000}', "Warning", True),
    (12, 4, "Switched off", "RowCount", None, '{"min": 100000000}', "Error", False),
]
KEYS = [
    *[r for r in B.key_rows() if r[0] <= 3],
    (4, "Planta", "Plant", "text"), (4, "Mes", "Month", "text"), (4, COUNTRY_HEADER, "Country", "any"),
    (5, "Plant", "Plant", "text"), (5, "Month", "Month", "date"),
]


# ------------------------------------------------------------------- files
def _lines(spark: SparkSession, d: str) -> DataFrame:
    li = spark.read.parquet(f"{d}/lineitem.parquet").select(
        "l_suppkey", "l_linestatus", "l_returnflag", "l_quantity", "l_linenumber",
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("m"))
    sup = spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", "s_name", "s_nationkey")
    return li.join(sup, li.l_suppkey == sup.s_suppkey)


def _cells(scaled) -> list:
    return [scaled(F.sum(F.when((F.col("l_linestatus") == status) & (F.col("l_returnflag") == g), F.col("l_quantity")))
                   .cast("decimal(20,1)")).alias(f"{cls}_{g}") for status, cls in B.STATUS_CLASS.items() for g in B.CODE_GROUPS]


def files(spark: SparkSession, d: str) -> dict[int, DataFrame]:
    """The wide files of sources 1 to 4, every column as text."""
    k = F.col("l_suppkey")
    plant = (F.when(k % 11 == 0, F.lit("")).when(k % 11 == 1, F.lit("   "))
             .when(k % 11 == 2, F.concat("s_name", F.lit('\nAnnex "B"'))).otherwise(F.col("s_name")))
    month = F.when(~((k % 7 == 3) & (F.month("m") == 12)), F.col("m"))
    rows = _lines(spark, d).groupBy((k % 3 + 1).alias("sid"), plant.alias("Plant"), month.alias("Month"))
    half, minus = F.month("Month") == 3, F.month("Month") == 6
    wide = rows.agg(*_cells(lambda c: c), F.sum("l_linenumber").alias("other"))
    for c in wide.columns[3:-1]:
        wide = wide.withColumn(c, F.when(half, F.col(c) + F.lit("0.5").cast("decimal(2,1)")).when(minus, -F.col(c)).otherwise(F.col(c)))
    names = [f"{cls}_{g}" for cls in B.STATUS_CLASS.values() for g in B.CODE_GROUPS]
    out = {}
    for sid in (1, 2, 3):
        heads = [B.SOURCES[sid][3], B.SOURCES[sid][4], *[B.header(sid, *n.split("_")) for n in names], ""]
        out[sid] = wide.filter(F.col("sid") == sid).select("Plant", "Month", *names, "other").toDF(*heads)
    nation = spark.read.parquet(f"{d}/nation.parquet").select("n_nationkey", "n_name")
    more = _lines(spark, d).filter(k % 10 == 3).join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    again = more.groupBy("s_name", "n_name", "m").agg(*_cells(lambda c: c)).select(
        F.concat(F.lit(" "), F.col("m").cast("string"), F.lit(" ")).alias("m"), "n_name", "s_name", *names)
    out[4] = again.toDF("Mes", COUNTRY_HEADER, "Planta", *[B.header(4, *n.split("_")) for n in names])
    return out


def mapping(spark: SparkSession, d: str) -> DataFrame:
    """A mapping per source and kind of line that occurs, and one per nation."""
    kinds = spark.read.parquet(f"{d}/lineitem.parquet").select("l_linestatus", "l_returnflag").distinct()
    heads = F.array(*[F.struct(F.lit(s).alias("SourceId"), F.lit(B.SOURCES[s][5]).alias("Int"), F.lit(B.SOURCES[s][6]).alias("Ext"))
                      for s in (1, 2, 3, 4)])
    internal = F.col("l_linestatus") == "O"
    each = kinds.select("l_linestatus", "l_returnflag", F.inline(heads))
    rows = each.select(
        # a source has as many kinds as the two columns have values: a handful
        (F.col("SourceId") * 1000 + F.row_number().over(Window.partitionBy("SourceId").orderBy("l_linestatus", "l_returnflag"))
         ).alias("MappingId"), "SourceId",
        F.concat(F.when(internal, F.col("Int")).otherwise(F.col("Ext")), "l_returnflag").alias("SourceColumn"),
        F.when(internal, F.lit("Internal")).otherwise(F.lit("External")).alias("Classification"),
        F.col("l_returnflag").alias("CodeGroup"), (~((F.col("SourceId") == 3) & (F.col("l_returnflag") == "R"))).alias("IsActive"))
    per_nation = spark.read.parquet(f"{d}/nation.parquet").select(
        F.col("n_nationkey").alias("MappingId"), F.lit(1).alias("SourceId"), F.concat(F.lit("Nation "), "n_name").alias("SourceColumn"),
        F.lit("External").alias("Classification"), F.concat(F.lit("X"), F.col("n_regionkey").cast("string")).alias("CodeGroup"),
        (F.col("n_nationkey") % 2 == 0).alias("IsActive"))
    both = rows.unionByName(per_nation)
    return both.select(*[F.col(f.name).cast(f.dataType) for f in schemas.COLUMN_MAPPING.fields])


def _write(df: DataFrame, path: str) -> None:
    (df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]).write.mode("overwrite")
     .options(header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path))


def _written(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    schema = StructType([StructField(c, StringType()) for c in columns])
    return spark.read.schema(schema).options(header=True, multiLine=True, escape='"').csv(path)


def _registered(spark: SparkSession, ids) -> DataFrame:
    return local_frame(spark, [(s, f"source_{s}") for s in ids], StructType([
        StructField("SourceId", IntegerType()), StructField("FilePath", StringType())]))


def key_map(spark: SparkSession) -> DataFrame:
    return local_frame(spark, KEYS, schemas.KEY_COLUMN_MAPPING)


_LOADED: dict[tuple[str, str], W.Warehouse] = {}
_LOCK = threading.Lock()


def loaded(spark: SparkSession, d: str) -> W.Warehouse:
    """The loads described above, once per Spark application and data folder."""
    key = (spark.sparkContext.applicationId, os.path.abspath(d))
    with _LOCK:
        if key not in _LOADED:
            tag = hashlib.sha1(key[1].encode()).hexdigest()[:12]
            wh = W.Warehouse(spark, f"{ensure_checkpoint_dir(spark)}/metamart-{key[0]}/{tag}-dirty-{uuid.uuid4().hex[:6]}")
            wide = files(spark, d)
            for sid, df in wide.items():
                _write(df, wh.path("landing", f"source_{sid}"))
            _write(spark.range(0).select(F.lit("").alias("Plant"), F.lit("").alias("Month"), F.lit("").alias("Q")),
                   wh.path("landing", "source_5"))
            # the file just written, not the line items once more; its months are ISO dates
            first = _written(spark, wh.path("landing", "source_1"), wide[1].columns)
            _write(first.filter(F.col(B.SOURCES[1][4]).isNull() | (F.col(B.SOURCES[1][4]) == "")
                                | (F.col(B.SOURCES[1][4]) >= RELOAD_FROM)), wh.path("again", "source_1"))
            _write(wide[2].limit(0), wh.path("again", "source_2"))
            W.save_meta_tables(wh, {"column_mapping": mapping(spark, d), "key_column_mapping": key_map(spark),
                                    "dq_rules": local_frame(spark, RULES, schemas.DQ_RULES)})
            mapped, rules = W.load_meta(wh, "column_mapping"), W.load_meta(wh, "dq_rules")
            W.replace_sources_bulk(wh, first_landing(wh), FIRST_RUN)
            pipeline.validate(wh, mapped, rules, FIRST_RUN, B.RUN_NOW)
            W.replace_sources_bulk(wh, landing.ingest_landing(spark, _registered(spark, (1, 2)), key_map(spark), wh.path("again")), (1, 2))
            W.delete_sources(wh, [3])
            for _ in range(2):                       # a repeated run replaces its log rows
                pipeline.validate(wh, mapped, rules, SECOND_RUN, SECOND_NOW)
            _LOADED[key] = wh
        return _LOADED[key]


def first_landing(wh: W.Warehouse) -> DataFrame:
    return landing.ingest_landing(wh.spark, _registered(wh.spark, FIRST_RUN), key_map(wh.spark), wh.path("landing"))


# ----------------------------------------------------------------- queries
def _log(wh: W.Warehouse, now: datetime) -> DataFrame:
    return W.load_log(wh).filter(F.col("RunTimestamp") == F.lit(now.isoformat(sep=" ")).cast("timestamp"))


def _measures(spark: SparkSession, d: str) -> DataFrame:
    wh = loaded(spark, d)
    return dq.source_measures(W.load_profile(wh, SECOND_RUN), W.load_meta(wh, "column_mapping"), dq._sources_frame(spark, SECOND_RUN))


def q_queue(spark: SparkSession, d: str) -> DataFrame:
    """Model answers queued twice, as by a job that is retried: the queue holds them once."""
    wh = loaded(spark, d)
    other = W.Warehouse(spark, wh.path(f"queue-{uuid.uuid4().hex[:6]}"))
    W.save_meta(other, "column_mapping", B.mapping_with_extras(spark))
    answers = B.responses(spark, d)
    for _ in range(2):
        jobs.propose(other, answers, QUEUE_NOW)
    return W.load_proposals(other)


QUERIES = {
    "dirty_landing": lambda s, d: first_landing(loaded(s, d)),
    "dirty_reloaded": lambda s, d: W.load_bronze(loaded(s, d)),
    "dirty_null_counts": lambda s, d: _measures(s, d).select(
        "SourceID", "Rows", "MinValue", *[F.col(f"bad_{c}").alias(f"Null{c}") for c in dq.NOT_NULL_COLUMNS]),
    "dirty_duplicate_grain": lambda s, d: dq.duplicate_grain(S.silver(W.load_bronze(loaded(s, d)), W.load_meta(loaded(s, d), "column_mapping"))),
    "dirty_log": lambda s, d: _log(loaded(s, d), B.RUN_NOW),
    "dirty_log_reloaded": lambda s, d: _log(loaded(s, d), SECOND_NOW),
    "dirty_verdicts": lambda s, d: dq.verdicts(_log(loaded(s, d), SECOND_NOW)),
    "dirty_dim_type": lambda s, d: gold.dim_type(W.load_meta(loaded(s, d), "column_mapping")),
    "queue_after_retry": q_queue,
}
