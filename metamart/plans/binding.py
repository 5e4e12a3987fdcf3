"""Driver binding: warehouse inputs derived from the given test tables.

Three wide landing sources come from ``lineitem`` joined to ``supplier``
(one per header language); the proposal queue and a validation-log history
come from ``events``.  Metadata rows (registry, key columns, mappings,
rules) are literals, as they are rows typed in by a person in production.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metamart import schemas
from metamart.sources.literal import local_frame

# ---------------------------------------------------------------------------
# Fixed values of the binding (must stay as they are for the expected counts)
# ---------------------------------------------------------------------------
# SourceId -> (name, path, sheet, plant header, month header,
#              Internal header prefix, External header prefix, active)
SOURCES = {
    1: ("Incidents", "Files/landing/source_1.xlsx", "Sheet1", "Plant", "Month",
        "Qty Int ", "Qty Ext ", True),
    2: ("Incidents Werk", "Files/landing/source_2.xlsx", "Sheet1", "Werk", "Monat",
        "Interne Menge ", "Externe Menge ", True),
    3: ("Incidents Usine", "Files/landing/source_3.xlsx", "Sheet1", "Usine", "Mois",
        "Quantité interne ", "Quantité externe ", True),
    4: ("Incidentes Planta", "Files/landing/source_4.xlsx", "Sheet1", "Planta", "Mes",
        "Incidentes internos ", "Incidentes externos ", False),
}
LANDED_SOURCES = (1, 2, 3)
CODE_GROUPS = ("A", "N", "R")
# l_linestatus -> classification
STATUS_CLASS = {"O": "Internal", "F": "External"}

# Six global rules: (RuleId, SourceId, RuleName, RuleType, TargetColumn,
#                    RuleParameters, Severity, IsActive)
RULES = [
    (1, None, "Headers known to the mapping", "SchemaDrift", None, "{}", "Warning", True),
    (2, None, "Some rows arrived", "RowCount", None, '{"min": 1}', "Error", True),
    (3, None, "Every row has a plant", "NotNull", "Plant", "{}", "Error", True),
    (4, None, "Counts from zero up", "Range", "Value", '{"min": 0}', "Error", True),
    (5, None, "One row per plant, month and type", "Unique", None, "{}", "Error", True),
    (6, None, "Mapped headers arrived", "MissingColumn", None, "{}", "Error", True),
]

# Fixed "now" of the binding's validation run (whole seconds, UTC).
RUN_NOW = datetime(2024, 2, 1, 6, 0, 0)


def header(source_id: int, classification: str, group: str) -> str:
    info = SOURCES[source_id]
    return (info[5] if classification == "Internal" else info[6]) + group


def mapping_rows() -> list[tuple]:
    """Column mappings: every header of sources 1 and 2, groups A and N of
    source 3, then one mapping to an absent column and one inactive one."""
    rows, mid = [], 0
    for sid, groups in ((1, CODE_GROUPS), (2, CODE_GROUPS), (3, ("A", "N"))):
        for cls in ("Internal", "External"):
            for g in groups:
                mid += 1
                rows.append((mid, sid, header(sid, cls, g), cls, g, True))
    rows.append((17, 2, "Externe Menge X", "External", "X", True))
    rows.append((18, 3, "Quantité interne R", "Internal", "R", False))
    return rows


def key_rows() -> list[tuple]:
    out = []
    for sid, info in SOURCES.items():
        out.append((sid, info[3], "Plant", "text"))
        out.append((sid, info[4], "Month", "date"))
    return out


def registry(spark: SparkSession) -> DataFrame:
    return local_frame(spark, [(sid, i[0], i[1], i[2], i[7]) for sid, i in SOURCES.items()],
                       schemas.SOURCE_REGISTRY)


def key_map(spark: SparkSession) -> DataFrame:
    return local_frame(spark, key_rows(), schemas.KEY_COLUMN_MAPPING)


def mapping(spark: SparkSession) -> DataFrame:
    return local_frame(spark, mapping_rows(), schemas.COLUMN_MAPPING)


def rules(spark: SparkSession) -> DataFrame:
    return local_frame(spark, RULES, schemas.DQ_RULES)


# ---------------------------------------------------------------------------
# Wide landing sources from lineitem x supplier
# ---------------------------------------------------------------------------
def _generic(cls: str, g: str) -> str:
    return f"{cls[:3]}_{g}"


def monthly_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(SourceID, Plant, Month, Int_A .. Ext_R) over all suppliers.

    lineitem is aggregated to (supplier, month) with six conditional sums
    *before* the join, so the join sees one row per supplier and month, not
    one per line; the second aggregate regroups by the plant name.
    """
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    sup = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_name")
    month = F.trunc(F.col("l_shipdate").cast("date"), "month")
    cells = []
    for status, cls in STATUS_CLASS.items():
        for g in CODE_GROUPS:
            cond = (F.col("l_linestatus") == status) & (F.col("l_returnflag") == g)
            cells.append(F.sum(F.when(cond, F.col("l_quantity"))).alias(_generic(cls, g)))
    # SourceID is an output of this aggregate (not a grouping expression),
    # so a per-source filter stops above it: the three sources' plans share
    # one exchange, and lineitem is scanned once for all of them
    pre = li.groupBy(F.col("l_suppkey"), month.alias("Month")).agg(
        *cells, F.min(F.col("l_suppkey") % 3 + 1).alias("SourceID"))
    joined = pre.join(sup, pre.l_suppkey == sup.s_suppkey)
    names = [_generic(c, g) for c in STATUS_CLASS.values() for g in CODE_GROUPS]
    return (joined.groupBy("SourceID", F.col("s_name").alias("Plant"), "Month")
            .agg(*[F.sum(n).cast("bigint").alias(n) for n in names]))


def wide_sources(spark: SparkSession, sf_dir: str, materialize: bool = False) -> dict[int, DataFrame]:
    """One wide frame per landed source, with that source's own headers.

    With ``materialize`` the shared monthly cells are written once to the
    checkpoint folder (one scan of lineitem for all three "files"), as
    landing files would be; otherwise each frame is a lazy plan.
    """
    cells = monthly_cells(spark, sf_dir)
    if materialize:
        cells = cells.checkpoint(eager=True)
    out = {}
    for sid in LANDED_SOURCES:
        info = SOURCES[sid]
        cols = [F.col("Plant").alias(info[3]), F.col("Month").alias(info[4])]
        for cls in STATUS_CLASS.values():
            for g in CODE_GROUPS:
                cols.append(F.col(_generic(cls, g)).alias(header(sid, cls, g)))
        out[sid] = cells.filter(F.col("SourceID") == F.lit(sid)).select(*cols)
    return out


# ---------------------------------------------------------------------------
# Proposals and a validation-log history from events
# ---------------------------------------------------------------------------
def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _k(col: str = "props") -> F.Column:
    return F.get_json_object(F.col(col), "$.k").cast("int")


def raw_proposals(spark: SparkSession, sf_dir: str, keep_event_id: bool = False) -> DataFrame:
    """One proposal per event (before the vocabulary filter)."""
    e = _events(spark, sf_dir)
    extra = [F.col("event_id")] if keep_event_id else []
    cls = F.element_at(F.array(F.lit("Internal"), F.lit("External"), F.lit("Other")),
                       (F.col("event_id") % 3 + 1).cast("int"))
    grp = F.element_at(F.array(*[F.lit(x) for x in ("A", "N", "R", "Z")]),
                       (F.col("event_id") % 4 + 1).cast("int"))
    return e.select(
        (F.col("user_id") % 3 + 1).cast("int").alias("SourceId"),
        F.concat(F.col("event_type"), F.lit(" "), (F.col("user_id") % 40).cast("string")).alias("SourceColumn"),
        cls.alias("Classification"),
        grp.alias("CodeGroup"),
        (_k() / F.lit(100)).cast("double").alias("Confidence"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("Rationale"),
        F.lit("fixture-model").alias("ModelName"),
        F.col("ts").cast("timestamp").alias("ProposedAt"),
        *extra,
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model answers as text: the proposals of one source and one block of 16
    consecutive events wrapped in one JSON document with prose around it
    (a block, not an hour, so that no answer grows with the data); every
    seventh block has an answer without braces.
    """
    p = raw_proposals(spark, sf_dir, keep_event_id=True)
    block = F.floor(F.col("event_id") / 16)
    item = F.to_json(F.struct(F.col("SourceColumn").alias("source_column"),
                              F.col("Classification").alias("classification"),
                              F.col("CodeGroup").alias("code_group"),
                              F.col("Confidence").alias("confidence"),
                              F.col("Rationale").alias("rationale")))
    grouped = (p.groupBy("SourceId", block.alias("Block"))
               .agg(F.min("ProposedAt").alias("RespondedAt"),
                    F.sort_array(F.collect_list(item)).alias("items")))
    doc = F.concat(F.lit('{"mappings": ['), F.array_join("items", ", "), F.lit("]}"))
    text = F.concat(F.lit("Here is the mapping you asked for:\n"), doc,
                    F.lit("\nLet me know if anything is unclear."))
    return grouped.select(
        "SourceId", F.lit("fixture-model").alias("ModelName"), "RespondedAt",
        F.when(F.col("Block") % 7 == 6, F.lit("Sorry, I could not map these columns."))
        .otherwise(text).alias("ResponseText"))


def validation_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A validation log with one row per event (run time = hour of the event)."""
    e = _events(spark, sf_dir)
    ts = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    sid = (F.col("user_id") % 3 + 1).cast("int")
    return e.select(
        F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-"), sid.cast("string")).alias("RunId"),
        ts.alias("RunTimestamp"),
        sid.alias("SourceId"),
        (F.col("event_id") % 6 + 1).cast("int").alias("RuleId"),
        F.col("event_type").alias("RuleName"),
        F.when(F.col("event_type") == "error", F.lit("Error")).otherwise(F.lit("Warning")).alias("Severity"),
        (F.col("value") >= _k()).alias("Passed"),
        F.concat(F.lit("value: "), F.format_string("%.2f", F.col("value"))).alias("Details"),
    )


# ---------------------------------------------------------------------------
# Metadata scenarios
# ---------------------------------------------------------------------------
# Two mappings for columns that proposals also name (one inactive), so that
# "already mapped" blocks approval; fixed values.
EXTRA_MAPPING_ROWS = [
    (19, 1, "click 3", "External", "A", True),
    (20, 2, "view 7", "Internal", "N", False),
]
# A key row left over for an id not in the registry (blocks that id).
LEFTOVER_KEY_ROWS = [(6, "Plant", "Plant", "text")]


def mapping_with_extras(spark: SparkSession) -> DataFrame:
    return local_frame(spark, mapping_rows() + EXTRA_MAPPING_ROWS, schemas.COLUMN_MAPPING)


def key_map_with_leftover(spark: SparkSession) -> DataFrame:
    return local_frame(spark, key_rows() + LEFTOVER_KEY_ROWS, schemas.KEY_COLUMN_MAPPING)


def register_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One registration request per supplier: every tenth asks for a path
    that is already registered; the others ask for one file per nation, so
    later requests of a nation repeat a path requested earlier."""
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    path = (F.when(F.col("s_suppkey") % 10 == 0,
                   F.concat(F.lit("Files/landing/source_"), (F.col("s_suppkey") % 3 + 1).cast("string"), F.lit(".xlsx")))
            .otherwise(F.concat(F.lit("Files/landing/nation_"), F.col("s_nationkey").cast("string"), F.lit(".xlsx"))))
    return s.select(F.col("s_suppkey").alias("RequestId"),
                    F.concat(F.lit("Incidents "), F.col("s_name")).alias("SourceName"),
                    path.alias("FilePath"), F.lit("Sheet1").alias("SheetName"),
                    F.lit("Plant").alias("PlantColumn"), F.lit("Month").alias("MonthColumn"))


def write_landing_files(wide: dict[int, DataFrame], folder: str) -> DataFrame:
    """Write each wide source as a CSV landing folder (header in every part
    file) and return the (SourceId, FilePath) rows that register them."""
    from concurrent.futures import ThreadPoolExecutor

    def one(item):
        sid, df = item
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/source_{sid}")

    with ThreadPoolExecutor(max_workers=max(1, len(wide))) as pool:
        list(pool.map(one, wide.items()))
    spark = next(iter(wide.values())).sparkSession
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    schema = StructType([StructField("SourceId", IntegerType()), StructField("FilePath", StringType())])
    return local_frame(spark, [(int(sid), f"source_{sid}") for sid in wide], schema)
