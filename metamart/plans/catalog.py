"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All of them read the given tables through the driver binding, so their
work grows with the data.  Column names match ``oracle.SQL``.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metamart.operators import dq, gold, measures as M, meta, proposals as P, reports, silver as S
from metamart.plans import binding as B, pipeline
from metamart.session import ensure_checkpoint_dir
from metamart.sources import landing, warehouse as W

Query = Callable[[SparkSession, str], DataFrame]
Y1998 = M.FilterContext(years=(1998,))


# ------------------------------------------------------------ shared frames
_LOADS: dict[tuple[str, str], pipeline.LoadResult] = {}
_WAREHOUSES: dict[tuple[str, str], W.Warehouse] = {}
_LANDING: dict[tuple[str, str], DataFrame] = {}
_LOCK = threading.Lock()


def loaded(spark: SparkSession, d: str) -> tuple[W.Warehouse, pipeline.LoadResult]:
    """The binding loaded once per Spark application and data folder: bronze
    table, validation log and a published gold version, written under the
    shared folder named by ``spark.checkpoint.dir``.  Queries then read
    these tables, as reports read a warehouse."""
    key = (spark.sparkContext.applicationId, os.path.abspath(d))
    with _LOCK:
        if key not in _LOADS:
            tag = hashlib.sha1(key[1].encode()).hexdigest()[:12]
            root = f"{ensure_checkpoint_dir(spark)}/metamart-{key[0]}/{tag}-{uuid.uuid4().hex[:6]}"
            wh = W.Warehouse(spark, root)
            # the binding's sources land as CSV files, as spreadsheets would
            registered = B.write_landing_files(B.wide_sources(spark, d, materialize=True), wh.path("landing"))
            # the binding's source 2 fails an Error rule on purpose: gold is
            # built without the gate here; the gate is tested on its own
            _LOADS[key] = pipeline.run_landing(wh, registered, B.key_map(spark), B.mapping(spark),
                                               B.rules(spark), wh.path("landing"), B.RUN_NOW, use_gate=False)
            _WAREHOUSES[key] = wh
            _LANDING[key] = registered
        return _WAREHOUSES[key], _LOADS[key]


def bronze_landing(spark: SparkSession, d: str) -> DataFrame:
    """The one-scan ingest of the binding's CSV landing files."""
    wh, _ = loaded(spark, d)
    key = (spark.sparkContext.applicationId, os.path.abspath(d))
    return landing.ingest_landing(spark, _LANDING[key], B.key_map(spark), wh.path("landing"))


def bronze_table(spark: SparkSession, d: str) -> DataFrame:
    return W.load_bronze(loaded(spark, d)[0])


def bronze(spark: SparkSession, d: str) -> DataFrame:
    """Lazy ingest straight from the wide sources (the unpivot path)."""
    return landing.ingest(B.wide_sources(spark, d), B.key_map(spark))


def silver(spark: SparkSession, d: str) -> DataFrame:
    return S.silver(bronze_table(spark, d), B.mapping(spark))


def star(spark: SparkSession, d: str) -> gold.Star:
    """The gold version this session published (resolved once, at load)."""
    wh, result = loaded(spark, d)
    return W.read_gold_version(wh, result.version)


def validation_log(spark: SparkSession, d: str) -> DataFrame:
    return dq.run_validations(bronze_table(spark, d), B.mapping(spark), B.rules(spark),
                              list(B.LANDED_SOURCES), B.RUN_NOW, profile=_profile(spark, d))


def _profile(spark: SparkSession, d: str) -> DataFrame:
    return W.load_profile(loaded(spark, d)[0], B.LANDED_SOURCES)


def _source_measures(spark: SparkSession, d: str) -> DataFrame:
    sources = dq._sources_frame(spark, list(B.LANDED_SOURCES))
    return dq.source_measures(_profile(spark, d), B.mapping(spark), sources)


# ------------------------------------------------------------------ queries
def q_active_sources(spark, d):
    wide_rows = (B.monthly_cells(spark, d).groupBy(F.col("SourceID").cast("int").alias("SourceId"))
                 .agg(F.count(F.lit(1)).alias("LandingRows")))
    return (landing.active_sources(B.registry(spark)).join(wide_rows, "SourceId", "left")
            .select("SourceId", "SourceName", "FilePath", "SheetName",
                    F.coalesce("LandingRows", F.lit(0)).cast("bigint").alias("LandingRows")))


def q_bronze_replace(spark, d):
    """Reload source 2 from the same file and source 3 from an empty one."""
    wides = B.wide_sources(spark, d)
    reload = {2: wides[2], 3: wides[3].filter(F.lit(False))}     # source 3's file is now empty
    new = landing.ingest(reload, B.key_map(spark))
    return landing.replace_rows(bronze_table(spark, d), new, list(reload))


def q_unmapped(spark, d):
    return S.unmapped_columns(_profile(spark, d), B.mapping(spark))


def q_missing(spark, d):
    return S.missing_columns(_profile(spark, d), B.mapping(spark), list(B.LANDED_SOURCES))


def q_null_counts(spark, d):
    return _source_measures(spark, d).select(
        "SourceID", *[F.col(f"bad_{c}").alias(f"Null{c}") for c in dq.NOT_NULL_COLUMNS])


def q_row_counts(spark, d):
    return _source_measures(spark, d).select("SourceID", "Rows")


def q_min_value(spark, d):
    return _source_measures(spark, d).select("SourceID", "MinValue")


def q_duplicate_grain(spark, d):
    return dq.duplicate_grain(silver(spark, d))


def q_failed_rules(spark, d):
    return dq.failed_rules(B.validation_history(spark, d))


def q_latest_run(spark, d):
    return dq.latest_run(B.validation_history(spark, d))


def q_latest_run_per_source(spark, d):
    return dq.latest_run_per_source(B.validation_history(spark, d))


def q_log_report(spark, d):
    return dq.log_report(B.validation_history(spark, d))


def q_rule_history(spark, d):
    return dq.rule_history(B.validation_history(spark, d), rule_name="error")


def q_periods(spark, d):
    return gold.periods(silver(spark, d))


def q_fact(spark, d):
    return star(spark, d).fact


def q_gold_counts(spark, d):
    return gold.gold_counts(star(spark, d))


def q_measure_totals(spark, d):
    return M.totals(star(spark, d))


def q_measure_split(spark, d):
    return M.totals(star(spark, d), by=["Year"])


def q_yoy_by_year(spark, d):
    return M.year_over_year(star(spark, d), by=["Year"])


def q_yoy_total(spark, d):
    return M.year_over_year(star(spark, d))


def q_yoy_by_plant(spark, d):
    return (M.year_over_year(star(spark, d), Y1998, by=["PlantCode"])
            .select("PlantCode", "Incidents", "Incidents_PY", "Incidents_Chg", "Incidents_Pct_Chg"))


def q_yoy_split(spark, d):
    return M.year_over_year(star(spark, d), Y1998)


def q_latest_month(spark, d):
    return M.latest_month(star(spark, d))


def q_latest_month_year(spark, d):
    return M.latest_month(star(spark, d), by=["Year"])


def q_mom_by_plant(spark, d):
    return M.latest_month(star(spark, d), by=["PlantCode"])


def q_kpi_labels(spark, d):
    st = star(spark, d)
    labels = M.selected_year(st, by=["Year"])
    month = M.latest_month(st, by=["Year"]).select("Year", "Latest_Month_Label2")
    return labels.join(month, "Year", "left")


def q_overview_signal(spark, d):
    return M.overview_signal(star(spark, d), by=["Year"])


def q_trend(spark, d):
    return reports.trend_month_class(star(spark, d))


def q_plant_class(spark, d):
    return reports.plant_class(star(spark, d))


def q_plant_class_1998(spark, d):
    return reports.plant_class(star(spark, d), Y1998)


def q_yoy_by_plant_internal(spark, d):
    """Slicers year 1998 and classification Internal: the External measures
    are blank (intersecting filter)."""
    ctx = M.FilterContext(years=(1998,), classes=("Internal",))
    return (M.year_over_year(star(spark, d), ctx, by=["PlantCode"])
            .select("PlantCode", "Incidents", "Incidents_PY", "Internal", "Internal_PY", "Internal_Chg",
                    "External", "External_PY"))


def q_incident_mix(spark, d):
    return reports.incident_mix(star(spark, d))


def q_kpi_status(spark, d):
    return reports.kpi_status(star(spark, d), by=["Year"])


def q_kpi_cards(spark, d):
    return reports.kpi_cards(star(spark, d), Y1998)


def q_slicer_options(spark, d):
    return reports.slicer_options(star(spark, d))


def q_end_to_end(spark, d):
    b = bronze_table(spark, d)
    s = S.silver(b, B.mapping(spark))
    f = star(spark, d).fact
    def one(name, df, col):
        return df.agg(F.lit(name).alias("Stage"), F.count(F.lit(1)).alias("Rows"),
                      F.sum(col).cast("bigint").alias("ValueSum"))
    return (one("bronze", b, "Value").unionByName(one("silver", s, "Incidents"))
            .unionByName(one("fact", f, "Incidents")))


QUERIES: dict[str, Query] = {
    "active_sources": q_active_sources,
    "bronze_unpivot": bronze,
    "bronze_landing": bronze_landing,
    "bronze_replace": q_bronze_replace,
    "silver": silver,
    "unmapped_columns": q_unmapped,
    "missing_columns": q_missing,
    "null_counts": q_null_counts,
    "row_counts": q_row_counts,
    "min_value": q_min_value,
    "duplicate_grain": q_duplicate_grain,
    "validation_log": validation_log,
    "failed_rules": q_failed_rules,
    "latest_run": q_latest_run,
    "latest_run_per_source": q_latest_run_per_source,
    "log_report": q_log_report,
    "rule_history": q_rule_history,
    "dim_plant": lambda s, d: star(s, d).dim_plant,
    "dim_type": lambda s, d: star(s, d).dim_incident_type,
    "dim_date": lambda s, d: star(s, d).dim_date,
    "periods": q_periods,
    "fact": q_fact,
    "gold_counts": q_gold_counts,
    "measure_totals": q_measure_totals,
    "measure_split": q_measure_split,
    "yoy_by_year": q_yoy_by_year,
    "yoy_total": q_yoy_total,
    "yoy_by_plant": q_yoy_by_plant,
    "yoy_split": q_yoy_split,
    "latest_month": q_latest_month,
    "latest_month_year": q_latest_month_year,
    "mom_by_plant": q_mom_by_plant,
    "kpi_labels": q_kpi_labels,
    "overview_signal": q_overview_signal,
    "trend_month_class": q_trend,
    "plant_class": q_plant_class,
    "incident_mix": q_incident_mix,
    "plant_class_1998": q_plant_class_1998,
    "yoy_by_plant_internal": q_yoy_by_plant_internal,
    "kpi_status": q_kpi_status,
    "kpi_cards": q_kpi_cards,
    "slicer_options": q_slicer_options,
    "end_to_end_totals": q_end_to_end,
}


def q_yoy_daily(spark, d):
    """Prior year at day grain: 1997 against the leap year 1996, by month."""
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    sup = spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", "s_name")
    cls = F.when(F.col("l_linestatus") == "O", F.lit("Internal")).otherwise(F.lit("External"))
    daily = li.join(sup, li.l_suppkey == sup.s_suppkey).groupBy(
        F.col("s_name").alias("Plant"), F.col("l_shipdate").cast("date").alias("Month"), cls.alias("Classification"),
        F.col("l_returnflag").alias("CodeGroup")).agg(F.sum("l_quantity").cast("bigint").alias("Incidents"))
    return M.year_over_year(gold.build_star(daily, B.mapping(spark)), M.FilterContext(years=(1997,)), ("MonthShort",))


QUERIES["yoy_daily"] = q_yoy_daily


# ------------------------------------------------------- metadata, proposals
def _vocab(spark, d):
    return P.vocabulary(B.mapping_with_extras(spark))


def _queue(spark, d):
    """The proposal queue: event proposals that pass the vocabulary filter."""
    return P.valid_proposals(B.raw_proposals(spark, d), _vocab(spark, d))


def _approved(spark, d):
    return meta.approve_proposals(_queue(spark, d), B.mapping_with_extras(spark))


def q_register_sources(spark, d):
    return meta.register_sources(B.registry(spark), B.key_map_with_leftover(spark),
                                 B.register_requests(spark, d)).result


def q_pending(spark, d):
    return meta.pending_proposals(_queue(spark, d), B.mapping_with_extras(spark))


def q_mapping_changes(spark, d):
    """Insert the approved proposals, deactivate mappings whose column did
    not arrive, activate inactive mappings whose column did arrive."""
    mx = B.mapping_with_extras(spark)
    pairs = S.column_pairs(bronze_table(spark, d))
    ins = _approved(spark, d).select("MappingId", F.lit("insert").alias("Action"), "SourceId",
                                     "SourceColumn", "Classification", "CodeGroup")
    missing = S.missing_columns(pairs, mx, list(B.LANDED_SOURCES))
    deact = (mx.filter("IsActive").join(missing.select(F.col("SourceID").cast("int").alias("SourceId"), "SourceColumn"),
                                        ["SourceId", "SourceColumn"], "left_semi")
             .select("MappingId", F.lit("deactivate").alias("Action")))
    arrived = pairs.select(F.col("SourceID").cast("int").alias("SourceId"), "SourceColumn")
    act = (mx.filter(~F.col("IsActive")).join(arrived, ["SourceId", "SourceColumn"], "left_semi")
           .select("MappingId", F.lit("activate").alias("Action")))
    empty = {c: F.lit(None).cast(t) for c, t in (("SourceId", "int"), ("SourceColumn", "string"),
                                                 ("Classification", "string"), ("CodeGroup", "string"))}
    changes = ins.unionByName(deact.withColumns(empty)).unionByName(act.withColumns(empty))
    return meta.apply_mapping_changes(mx, changes)


def q_set_active(spark, d):
    landed = B.monthly_cells(spark, d).select(F.col("SourceID").cast("int").alias("SourceId"))
    return meta.set_active(B.registry(spark), landed, False)


def q_meta_counts(spark, d):
    # counted before the key step: ids are not needed
    mx = B.mapping_with_extras(spark)
    mapping_after = mx.select("SourceId").unionByName(meta.approvable(_queue(spark, d), mx).select("SourceId"))
    return meta.meta_counts({
        "SourceRegistry": B.registry(spark), "KeyColumnMapping": B.key_map(spark),
        "ColumnMapping": mapping_after, "DQRules": B.rules(spark),
        "ValidationLog": B.validation_history(spark, d)})


def q_vocabulary(spark, d):
    mx = B.mapping_with_extras(spark)
    fresh = meta.approvable(_queue(spark, d), mx)
    return P.vocabulary(mx.select(fresh.columns).unionByName(fresh))


def q_parse(spark, d):
    return P.parse_proposals(B.responses(spark, d))


def q_valid(spark, d):
    return _queue(spark, d)


def q_stats(spark, d):
    return P.proposal_stats(B.raw_proposals(spark, d), _vocab(spark, d))


QUERIES.update({
    "register_sources": q_register_sources,
    "approve_proposals": _approved,
    "pending_proposals": q_pending,
    "mapping_changes": q_mapping_changes,
    "set_active": q_set_active,
    "meta_counts": q_meta_counts,
    "vocabulary": q_vocabulary,
    "parse_proposals": q_parse,
    "valid_proposals": q_valid,
    "proposal_stats": q_stats,
})
