"""Warehouse storage: layers, bronze replace-by-source, audit and proposal
appends, versioned gold publish and the model scan (K2, A4..A12).

Tables are Parquet directories under one root (a shared filesystem or
object store path on a cluster):

* ``bronze/measures_raw/v=<version>/SourceID=<k>/`` -- the rows of a replace,
  ``bronze/profile/v=<version>/`` -- their column profiles, and
  ``bronze/_published/`` -- the manifest: one row makes the rows of all the sources of
  a replace current;
* ``audit/validation_log/RunId=<run>/`` and
  ``meta/column_mapping_proposal/Batch=<batch>/`` -- histories; a repeated run or
  batch replaces itself;
* ``meta/<table>/v=<version>/`` plus ``meta/_published/`` -- metadata tables,
  several of them published by one row;
* ``gold/v=<version>/<table>/`` plus ``gold/_published/`` -- an append-only
  list of published versions; readers resolve the newest one once.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Container, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType, TimestampType
from pyspark.errors import AnalysisException

from metamart import schemas
from metamart.operators.dq import NOT_NULL_COLUMNS, bronze_profile
from metamart.operators.gold import Star, contract_checks, raise_on_violations
from metamart.sources.literal import local_frame

LAYERS = ("bronze", "silver", "gold", "meta", "audit")
GOLD_TABLES = ("dim_plant", "dim_incident_type", "dim_date", "fact")
GOLD_PARTITIONS = {"fact": ("DateKey",)}
GOLD_CLUSTER = {"fact": ("DateKey", "PlantKey")}
META_SCHEMAS = {
    "source_registry": schemas.SOURCE_REGISTRY,
    "key_column_mapping": schemas.KEY_COLUMN_MAPPING,
    "column_mapping": schemas.COLUMN_MAPPING,
    "dq_rules": schemas.DQ_RULES,
}
_PUBLISHED = StructType([StructField("Version", StringType(), False),
                         StructField("PublishedAt", TimestampType(), False)])


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze_path(self) -> str:
        return self.path("bronze", "measures_raw")

    @property
    def log_path(self) -> str:
        return self.path("audit", "validation_log")

    @property
    def proposals_path(self) -> str:
        return self.path("meta", "column_mapping_proposal")


def ensure_layers(spark: SparkSession, root: str) -> Warehouse:
    """K2: the five namespaces, each located under the warehouse root."""
    wh = Warehouse(spark, root)
    for ns in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns} LOCATION '{wh.path(ns)}'")
    return wh


def _raise_unless_absent(e: AnalysisException) -> None:
    """A table that was never written is empty; any other error is an error."""
    if e.getCondition() != "PATH_NOT_FOUND":
        raise e


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        _raise_unless_absent(e)
        return local_frame(spark, [], schema)


# --------------------------------------------------------------------- meta
_META_PUBLISHED = StructType([StructField("Version", StringType(), False),
                              StructField("PublishedAt", TimestampType(), False),
                              StructField("Tables", ArrayType(StringType()), False)])


def load_meta(wh: Warehouse, name: str) -> DataFrame:
    """A4: a metadata table, as last published."""
    pub = _read(wh.spark, wh.path("meta", "_published"), _META_PUBLISHED)
    row = (pub.filter(F.array_contains("Tables", name))
           .agg(F.max_by("Version", F.struct("PublishedAt", "Version")).alias("v")).first())
    if row["v"] is None:
        return local_frame(wh.spark, [], META_SCHEMAS[name])
    return wh.spark.read.schema(META_SCHEMAS[name]).parquet(wh.path("meta", name, f"v={row['v']}"))


def save_meta(wh: Warehouse, name: str, df: DataFrame) -> None:
    """Rewrite one metadata table (see ``save_meta_tables``)."""
    save_meta_tables(wh, {name: df})


def save_meta_tables(wh: Warehouse, tables: Mapping[str, DataFrame]) -> None:
    """Rewrite metadata tables as one unit.  Each is written as a new version
    and checked against its contract (NOT NULL, VARCHAR lengths); one row then
    publishes all of them.  A violation, or a failure at any step before
    that row, leaves every table as it was."""
    version = uuid.uuid4().hex
    for name, df in tables.items():
        schema = META_SCHEMAS[name]
        path = wh.path("meta", name, f"v={version}")
        out = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        checks = [F.count_if(F.col(f.name).isNull()).alias(f"null:{f.name}") for f in schema.fields if not f.nullable]
        checks += [F.count_if(F.length(c) > n).alias(f"length>{n}:{c}") for c, n in schemas.META_LENGTHS[name].items()]
        obs = Observation(f"meta_{name}_{version[:8]}")
        out.observe(obs, F.count(F.lit(1)).alias("rows"), *checks).coalesce(1).write.parquet(path)
        raise_on_violations(name, {k: v for k, v in obs.get.items() if k != "rows"})
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    (wh.spark.createDataFrame([(version, now, list(tables))], _META_PUBLISHED)
     .coalesce(1).write.mode("append").parquet(wh.path("meta", "_published")))


def load_proposals(wh: Warehouse) -> DataFrame:
    """A5: the proposal queue."""
    return _read(wh.spark, wh.proposals_path, _QUEUE).select(*schemas.PROPOSALS.fieldNames())


# ------------------------------------------------------------------- bronze
# One row per replace: the version folder that now holds the rows of Sources;
# those of them without rows are not in WithRows.
_BRONZE_PUBLISHED = StructType([StructField("Version", StringType(), False),
                                StructField("PublishedAt", TimestampType(), False),
                                StructField("Sources", ArrayType(LongType()), False),
                                StructField("WithRows", ArrayType(LongType()), False)])
PROFILE = StructType([StructField("SourceID", LongType()), StructField("SourceColumn", StringType()),
                      StructField("n", LongType()), StructField("min_value", LongType()),
                      *[StructField(f"bad_{c}", LongType()) for c in NOT_NULL_COLUMNS]])


def bronze_manifest(wh: Warehouse) -> DataFrame:
    """(SourceID, Version, HasRows): where the rows of every source now are."""
    pub = _read(wh.spark, wh.path("bronze", "_published"), _BRONZE_PUBLISHED)
    each = pub.select("PublishedAt", "Version", "WithRows", F.explode("Sources").alias("SourceID"))
    last = each.groupBy("SourceID").agg(F.max_by(
        F.struct("Version", F.array_contains("WithRows", F.col("SourceID")).alias("HasRows")),
        F.struct("PublishedAt", "Version")).alias("m"))
    return last.select("SourceID", "m.Version", "m.HasRows")


def _current(wh: Warehouse) -> list[tuple[int, str]]:
    """(source, version) of every source that has rows: a row a source."""
    return [(r.SourceID, r.Version) for r in bronze_manifest(wh).filter("HasRows").orderBy("SourceID").collect()]


def load_bronze(wh: Warehouse) -> DataFrame:
    """The rows of every source's current version; a filter on SourceID prunes folders."""
    paths = [f"{wh.bronze_path}/v={v}/SourceID={sid}" for sid, v in _current(wh)]
    if not paths:
        return local_frame(wh.spark, [], schemas.BRONZE)
    schema = StructType([*schemas.BRONZE.fields, StructField("v", StringType())])
    rows = wh.spark.read.schema(schema).option("basePath", wh.bronze_path).parquet(*paths)
    return rows.select(*schemas.BRONZE.fieldNames())


def load_profile(wh: Warehouse, source_ids: Iterable[int] | None = None) -> DataFrame:
    """The column profiles (``dq.bronze_profile``) kept beside the current rows of the
    sources; no bronze row is read."""
    current = [(sid, v) for sid, v in _current(wh) if source_ids is None or sid in {int(s) for s in source_ids}]
    if not current:
        return local_frame(wh.spark, [], PROFILE)
    base = wh.path("bronze", "profile")
    schema = StructType([*PROFILE.fields, StructField("v", StringType())])
    rows = wh.spark.read.schema(schema).option("basePath", base).parquet(*sorted({f"{base}/v={v}" for _, v in current}))
    held = F.concat_ws("/", F.col("SourceID").cast("string"), "v").isin([f"{sid}/{v}" for sid, v in current])
    return rows.filter(held).drop("v")


def _publish_bronze(wh: Warehouse, version: str, ids: Iterable[int], present: Iterable[int]) -> None:
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    row = (version, now, sorted(ids), sorted(present))
    (wh.spark.createDataFrame([row], _BRONZE_PUBLISHED).coalesce(1)
     .write.mode("append").parquet(wh.path("bronze", "_published")))


def _finish_version(wh: Warehouse, version: str, ids: list[int], present: list[int]) -> list[int]:
    """Keep the profile of what was written, then publish: one row makes the new rows
    of all the sources current at once.  Returns the ids that are empty now."""
    if present:
        # the rows just written, read once; no validation reads them again
        rows = wh.spark.read.schema(schemas.BRONZE).parquet(f"{wh.bronze_path}/v={version}")
        profile = bronze_profile(rows, ids).select(*[F.col(f.name).cast(f.dataType) for f in PROFILE.fields])
        profile.write.parquet(wh.path("bronze", "profile", f"v={version}"))
    _publish_bronze(wh, version, ids, present)
    return [s for s in ids if s not in present]


def replace_sources(wh: Warehouse, parts: Mapping[int, DataFrame], parallelism: int = 4) -> None:
    """A6..A8: replace the bronze rows of each given source, leave the others.

    Every source's rows go to the folder of a new version, by jobs that run
    concurrently; one manifest row then makes them all current.  A failure before
    that row leaves every source as it was; a source without rows is empty
    afterwards (and the row-count rule fires); loading twice gives the rows once.
    """
    version = uuid.uuid4().hex

    def write(item: tuple[int, DataFrame]) -> int | None:
        sid, df = int(item[0]), item[1]
        obs = Observation(f"bronze_{version[:8]}_{sid}")
        part = df.filter(F.col("SourceID") == F.lit(sid)).select(
            *[F.col(f.name).cast(f.dataType) for f in schemas.BRONZE.fields if f.name != "SourceID"])
        part.observe(obs, F.count(F.lit(1)).alias("n")).write.parquet(f"{wh.bronze_path}/v={version}/SourceID={sid}")
        return sid if obs.get["n"] else None

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(parts)))) as pool:
        present = [s for s in pool.map(write, parts.items()) if s is not None]
    _finish_version(wh, version, sorted(int(s) for s in parts), present)


def replace_sources_bulk(wh: Warehouse, bronze_rows: DataFrame, source_ids) -> list[int]:
    """A8 for many sources in one job (see ``replace_sources``); which of them have
    rows is observed while writing.  Returns the ids that are empty now."""
    ids = sorted({int(s) for s in source_ids})
    version = uuid.uuid4().hex
    obs = Observation(f"bronze_{version[:8]}")
    cols = [F.col(f.name).cast(f.dataType) for f in schemas.BRONZE.fields]
    out = (bronze_rows.select(*cols).filter(F.col("SourceID").isin(ids))
           .observe(obs, F.collect_set("SourceID").alias("present")))
    out.write.partitionBy("SourceID").parquet(f"{wh.bronze_path}/v={version}")
    return _finish_version(wh, version, ids, [int(x) for x in (obs.get.get("present") or [])])


def delete_sources(wh: Warehouse, source_ids: Iterable[int]) -> None:
    """Drop the rows of the given sources, by one manifest row."""
    _publish_bronze(wh, uuid.uuid4().hex, {int(s) for s in source_ids}, [])


# -------------------------------------------------------------------- audit
def append_log(wh: Warehouse, log_rows: DataFrame) -> dict:
    """Add the rows of a validation run.  The log has a folder per RunId (run time
    and source): a run that is repeated replaces its own rows, every other row stays.
    Returns what was observed while writing: rows, and failed rows of severity Error."""
    cols = [F.col(f.name).cast(f.dataType) for f in schemas.VALIDATION_LOG.fields]
    obs = Observation(f"log_{uuid.uuid4().hex[:8]}")
    out = log_rows.select(*cols).observe(
        obs, F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("Passed") & (F.col("Severity") == "Error")).alias("failed_errors"))
    _replace_partitions(out.coalesce(1), "RunId", wh.log_path)
    return dict(obs.get)


def _replace_partitions(df: DataFrame, column: str, path: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path))


def load_log(wh: Warehouse) -> DataFrame:
    return _read(wh.spark, wh.log_path, schemas.VALIDATION_LOG).select(*schemas.VALIDATION_LOG.fieldNames())


_QUEUE = StructType([*schemas.PROPOSALS.fields, StructField("Batch", StringType())])


def append_proposals(wh: Warehouse, proposals: DataFrame, batch: str) -> None:
    """A10: add a batch of proposals to the queue.  The queue has a folder per batch: a
    batch that is queued again replaces itself."""
    cols = [F.col(f.name).cast(f.dataType) for f in schemas.PROPOSALS.fields]
    _replace_partitions(proposals.select(*cols, F.lit(batch).alias("Batch")), "Batch", wh.proposals_path)


# --------------------------------------------------------------------- gold
def _gold_path(wh: Warehouse, version: str, table: str) -> str:
    return wh.path("gold", f"v={version}", table)


def read_gold_version(wh: Warehouse, version: str) -> Star:
    s = {t: wh.spark.read.schema(schemas.GOLD_SCHEMAS[t]).parquet(_gold_path(wh, version, t))
         for t in GOLD_TABLES}
    return Star(fact=s["fact"], dim_plant=s["dim_plant"],
                dim_incident_type=s["dim_incident_type"], dim_date=s["dim_date"])


def write_gold_table(wh: Warehouse, version: str, table: str, df: DataFrame) -> tuple[DataFrame, dict]:
    """Write one gold table of a version; return it read back and the
    metrics observed while writing (row count and the K1 contract counts,
    computed in the same pass -- no second scan)."""
    schema = schemas.GOLD_SCHEMAS[table]
    obs = Observation(f"gold_{table}_{uuid.uuid4().hex[:8]}")
    out = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"), *contract_checks(table))
    if table in GOLD_PARTITIONS:
        # the fact is partitioned by day key: measures filtered on dates
        # prune whole directories (dynamic partition pruning on DateKey).
        # REBALANCE by the partition key sends each day to few tasks (few
        # files per directory); the adaptive planner splits a day that is
        # too large and merges small ones -- no sampling pass over the
        # input.  Files are sorted by plant for row-group skipping.
        part = GOLD_PARTITIONS[table]
        out = out.hint("rebalance", *part).sortWithinPartitions(*GOLD_CLUSTER[table])
        writer = out.write.mode("overwrite").partitionBy(*part)
    else:
        writer = out.write.mode("overwrite")
    writer.parquet(_gold_path(wh, version, table))
    return wh.spark.read.schema(schema).parquet(_gold_path(wh, version, table)), dict(obs.get)


def mark_published(wh: Warehouse, version: str) -> None:
    """Make a written version current: one row appended, last step."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    (wh.spark.createDataFrame([(version, now)], _PUBLISHED)
     .coalesce(1).write.mode("append").parquet(wh.path("gold", "_published")))


def current_version(wh: Warehouse) -> str | None:
    pub = _read(wh.spark, wh.path("gold", "_published"), _PUBLISHED)
    row = pub.agg(F.max_by("Version", F.struct("PublishedAt", "Version")).alias("v")).first()
    return None if row is None else row["v"]


def _fs(path: str):
    import pyarrow.fs as pafs
    if "://" in path and not path.startswith("file:"):
        scheme, rest = path.split("://", 1)
        return pafs.FileSystem.from_uri(("s3://" + rest) if scheme in ("s3a", "s3n") else path)
    return pafs.LocalFileSystem(), ("/" + path[5:].lstrip("/")) if path.startswith("file:") else path


def _drop_folders(wh: Warehouse, folders: Sequence[str], keep: Container[str], known: Container[str],
                  spare_hours: float) -> list[str]:
    """Delete version folders ``v=<version>`` below the given folders, but for those in
    ``keep``; folders that were never published (``known``) go once they are
    ``spare_hours`` old, so a load that is still running keeps what it writes."""
    import pyarrow.fs as pafs

    def newest(fs, path: str) -> float:
        times = [i.mtime.timestamp() for i in fs.get_file_info(pafs.FileSelector(path, recursive=True)) if i.mtime]
        return max(times, default=time.time())

    gone = set()
    for folder in folders:
        fs, base = _fs(folder)
        for e in fs.get_file_info(pafs.FileSelector(base, recursive=False, allow_not_found=True)):
            v = e.base_name[2:]
            if e.type != pafs.FileType.Directory or not e.base_name.startswith("v=") or v in keep:
                continue
            if v in known or time.time() - newest(fs, e.path) >= 3600 * spare_hours:
                fs.delete_dir(e.path)
                gone.add(v)
    return sorted(gone)


def prune_gold_versions(wh: Warehouse, keep: int = 2, spare_hours: float = 24.0) -> list[str]:
    """Delete gold version folders except the ``keep`` most recently
    published (and never the current one); see ``_drop_folders`` for versions that were
    never published (failed loads).  Returns what was
    deleted.  A reader still on the previous version is safe with keep >= 2.
    """
    pub = _read(wh.spark, wh.path("gold", "_published"), _PUBLISHED)
    recent = [r["Version"] for r in pub.orderBy(F.desc("PublishedAt"), F.desc("Version"))
              .select("Version").limit(max(1, keep)).collect()]
    known = {r["Version"] for r in pub.select("Version").distinct().collect()}      # one row per load
    return _drop_folders(wh, [wh.path("gold")], recent, known, spare_hours)


def prune_bronze_versions(wh: Warehouse, keep: int = 2, spare_hours: float = 24.0) -> list[str]:
    """Delete bronze versions in which no source is current and that are not among the
    ``keep`` published last (a reader may still be on those)."""
    pub = _read(wh.spark, wh.path("bronze", "_published"), _BRONZE_PUBLISHED)
    recent = {r["Version"] for r in pub.orderBy(F.desc("PublishedAt"), F.desc("Version"))
              .select("Version").limit(max(1, keep)).collect()}
    known = {r["Version"] for r in pub.select("Version").distinct().collect()}      # one row per replace
    return _drop_folders(wh, [wh.bronze_path, wh.path("bronze", "profile")], recent | {v for _, v in _current(wh)}, known,
                         spare_hours)


def prune_meta_versions(wh: Warehouse, keep: int = 2, spare_hours: float = 24.0) -> list[str]:
    """Delete versions of metadata tables but the ``keep`` published last of each table."""
    pub = _read(wh.spark, wh.path("meta", "_published"), _META_PUBLISHED)
    each = pub.select("Version", "PublishedAt", F.explode("Tables").alias("t"))
    newest = F.row_number().over(Window.partitionBy("t").orderBy(F.desc("PublishedAt"), F.desc("Version")))
    last = {(r.t, r.Version) for r in each.withColumn("k", newest).filter(F.col("k") <= max(1, keep)).collect()}
    known = {r["Version"] for r in pub.select("Version").distinct().collect()}      # one row per rewrite
    gone: set[str] = set()
    for name in META_SCHEMAS:
        gone |= set(_drop_folders(wh, [wh.path("meta", name)], {v for t, v in last if t == name}, known, spare_hours))
    return sorted(gone)


def load_star(wh: Warehouse) -> Star:
    """The four tables of the current gold version."""
    v = current_version(wh)
    if v is None:
        raise FileNotFoundError("no gold version has been published")
    return read_gold_version(wh, v)
