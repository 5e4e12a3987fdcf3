"""The scheduled load as one set-based run over all sources.

``ingest -> replace_sources -> run_validations -> append_log -> gate ->
load_gold``.  Each step writes a table, so a lost executor never costs more
than the step it was in.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metamart.operators import dq, gold
from metamart.operators.reshape import wide_to_bronze
from metamart.operators.silver import silver as silver_view
from metamart.sources import landing, warehouse as W


@dataclass(frozen=True)
class LoadResult:
    source_ids: tuple[int, ...]
    log: DataFrame                 # this run's log rows (read back)
    version: str | None            # published gold version, None when gated
    star: gold.Star | None


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)


def load_bronze_sources(wh: W.Warehouse, frames: Mapping[int, DataFrame],
                        key_map: DataFrame) -> list[int]:
    """Reshape every wide source and replace its bronze partition."""
    keys = landing.key_meta_all(key_map, frames.keys())
    parts = {int(sid): wide_to_bronze(df, int(sid), keys[int(sid)]) for sid, df in frames.items()}
    W.replace_sources(wh, parts)
    return sorted(parts)


def validate(wh: W.Warehouse, mapping: DataFrame, rules: DataFrame,
             source_ids, now: datetime) -> DataFrame:
    """Run all rules for the sources on their kept profiles, log the rows, return them
    (read back from the log, only the folders of this run)."""
    now = now.replace(microsecond=0)
    ids = [int(s) for s in source_ids]
    rows = dq.run_validations(W.load_bronze(wh), mapping, rules, ids, now, profile=W.load_profile(wh, ids))
    W.append_log(wh, rows)
    return W.load_log(wh).filter(F.col("RunId").isin([f"{now.strftime('%Y-%m-%dT%H:%M:%S')}-{s}" for s in ids]))


def load_gold(wh: W.Warehouse, mapping: DataFrame, version: str | None = None,
              keep_versions: int | None = None) -> tuple[str, gold.Star]:
    """Build the star from silver, write it as a new version, check the
    contract on what was written (observed during the writes), then publish
    (last step).  On any failure the previous version stays current.  With
    ``keep_versions`` older version folders are deleted after publishing."""
    version = version or f"{utc_now().strftime('%Y%m%dT%H%M%S')}-{uuid.uuid4().hex[:8]}"
    s = silver_view(W.load_bronze(wh), mapping)
    # plants x years: small, feeds both dimensions; materialised once
    py = gold.plant_years(s).checkpoint(eager=True)
    dims = {"dim_plant": gold.dim_plant(s, py), "dim_incident_type": gold.dim_type(mapping),
            "dim_date": gold.dim_date(s, py)}
    with ThreadPoolExecutor(max_workers=len(dims)) as pool:   # independent jobs, run together
        futures = {n: pool.submit(W.write_gold_table, wh, version, n, df) for n, df in dims.items()}
        written = {n: f.result() for n, f in futures.items()}
    for name, (_, metrics) in written.items():
        gold.raise_on_violations(name, metrics)
    dp, dt, dd = (written[n][0] for n in ("dim_plant", "dim_incident_type", "dim_date"))
    f, metrics = W.write_gold_table(wh, version, "fact", gold.fact(s, dp, dd, dt))
    gold.raise_on_violations("fact", metrics)
    W.mark_published(wh, version)
    if keep_versions:
        W.prune_gold_versions(wh, keep_versions)
        W.prune_bronze_versions(wh, keep_versions)
        W.prune_meta_versions(wh, keep_versions)
    return version, W.read_gold_version(wh, version)


def run_landing(wh: W.Warehouse, sources: DataFrame, key_map: DataFrame, mapping: DataFrame,
                rules: DataFrame, landing_root: str = "", now: datetime | None = None,
                use_gate: bool = True, keep_versions: int | None = None) -> LoadResult:
    """The scheduled load over registered CSV landing files: one scan of all
    files, one bronze write (published by one manifest row, empty files
    emptied), then validation, gate and gold as in ``run``."""
    now = now or utc_now()
    ids = sorted(int(r["SourceId"]) for r in sources.select("SourceId").collect())
    W.replace_sources_bulk(wh, landing.ingest_landing(wh.spark, sources, key_map, landing_root), ids)
    return _validate_then_gold(wh, mapping, rules, ids, now, use_gate, keep_versions)


def _validate_then_gold(wh: W.Warehouse, mapping: DataFrame, rules: DataFrame, ids, now: datetime,
                        use_gate: bool, keep_versions: int | None = None) -> LoadResult:
    """With the gate, gold waits for the verdict of the written log.  Without it the two
    steps only share the (written) bronze table, so they run as concurrent jobs."""
    if use_gate:
        log = validate(wh, mapping, rules, ids, now)
        dq.gate(log)
        version, star = load_gold(wh, mapping, keep_versions=keep_versions)
        return LoadResult(tuple(ids), log, version, star)
    with ThreadPoolExecutor(max_workers=2) as pool:
        f_log = pool.submit(validate, wh, mapping, rules, ids, now)
        f_gold = pool.submit(load_gold, wh, mapping, None, keep_versions)
        log, (version, star) = f_log.result(), f_gold.result()
    return LoadResult(tuple(ids), log, version, star)


def run(wh: W.Warehouse, frames: Mapping[int, DataFrame], key_map: DataFrame,
        mapping: DataFrame, rules: DataFrame, now: datetime | None = None,
        use_gate: bool = True) -> LoadResult:
    """Load the given sources end to end.  With the gate on, an Error rule
    that failed raises ``ValidationFailed`` after the log is written and
    before gold is touched."""
    now = now or utc_now()
    ids = load_bronze_sources(wh, frames, key_map)
    return _validate_then_gold(wh, mapping, rules, ids, now, use_gate)
