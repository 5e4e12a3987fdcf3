"""Warehouse jobs: the stored procedures and the scheduled load, run
against the metadata tables kept in the warehouse (``meta/``).

    init_warehouse  -> layers + metadata tables
    register        -> H1, rows added to the registry and key columns
    load            -> the scheduled load over the active sources' files
    propose         -> N4..N7 + A10: model answers to the proposal queue
    pending         -> H3
    approve         -> H2, rows added to the column mappings
    reload_gold     -> G7 only (after an approval; bronze is not reloaded)
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metamart.operators import meta, proposals as P
from metamart.plans import pipeline
from metamart.sources import landing, warehouse as W


def init_warehouse(spark: SparkSession, root: str, registry: DataFrame, key_map: DataFrame,
                   mapping: DataFrame, rules: DataFrame) -> W.Warehouse:
    wh = W.ensure_layers(spark, root)
    W.save_meta_tables(wh, {"source_registry": registry, "key_column_mapping": key_map,
                            "column_mapping": mapping, "dq_rules": rules})
    return wh


def register(wh: W.Warehouse, requests: DataFrame) -> DataFrame:
    """Register new source files; returns every request with its status."""
    reg, keys = W.load_meta(wh, "source_registry"), W.load_meta(wh, "key_column_mapping")
    # decided once and materialised, before any table is rewritten
    result = meta.register_sources(reg, keys, requests).result.checkpoint(eager=True)
    rows = meta.registration_rows(result)
    W.save_meta_tables(wh, {"source_registry": reg.unionByName(rows.registry_rows),
                            "key_column_mapping": keys.unionByName(rows.key_rows)})
    return result


KEEP_VERSIONS = 2     # the current gold version and the one before it


def load(wh: W.Warehouse, landing_root: str = "", now: datetime | None = None,
         use_gate: bool = True) -> pipeline.LoadResult:
    """Reload every active source from its landing file, validate, gate, gold."""
    sources = landing.active_sources(W.load_meta(wh, "source_registry")).select("SourceId", "FilePath")
    return pipeline.run_landing(wh, sources, W.load_meta(wh, "key_column_mapping"),
                                W.load_meta(wh, "column_mapping"), W.load_meta(wh, "dq_rules"),
                                landing_root, now, use_gate, KEEP_VERSIONS)


def batch_of(responses: DataFrame) -> str:
    """A name for a set of model answers: the same answers have the same name."""
    code = F.xxhash64("SourceId", "ModelName", "ResponseText")
    row = responses.agg(F.bit_xor(code).alias("x"), F.count(F.lit(1)).alias("n")).first()
    return f"{(row['x'] or 0) & 0xFFFFFFFFFFFFFFFF:016x}-{row['n']}"


def propose(wh: W.Warehouse, responses: DataFrame, now: datetime | None = None, batch: str | None = None) -> DataFrame:
    """Parse model answers, keep those inside the vocabulary, queue them as one batch
    (by default named after the answers, so that a repeated run queues nothing twice).
    Returns the per-source statistics (proposed, valid, rejected)."""
    now = now or pipeline.utc_now()
    parsed = P.parse_proposals(responses).checkpoint(eager=True)
    vocab = P.vocabulary(W.load_meta(wh, "column_mapping"))
    W.append_proposals(wh, P.to_queue(P.valid_proposals(parsed, vocab), now), batch or batch_of(responses))
    return P.proposal_stats(parsed, vocab)


def pending(wh: W.Warehouse) -> DataFrame:
    return meta.pending_proposals(W.load_proposals(wh), W.load_meta(wh, "column_mapping"))


def approve(wh: W.Warehouse, source_ids: Sequence[int] | None = None,
            min_confidence: float = meta.DEFAULT_MIN_CONFIDENCE) -> DataFrame:
    """Promote the latest confident proposals; idempotent.  Returns the rows added."""
    mapping = W.load_meta(wh, "column_mapping")
    new = meta.approve_proposals(W.load_proposals(wh), mapping, source_ids, min_confidence)
    new = new.checkpoint(eager=True)
    W.save_meta(wh, "column_mapping", mapping.unionByName(new))
    return new


def set_active(wh: W.Warehouse, source_ids: Sequence[int], flag: bool) -> None:
    """H5: (de)activate sources.  Inactive sources are not reloaded, but
    their bronze rows stay visible."""
    W.save_meta(wh, "source_registry", meta.set_active(W.load_meta(wh, "source_registry"), source_ids, flag))


def change_mappings(wh: W.Warehouse, changes: DataFrame) -> None:
    """H4: apply a change table (insert / activate / deactivate / delete)."""
    W.save_meta(wh, "column_mapping", meta.apply_mapping_changes(W.load_meta(wh, "column_mapping"), changes))


def reload_gold(wh: W.Warehouse) -> tuple[str, object]:
    """Rebuild and publish gold from bronze and the current mappings."""
    return pipeline.load_gold(wh, W.load_meta(wh, "column_mapping"), keep_versions=KEEP_VERSIONS)
