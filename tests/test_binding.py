"""FIXTURES section 4 counts at sf0.001 and the driver contract."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from metamart.operators import meta, proposals as P
from metamart.plans import binding as B, catalog
from tests.conftest import SF0001


def test_bronze_and_silver_counts(spark):
    b = catalog.bronze(spark, SF0001)
    per = {r.SourceID: r["count"] for r in b.groupBy("SourceID").count().collect()}
    assert per == {1: 1371, 2: 1040, 3: 1037}
    agg = b.agg(F.sum("Value"), F.min("Value"), F.max("Value")).first()
    assert tuple(agg) == (152257, 1, 258)
    s = catalog.silver(spark, SF0001)
    assert tuple(s.agg(F.count(F.lit(1)), F.sum("Incidents")).first()) == (3093, 136435)
    assert s.select("Plant").distinct().count() == 10
    wide_cells = sum(df.count() * (len(df.columns) - 2) for df in B.wide_sources(spark, SF0001).values())
    assert wide_cells == 4956


def test_validation_outcome_of_the_binding(spark):
    failed = {(r.SourceId, r.RuleId): r.Details
              for r in catalog.validation_log(spark, SF0001).filter(~F.col("Passed")).collect()}
    assert failed == {(2, 6): "missing columns: 1; Externe Menge X",
                      (3, 1): "unmapped columns: 2; Quantité externe R, Quantité interne R"}


def test_proposal_and_log_counts(spark):
    raw = B.raw_proposals(spark, SF0001)
    valid = P.valid_proposals(raw, P.vocabulary(B.mapping(spark)))
    assert (raw.count(), valid.count()) == (1000, 500)
    latest = meta.latest_proposals(valid)
    assert (latest.count(), latest.filter("Confidence >= 0.9").count()) == (75, 10)
    log = B.validation_history(spark, SF0001)
    assert log.count() == 1000
    assert log.filter(~F.col("Passed")).count() == 536
    assert log.filter(~F.col("Passed") & (F.col("Severity") == "Error")).count() == 117


def test_entry_contract(spark):
    df = E.entry(spark)
    assert df.count() == 24
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 45
