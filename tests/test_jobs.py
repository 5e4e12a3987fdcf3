"""The warehouse jobs end to end, metadata kept in the warehouse."""

from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from metamart import schemas
from metamart.plans import jobs
from metamart.sources import warehouse as W
from tests.helpers import SIX_RULES, rules
from tests.test_landing_bulk import write_csv

HEAD = {1: ("Plant", "Month", "Qty I", "Qty E"), 2: ("Werk", "Monat", "Menge I", "Menge E")}


def landing_file(path, sid, plants, year):
    write_csv(path, list(HEAD[sid]), [[p, f"{year}-{m:02d}-01", m, 2 * m] for p in plants for m in range(1, 13)])


def test_jobs_register_load_propose_approve(spark, tmp_path, root):
    land = tmp_path / "landing"
    land.mkdir()
    landing_file(land / "s1.csv", 1, ["A", "B"], 2020)
    landing_file(land / "s2.csv", 2, ["W"], 2021)
    reg = spark.createDataFrame([(1, "one", "s1.csv", "Sheet1", True)], schemas.SOURCE_REGISTRY)
    keys = spark.createDataFrame([(1, "Plant", "Plant", "text"), (1, "Month", "Month", "date")],
                                 schemas.KEY_COLUMN_MAPPING)
    m = spark.createDataFrame([(1, 1, "Qty I", "Internal", "01", True), (2, 1, "Qty E", "External", "01", True)],
                              schemas.COLUMN_MAPPING)
    wh = jobs.init_warehouse(spark, root, reg, keys, m, rules(spark, SIX_RULES))
    req = spark.createDataFrame([(1, "two", "s2.csv", "Sheet1", "Werk", "Monat")],
                                "RequestId long, SourceName string, FilePath string, SheetName string, "
                                "PlantColumn string, MonthColumn string")
    assert [tuple(r) for r in jobs.register(wh, req).select("Status", "SourceId").collect()] == [("registered", 2)]
    r = jobs.load(wh, str(land), datetime(2024, 5, 1, 8))
    assert r.star.fact.count() == 48                      # source 2 not mapped yet
    assert r.log.filter((F.col("SourceId") == 2) & (F.col("RuleId") == 1)).first().Passed is False
    answer = ('{"mappings": [{"source_column": "Menge I", "classification": "Internal", "code_group": "01", '
              '"confidence": 0.97}, {"source_column": "Menge E", "classification": "External", '
              '"code_group": "01", "confidence": 0.93}]}')
    resp = spark.createDataFrame([(2, "m", answer)], "SourceId int, ModelName string, ResponseText string")
    stats = jobs.propose(wh, resp, datetime(2024, 5, 1, 9)).first()
    assert (stats.Proposed, stats.Valid) == (2, 2)
    assert jobs.pending(wh).count() == 2
    assert jobs.approve(wh, [2]).count() == 2
    assert jobs.approve(wh, [2]).count() == 0
    version, star = jobs.reload_gold(wh)
    assert star.fact.count() == 72 and W.current_version(wh) == version
    again = jobs.load(wh, str(land), datetime(2024, 5, 1, 10))
    assert again.log.filter(~F.col("Passed")).count() == 0
    # an inactive source is not reloaded, but its rows stay visible
    jobs.set_active(wh, [2], False)
    landing_file(land / "s2.csv", 2, ["W", "V"], 2021)          # would add rows if reloaded
    third = jobs.load(wh, str(land), datetime(2024, 5, 1, 11))
    assert third.source_ids == (1,)
    assert third.star.fact.count() == 72
    changes = spark.createDataFrame([(1, "deactivate", None, None, None, None)],
                                    "MappingId int, Action string, SourceId int, SourceColumn string, "
                                    "Classification string, CodeGroup string")
    jobs.change_mappings(wh, changes)
    assert jobs.reload_gold(wh)[1].fact.count() == 48


def test_metadata_contract_on_rewrite(spark, root):
    import pytest
    from metamart.operators.gold import ContractViolation
    wh = W.ensure_layers(spark, root)
    ok = spark.createDataFrame([(1, 1, "a", "Internal", "01", True)], schemas.COLUMN_MAPPING)
    W.save_meta(wh, "column_mapping", ok)
    too_long = spark.createDataFrame([(2, 1, "x" * 201, "Internal", "01", True)], schemas.COLUMN_MAPPING)
    with pytest.raises(ContractViolation, match="SourceColumn"):
        W.save_meta(wh, "column_mapping", W.load_meta(wh, "column_mapping").unionByName(too_long))
    assert W.load_meta(wh, "column_mapping").count() == 1


def test_metadata_tables_are_published_as_one_unit(spark, root, monkeypatch):
    reg = spark.createDataFrame([(1, "one", "s1.csv", "Sheet1", True)], schemas.SOURCE_REGISTRY)
    keys = spark.createDataFrame([(1, "Plant", "Plant", "text")], schemas.KEY_COLUMN_MAPPING)
    wh = W.ensure_layers(spark, root)
    W.save_meta_tables(wh, {"source_registry": reg, "key_column_mapping": keys})
    more = reg.unionByName(spark.createDataFrame([(2, "two", "s2.csv", "Sheet1", True)], schemas.SOURCE_REGISTRY))
    bad = spark.createDataFrame([(2, "x" * 5000, "Plant", "text")], schemas.KEY_COLUMN_MAPPING)
    with pytest.raises(Exception):
        W.save_meta_tables(wh, {"source_registry": more, "key_column_mapping": bad})
    assert W.load_meta(wh, "source_registry").count() == W.load_meta(wh, "key_column_mapping").count() == 1
    W.save_meta_tables(wh, {"source_registry": more})
    assert W.load_meta(wh, "source_registry").count() == 2 and W.load_meta(wh, "key_column_mapping").count() == 1


def test_only_a_missing_table_reads_as_empty(spark, root):
    wh = W.ensure_layers(spark, root)
    assert W.load_log(wh).count() == 0
    with pytest.raises(AnalysisException):
        W._raise_unless_absent(catch(lambda: spark.sql("SELECT nothing_like_it")))


def catch(run):
    try:
        run()
    except AnalysisException as e:
        return e


def test_pruning_spares_a_running_load(spark, root):
    wh = W.ensure_layers(spark, root)
    for v in ("a", "b", "c", "running"):
        spark.range(1).write.parquet(wh.path("gold", f"v={v}", "fact"))
        if v != "running":
            W.mark_published(wh, v)
    assert W.prune_gold_versions(wh, keep=2) == ["a"]
    assert W.prune_gold_versions(wh, keep=2, spare_hours=0) == ["running"]
