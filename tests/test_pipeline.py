"""Scenario tests replaying the reference's demo on generated data:
240 -> 288 -> 336 facts, onboarding an unmapped source through proposals,
idempotent reloads, and an aborted gold load that keeps the old version."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from metamart import schemas
from metamart.operators import dq, gold, meta, proposals as P
from metamart.plans import pipeline
from metamart.sources import warehouse as W
from tests.helpers import SIX_RULES, rules

GROUPS = ("01/02", "05/06")
HEADERS = {  # SourceId -> plant header, month header, Internal prefix, External prefix
    1: ("Plant", "Month", "Incidents IC ", "Incidents Ext "),
    2: ("Werk", "Monat", "Interne Vorfälle ", "Externe Vorfälle "),
    3: ("Usine", "Mois", "Incidents internes ", "Incidents externes "),
    4: ("Planta", "Mes", "Incidentes internos ", "Incidentes externos "),
}
PLANTS = {1: ["Plant A", "Plant B"], 2: ["Werk C"], 3: ["Usine D"], 4: ["Planta E"]}
YEARS = {1: (2019, 2020), 2: (2021,), 3: (2022,), 4: (2023,)}


def wide(spark, sid):
    ph, mh, ip, ep = HEADERS[sid]
    cols = [ip + g for g in GROUPS] + [ep + g for g in GROUPS]
    rows = []
    for p_i, plant in enumerate(PLANTS[sid]):
        for y in YEARS[sid]:
            for m in range(1, 13):
                rows.append((plant, date(y, m, 1).isoformat(), *[(p_i + m + j) % 7 for j in range(4)]))
    return spark.createDataFrame(rows, [ph, mh, *cols])


def maprows(sid, start):
    _, _, ip, ep = HEADERS[sid]
    out, mid = [], start
    for cls, pre in (("Internal", ip), ("External", ep)):
        for g in GROUPS:
            out.append((mid, sid, pre + g, cls, g, True))
            mid += 1
    return out


def counts(star):
    return star.fact.count(), star.dim_plant.count(), star.dim_incident_type.count()


@pytest.fixture
def demo(spark, root):
    wh = W.ensure_layers(spark, root)
    reg = spark.createDataFrame([(1, "Incidents", "Files/landing/s1.xlsx", "Sheet1", True),
                                 (2, "Incidents Werk", "Files/landing/s2.xlsx", "Sheet1", True)],
                                schemas.SOURCE_REGISTRY)
    keys = spark.createDataFrame([(s, HEADERS[s][0], "Plant", "text") for s in (1, 2)]
                                 + [(s, HEADERS[s][1], "Month", "date") for s in (1, 2)],
                                 schemas.KEY_COLUMN_MAPPING)
    m = spark.createDataFrame(maprows(1, 1) + maprows(2, 5), schemas.COLUMN_MAPPING)
    return wh, reg, keys, m, rules(spark, SIX_RULES)


def test_demo_rehearsal(spark, demo):
    wh, reg, keys, m, rs = demo
    r = pipeline.run(wh, {1: wide(spark, 1), 2: wide(spark, 2)}, keys, m, rs, datetime(2024, 1, 1, 8))
    assert r.log.count() == 12 and r.log.filter(~F.col("Passed")).count() == 0
    assert counts(r.star) == (240, 3, 4)
    assert counts(W.load_star(wh)) == (240, 3, 4)

    # register the French source: rows for the registry and its key columns
    req = spark.createDataFrame([(1, "Incidents Usine", "Files/landing/s3.xlsx", "Sheet1", "Usine", "Mois"),
                                 (2, "Again", "Files/landing/s1.xlsx", "Sheet1", None, None)],
                                "RequestId long, SourceName string, FilePath string, SheetName string, "
                                "PlantColumn string, MonthColumn string")
    regd = meta.register_sources(reg, keys, req)
    status = {x.RequestId: (x.Status, x.SourceId) for x in regd.result.collect()}
    assert status == {1: ("registered", 3), 2: ("path already registered", None)}
    keys = keys.unionByName(regd.key_rows)

    r3 = pipeline.run(wh, {3: wide(spark, 3)}, keys, m, rs, datetime(2024, 1, 1, 9))
    drift = r3.log.filter(F.col("RuleId") == 1).first()
    assert drift.Passed is False
    assert drift.Details == ("unmapped columns: 4; Incidents externes 01/02, Incidents externes 05/06, "
                             "Incidents internes 01/02, Incidents internes 05/06")
    assert counts(r3.star) == (240, 3, 4)          # unmapped rows do not reach gold

    # the model answers; parse, filter by vocabulary, queue, approve
    answer = ('Sure! {"mappings": [' + ", ".join(
        f'{{"source_column": "{HEADERS[3][2 if c == "Internal" else 3]}{g}", "classification": "{c}", '
        f'"code_group": "{g}", "confidence": 0.95, "rationale": "same words"}}'
        for c in ("Internal", "External") for g in GROUPS)
        + ', {"source_column": "Invented", "classification": "Internal", "code_group": "99"}]} Done.')
    resp = spark.createDataFrame([(3, "m", answer), (3, "m", "no json here")],
                                 "SourceId int, ModelName string, ResponseText string")
    parsed = P.parse_proposals(resp)
    assert parsed.count() == 5
    valid = P.valid_proposals(parsed, P.vocabulary(m))
    assert valid.count() == 4
    W.append_proposals(wh, P.to_queue(valid, datetime(2024, 1, 1, 10)), "demo")
    queue = W.load_proposals(wh)
    assert meta.pending_proposals(queue, m).count() == 4
    new = meta.approve_proposals(queue, m, [3])
    assert sorted(x.MappingId for x in new.collect()) == [9, 10, 11, 12]
    m = m.unionByName(new)
    assert meta.approve_proposals(queue, m, [3]).count() == 0     # approve twice = once
    assert meta.pending_proposals(queue, m).count() == 0

    version, star = pipeline.load_gold(wh, m)                      # gold only, no reload
    assert counts(star) == (288, 4, 4)
    again = pipeline.validate(wh, m, rs, [3], datetime(2024, 1, 1, 11))
    assert again.filter(F.col("RuleId") == 1).first().Passed is True

    keys = keys.unionByName(spark.createDataFrame(
        [(4, "Planta", "Plant", "text"), (4, "Mes", "Month", "date")], schemas.KEY_COLUMN_MAPPING))
    m = m.unionByName(spark.createDataFrame(maprows(4, 13), schemas.COLUMN_MAPPING))
    r4 = pipeline.run(wh, {4: wide(spark, 4)}, keys, m, rs, datetime(2024, 1, 1, 12))
    assert counts(r4.star) == (336, 5, 4)

    # reload one source twice: nothing doubles, the others stay
    for hour in (13, 14):
        r5 = pipeline.run(wh, {1: wide(spark, 1)}, keys, m, rs, datetime(2024, 1, 1, hour))
    assert counts(r5.star) == (336, 5, 4)
    per_source = {x.SourceID: x["count"] for x in W.load_bronze(wh).groupBy("SourceID").count().collect()}
    assert per_source == {1: 192, 2: 48, 3: 48, 4: 48}

    # an empty file empties its partition; the row-count rule fails and gates
    empty = wide(spark, 2).filter(F.lit(False))
    with pytest.raises(dq.ValidationFailed):
        pipeline.run(wh, {2: empty}, keys, m, rs, datetime(2024, 1, 1, 15))
    assert W.load_bronze(wh).filter("SourceID = 2").count() == 0
    failed = {x.RuleId: x.Details for x in W.load_log(wh).filter(
        (F.col("SourceId") == 2) & ~F.col("Passed")).collect()}
    assert failed[2] == "rows: 0" and failed[4] == "minimum value: "
    assert counts(W.load_star(wh)) == (336, 5, 4)      # gold untouched by the failed run


def test_aborted_gold_keeps_previous_version(spark, demo):
    wh, reg, keys, m, rs = demo
    r = pipeline.run(wh, {1: wide(spark, 1)}, keys, m, rs, datetime(2024, 1, 2, 8))
    before = W.current_version(wh)
    bad = wide(spark, 2).withColumn("Werk", F.lit(None).cast("string"))
    W.replace_sources(wh, {2: pipeline.wide_to_bronze(bad, 2, keys.filter("SourceId = 2").collect())})
    with pytest.raises(gold.ContractViolation):
        pipeline.load_gold(wh, m)
    assert W.current_version(wh) == before
    assert counts(W.load_star(wh)) == counts(r.star) == (192, 2, 4)
    # pruning keeps the current version and drops the failed one
    assert W.prune_gold_versions(wh, keep=1) == []         # it might be a load that still runs
    gone = W.prune_gold_versions(wh, keep=1, spare_hours=0)
    assert len(gone) == 1 and before not in gone
    assert counts(W.load_star(wh)) == (192, 2, 4)


def test_null_value_reaching_gold_aborts(spark, demo):
    from datetime import date as _d
    wh, reg, keys, m, rs = demo
    pipeline.run(wh, {1: wide(spark, 1)}, keys, m, rs, datetime(2024, 1, 3, 8))
    before = W.current_version(wh)
    bad = spark.createDataFrame([(2, "Werk C", _d(2021, 1, 1), "Interne Vorfälle 01/02", None)], schemas.BRONZE)
    W.replace_sources(wh, {2: bad})
    with pytest.raises(gold.ContractViolation, match="fact"):
        pipeline.load_gold(wh, m)
    assert W.current_version(wh) == before
