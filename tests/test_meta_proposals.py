"""Metadata operations and proposals (hand fixture 12)."""

from datetime import datetime


from metamart import schemas
from metamart.operators import meta, proposals as P
from tests.helpers import mapping

T1, T2 = datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 2)
MAP = [(1, 1, "a", "Internal", "A", True), (2, 1, "b", "External", "N", False)]


def queue(spark, rows):
    return spark.createDataFrame(rows, schemas.PROPOSALS)


def test_newer_weak_proposal_hides_older_strong(spark):
    q = queue(spark, [(1, "x", "Internal", "A", 0.99, "", "m", T1),
                      (1, "x", "External", "A", 0.50, "", "m", T2)])
    assert meta.approve_proposals(q, mapping(spark, MAP)).count() == 0


def test_deactivated_mapping_blocks_approval_and_ids_continue(spark):
    q = queue(spark, [(1, "b", "Internal", "A", 0.95, "", "m", T1),
                      (1, "d", "Internal", "A", 0.90, "", "m", T1),
                      (1, "c", "External", "N", 0.91, "", "m", T1),
                      (2, "c", "External", "N", 0.89, "", "m", T1)])
    got = [(r.MappingId, r.SourceId, r.SourceColumn) for r in
           meta.approve_proposals(q, mapping(spark, MAP)).orderBy("MappingId").collect()]
    assert got == [(3, 1, "c"), (4, 1, "d")]
    assert meta.approve_proposals(q, mapping(spark, MAP), source_ids=[2], min_confidence=0.8).count() == 1


def test_invented_header_passes_vocabulary_and_text_without_json(spark):
    resp = spark.createDataFrame([
        (1, "m", 'x {"mappings": [{"source_column": "Nope", "classification": "Internal", "code_group": "A"},'
                 ' {"source_column": "y", "classification": "Weird", "code_group": "A"},'
                 ' {"classification": "Internal", "code_group": "A"}]} y'),
        (1, "m", "I could not do it."),
        (2, "m", "{broken json}"),
    ], "SourceId int, ModelName string, ResponseText string")
    parsed = P.parse_proposals(resp)
    assert parsed.count() == 3
    vocab = P.vocabulary(mapping(spark, MAP))
    assert sorted((r.Kind, r.Value) for r in vocab.collect()) == [("Classification", "Internal"), ("CodeGroup", "A")]
    valid = P.valid_proposals(parsed, vocab)
    assert sorted(r.SourceColumn or "" for r in valid.collect()) == ["", "Nope"]
    stats = P.proposal_stats(parsed, vocab).first()
    assert (stats.Proposed, stats.Valid, stats.Rejected, stats.NoColumn) == (3, 2, 1, 1)
    q = P.to_queue(valid, datetime(2024, 2, 1)).collect()
    assert [(r.SourceColumn, r.Confidence, r.Rationale) for r in q] == [("Nope", 0.0, "")]


def test_mapping_changes_and_activation(spark):
    changes = spark.createDataFrame([
        (2, "activate", None, None, None, None),
        (1, "delete", None, None, None, None),
        (7, "insert", 1, "z", "External", "R"),
    ], "MappingId int, Action string, SourceId int, SourceColumn string, Classification string, CodeGroup string")
    out = sorted(tuple(r) for r in meta.apply_mapping_changes(mapping(spark, MAP), changes).collect())
    assert out == [(2, 1, "b", "External", "N", True), (7, 1, "z", "External", "R", True)]
    reg = spark.createDataFrame([(1, "a", "p1", "s", True), (2, "b", "p2", "s", True)], schemas.SOURCE_REGISTRY)
    assert [r.IsActive for r in meta.set_active(reg, [2], False).orderBy("SourceId").collect()] == [True, False]
    counts = {r.TableName: r.Rows for r in meta.meta_counts({"reg": reg, "map": mapping(spark, MAP)}).collect()}
    assert counts == {"reg": 2, "map": 2}


def test_register_rejects_duplicates_and_taken_ids(spark):
    reg = spark.createDataFrame([(1, "a", "p1", "s", True)], schemas.SOURCE_REGISTRY)
    keys = spark.createDataFrame([(1, "Plant", "Plant", "text"), (3, "Plant", "Plant", "text")],
                                 schemas.KEY_COLUMN_MAPPING)
    req = spark.createDataFrame([(10, "n1", "p2", "s", None, None), (11, "n2", "p2", "s", None, None),
                                 (12, "n3", "p1", "s", None, None), (13, "n4", "p3", "s", "W", "M")],
                                "RequestId long, SourceName string, FilePath string, SheetName string, "
                                "PlantColumn string, MonthColumn string")
    r = meta.register_sources(reg, keys, req)
    got = {x.RequestId: (x.Status, x.SourceId) for x in r.result.collect()}
    assert got == {10: ("registered", 2), 11: ("path already registered", None),
                   12: ("path already registered", None), 13: ("key columns already exist for this id", None)}
    assert sorted(tuple(x) for x in r.key_rows.collect()) == [(2, "Month", "Month", "date"), (2, "Plant", "Plant", "text")]


def test_last_change_per_id_wins(spark):
    changes = spark.createDataFrame([
        (2, "activate", None, None, None, None, 1),
        (2, "deactivate", None, None, None, None, 2),
    ], "MappingId int, Action string, SourceId int, SourceColumn string, Classification string, "
       "CodeGroup string, ChangeSeq int")
    out = {r.MappingId: r.IsActive for r in meta.apply_mapping_changes(mapping(spark, MAP), changes).collect()}
    assert out == {1: True, 2: False}


def test_trailing_blanks_do_not_count_in_header_matches(spark):
    from datetime import date
    from metamart.operators.silver import silver, unmapped_columns, column_pairs
    from tests.helpers import bronze
    m = mapping(spark, [(1, 1, "a  ", "Internal", "A", True)])
    b = bronze(spark, [(1, "P", date(2020, 1, 1), "a", 3)])
    assert silver(b, m).count() == 1
    assert unmapped_columns(column_pairs(b), m).count() == 0
    q = queue(spark, [(1, "a", "Internal", "A", 0.99, "", "m", T1), (1, " a", "Internal", "A", 0.99, "", "m", T1)])
    assert [r.SourceColumn for r in meta.approve_proposals(q, m).collect()] == [" a"]   # leading blanks count
    assert meta.pending_proposals(q, m).count() == 1


def test_latest_proposal_ties_and_missing_time(spark):
    q = queue(spark, [(1, "x", "Internal", "A", 0.95, "", "m", T2), (1, "x", "External", "N", 0.97, "", "m", T2),
                      (1, "x", "External", "R", 0.99, "", "m", T1), (1, "y", "Internal", "A", 0.91, "", "m", None)])
    got = {r.SourceColumn: (r.Classification, r.CodeGroup, r.Confidence) for r in meta.latest_proposals(q).collect()}
    assert got == {"x": ("External", "N", 0.97), "y": ("Internal", "A", 0.91)}
