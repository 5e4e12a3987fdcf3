"""Replace by source: one manifest row makes all of it current, or nothing changes."""

import datetime

import pytest
from pyspark.sql import functions as F

from metamart import schemas
from metamart.operators import dq
from metamart.sources import warehouse as W

DAY = datetime.date(2020, 1, 1)


def rows(spark, *items):
    return spark.createDataFrame([(s, p, DAY, "Q", v) for s, p, v in items], schemas.BRONZE)


def now(wh):
    return sorted((r.SourceID, r.Plant, r.Value) for r in W.load_bronze(wh).collect())


def profile(wh, ids):
    return sorted(map(tuple, W.load_profile(wh, ids).collect()), key=str)


def test_replace_delete_and_profiles(spark, root):
    wh = W.Warehouse(spark, root)
    assert now(wh) == [] == profile(wh, [1])
    assert W.replace_sources_bulk(wh, rows(spark, (1, "a", 1), (2, "b", -2), (2, None, 3)), [1, 2, 3]) == [3]
    W.replace_sources(wh, {2: rows(spark, (2, " ", 5)), 4: rows(spark).limit(0)})
    assert now(wh) == [(1, "a", 1), (2, " ", 5)]
    assert profile(wh, [1, 2, 3, 4]) == sorted(map(tuple, dq.bronze_profile(W.load_bronze(wh), [1, 2, 3, 4]).collect()), key=str)
    W.delete_sources(wh, [1])
    assert now(wh) == [(2, " ", 5)] and [r[0] for r in profile(wh, [1, 2])] == [2]
    assert len(W.prune_bronze_versions(wh, keep=1)) == 1          # the first version holds no current source
    assert now(wh) == [(2, " ", 5)]


def test_a_failure_between_sources_leaves_the_old_rows(spark, root):
    wh = W.Warehouse(spark, root)
    W.replace_sources(wh, {1: rows(spark, (1, "a", 1)), 2: rows(spark, (2, "b", 2))})
    broken = rows(spark, (2, "b", 9)).withColumn("Value", F.raise_error(F.lit("torn file")).cast("bigint"))
    with pytest.raises(Exception, match="torn file"):
        W.replace_sources(wh, {1: rows(spark, (1, "new", 7)), 2: broken})
    assert now(wh) == [(1, "a", 1), (2, "b", 2)]
    W.replace_sources(wh, {1: rows(spark, (1, "new", 7)), 2: rows(spark, (2, "b", 9))})
    assert now(wh) == [(1, "new", 7), (2, "b", 9)]
