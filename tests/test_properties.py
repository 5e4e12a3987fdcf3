"""Property tests on small generated frames."""

from datetime import date

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from metamart.operators import gold
from metamart.operators.keys import dense_keys
from metamart.operators.reshape import wide_to_bronze
from metamart.sources.landing import replace_rows
from tests.helpers import bronze, mapping

KEYS = [Row(SourceColumn="Plant", TargetColumn="Plant", DataType="text"),
        Row(SourceColumn="Month", TargetColumn="Month", DataType="date")]
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

cell = st.one_of(st.none(), st.integers(min_value=-50, max_value=500))
wide_rows = st.lists(st.tuples(st.sampled_from(["P1", "P2", " P3\t"]), st.integers(1, 12), cell, cell, cell),
                     min_size=0, max_size=12, unique_by=lambda r: (r[0], r[1]))


@SETTINGS
@given(rows=wide_rows, seed=st.randoms())
def test_unpivot_keeps_every_non_null_cell(spark, rows, seed):
    data = [(p, date(2020, m, 1), a, b, c) for p, m, a, b, c in rows]
    shuffled = list(data)
    seed.shuffle(shuffled)
    schema = "Plant string, Month date, `Qty A` bigint, ` Qty B` bigint, `Qty C ` bigint"
    out1 = wide_to_bronze(spark.createDataFrame(data, schema), 1, KEYS)
    out2 = wide_to_bronze(spark.createDataFrame(shuffled, schema), 1, KEYS)
    cells = [v for r in data for v in r[2:] if v is not None]
    got = sorted(tuple(r) for r in out1.collect())
    assert len(got) == len(cells)
    assert sum(r[4] for r in got) == sum(cells)
    assert got == sorted(tuple(r) for r in out2.collect())          # row order does not matter
    assert {r[3] for r in got} <= {"Qty A", "Qty B", "Qty C"}
    assert {r[1] for r in got} <= {"P1", "P2", "P3"}


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(1, 3), st.sampled_from(["x", "y"]), st.integers(0, 9)), max_size=15),
       new=st.lists(st.tuples(st.integers(1, 3), st.sampled_from(["x", "y"]), st.integers(0, 9)), max_size=6))
def test_replace_twice_equals_once(spark, rows, new):
    cur = bronze(spark, [(s, "P", date(2020, 1, 1), c, v) for s, c, v in rows])
    nw = bronze(spark, [(s, "P", date(2020, 1, 1), c, v) for s, c, v in new])
    once = replace_rows(cur, nw, [1, 2])
    twice = replace_rows(once, nw, [1, 2])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert once.filter("SourceID = 3").count() == cur.filter("SourceID = 3").count()


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(2019, 2021), st.integers(1, 12),
                               st.sampled_from(["Internal", "External"]), st.sampled_from(["01", "05"]),
                               st.integers(0, 99)), min_size=1, max_size=20))
def test_fact_preserves_rows_and_sum(spark, rows):
    s = spark.createDataFrame([(p, date(y, m, 1), c, g, v) for p, y, m, c, g, v in rows],
                              "Plant string, Month date, Classification string, CodeGroup string, Incidents bigint")
    m = mapping(spark, [(1, 1, "a", "Internal", "01", True), (2, 1, "b", "Internal", "05", True),
                        (3, 1, "c", "External", "01", True), (4, 1, "d", "External", "05", True)])
    f = gold.build_star(s, m).fact
    assert f.count() == len(rows)
    assert (f.agg(F.sum("Incidents")).first()[0] or 0) == sum(r[5] for r in rows)


@SETTINGS
@given(keys=st.sets(st.text(alphabet="abcXYZ é", min_size=0, max_size=5), min_size=1, max_size=40),
       parts=st.integers(1, 6))
def test_dense_keys_equal_row_number(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "s string").repartition(parts)
    got = {r.s: r.DenseKey for r in dense_keys(df, [F.col("s")], key="DenseKey").collect()}
    ref = {r.s: r.R for r in df.withColumn("R", F.row_number().over(Window.orderBy("s"))).collect()}
    assert got == ref


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from([None, "A", "B"]), st.sampled_from([None, 1, 2]),
                               st.sampled_from(["Internal", "External", None]), st.sampled_from(["01", None])),
                     max_size=25))
def test_two_phase_duplicate_check_is_exact(spark, rows):
    from metamart.operators import dq
    s = spark.createDataFrame([(p, date(2020, m, 1) if m else None, c, g, 1) for p, m, c, g in rows],
                              "Plant string, Month date, Classification string, CodeGroup string, Incidents bigint")
    expected = s.groupBy(*dq.GRAIN).count().filter("count > 1").count()
    assert dq.duplicate_grain(s).first().Dupes == expected
