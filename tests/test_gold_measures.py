"""Gold builders and measures (hand fixtures 8-10, 13)."""

from datetime import date

from pyspark.sql import functions as F

from metamart.operators import gold, measures as M
from metamart.operators.keys import dense_keys
from tests.helpers import mapping

MAP = [(1, 1, "a", "Internal", "01", True), (2, 1, "b", "External", "01", True),
       (3, 1, "c", "External", "05", True)]


def silver_df(spark, rows):
    return spark.createDataFrame(rows, "Plant string, Month date, Classification string, CodeGroup string, Incidents bigint")


def star_of(spark, rows, maprows=MAP):
    return gold.build_star(silver_df(spark, rows), mapping(spark, maprows))


def test_gap_year_calendar_and_prior_year(spark):
    st = star_of(spark, [("P1", date(2019, 1, 1), "Internal", "01", 5),
                         ("P1", date(2021, 1, 1), "Internal", "01", 7)])
    years = sorted({r.Year for r in st.dim_date.select("Year").distinct().collect()})
    assert years == [2019, 2021]
    assert st.dim_date.count() == 365 + 365
    yoy = {r.Year: (r.Incidents, r.Incidents_PY, r.Incidents_Chg) for r in M.year_over_year(st, by=["Year"]).collect()}
    assert yoy[2021] == (7, None, None)        # 2020 absent from the calendar: blank
    assert yoy[2019] == (5, None, None)


def test_periods_partial_year_leap_day_and_keys(spark):
    st = star_of(spark, [("P2", date(2020, 2, 1), "Internal", "01", 1),
                         ("P1", date(2020, 11, 1), "External", "01", 2)])
    d = {r.Date: r for r in st.dim_date.collect()}
    assert d[date(2020, 2, 29)].DateKey == 20200229
    assert d[date(2020, 2, 29)].Period == "Feb–Nov 2020"
    assert d[date(2020, 12, 31)].MonthShort == "Dec"
    assert sorted(tuple(r) for r in st.dim_plant.collect()) == [(1, "P1"), (2, "P2")]


def test_type_dimension_third_class_and_no_facts(spark):
    maprows = MAP + [(4, 1, "d", "Other", "01", True), (5, 1, "e", "Internal", "09", True)]
    st = star_of(spark, [("P1", date(2020, 1, 1), "Internal", "01", 1)], maprows)
    t = [(r.IncidentTypeKey, r.Classification, r.CodeGroup, r.IncidentTypeName)
         for r in st.dim_incident_type.orderBy("SortOrder").collect()]
    assert t == [(1, "Internal", "01", "Int 01"), (2, "Internal", "09", "Int 09"),
                 (3, "External", "01", "Ext 01"), (4, "Other", "01", "Ext 01"),
                 (5, "External", "05", "Ext 05")]
    mix = M.totals(st, by=["IncidentTypeName"]).filter(F.col("Incidents").isNotNull()).collect()
    assert [(r.IncidentTypeName, r.Incidents) for r in mix] == [("Int 01", 1)]


def test_fact_drops_null_plant_rows(spark):
    st = star_of(spark, [(None, date(2020, 1, 1), "Internal", "01", 1),
                         ("P1", date(2020, 1, 1), "Internal", "01", 2)])
    assert st.fact.count() == 1
    violations = gold.contract_violations(st.dim_plant, "dim_plant").first()
    assert violations["null:PlantCode"] == 1


def test_prior_year_zero_and_blank_current(spark):
    st = star_of(spark, [("P1", date(2019, 3, 1), "Internal", "01", 0),
                         ("P2", date(2019, 3, 1), "Internal", "01", 4),
                         ("P1", date(2020, 3, 1), "Internal", "01", 6)])
    y = {r.PlantCode: r for r in M.year_over_year(st, M.FilterContext(years=(2020,)), by=["PlantCode"]).collect()}
    assert (y["P1"].Incidents, y["P1"].Incidents_PY, y["P1"].Incidents_Chg, y["P1"].Incidents_Pct_Chg) == (6, 0, 6, None)
    assert (y["P2"].Incidents, y["P2"].Incidents_PY, y["P2"].Incidents_Chg) == (None, 4, -4)
    assert y["P2"].Incidents_Pct_Chg == -1.0


def test_latest_month_january_and_labels(spark):
    st = star_of(spark, [("P1", date(2019, 12, 1), "Internal", "01", 10),
                         ("P1", date(2020, 1, 1), "External", "01", 15),
                         ("P1", date(2019, 1, 1), "Internal", "01", 5)])
    lm = M.latest_month(st).first()
    assert lm.LatestMonth == date(2020, 1, 1)
    assert (lm.Incidents_Latest_Month, lm.Incidents_Previous_Month, lm.Latest_Month_Chg) == (15, 10, 5)
    assert lm.Latest_Month_Label2 == "LATEST MONTH • JAN"
    y2020 = M.latest_month(st, M.FilterContext(years=(2020,))).first()
    assert y2020.Incidents_Previous_Month == 10          # crosses the year end
    lab = M.selected_year(st).first()
    assert (lab.Selected_Year, lab.PY_Label) == ("All years", "PY 2019")
    lab20 = M.selected_year(st, M.FilterContext(years=(2020,))).first()
    assert lab20.Incidents_Label == "TOTAL INCIDENTS • 2020"
    sig = {r.Year: r.Overview_Signal for r in M.overview_signal(st, by=["Year"]).collect()}
    assert sig[2019] == "No prior-year data available for the selected period."
    assert sig[2020] == ("Total incidents are 0.0% higher than PY, while January increased 50.0% "
                         "versus December and should be monitored.")


def test_intersecting_class_filter(spark):
    st = star_of(spark, [("P1", date(2020, 1, 1), "Internal", "01", 3),
                         ("P1", date(2020, 1, 1), "External", "01", 4)])
    t = M.totals(st, M.FilterContext(classes=("External",))).first()
    assert (t.Incidents, t.Internal, t.External) == (4, None, 4)
    assert M.FilterContext(classes=("External",)).and_class("Internal").classes == ()


def test_dense_keys_match_row_number(spark):
    from pyspark.sql import Window
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).cast("string").alias("s")).distinct()
    df = df.unionByName(df.limit(1).select(F.lit(None).cast("string").alias("s")))
    got = dense_keys(df.repartition(7), ["s"], key="DenseKey", start=11)
    ref = df.withColumn("R", F.row_number().over(Window.orderBy("s")) + 10)
    assert got.join(ref, got["s"].eqNullSafe(ref["s"])).filter(F.col("DenseKey") != F.col("R")).count() == 0
    assert got.count() == df.count()


def test_dense_keys_do_not_depend_on_partitions(spark):
    """2,000,000 rows with payload columns: with the key a function of the
    row number, every row must get its own number, whatever the planner does."""
    n = 2_000_000
    df = spark.range(0, n, 1, 16).select(((F.col("id") * 7_919_117) % n).alias("r")).select(
        F.lpad(F.col("r").cast("string"), 9, "0").alias("k"), "r",
        F.repeat(F.lit("x"), 40).alias("payload"), (F.col("r") % 7).alias("other"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    for advisory in ("256k", "4m", "64m"):
        spark.conf.set(size, advisory)
        try:
            got = dense_keys(df, ["k"], key="DenseKey")
            for _ in range(2):                   # evaluated twice
                row = got.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("DenseKey") != F.col("r") + 1).alias("bad"),
                              F.sum("other").alias("s")).first()
                assert (row.n, row.bad) == (n, 0) and row.s > 0
                assert got.select("payload", "DenseKey").agg(F.max("DenseKey")).first()[0] == n
        finally:
            spark.conf.unset(size)


def test_display_masks(spark):
    from metamart.functions.formats import arrow_number, signed_pct
    df = spark.createDataFrame([(1234.0, 0.026), (-5.0, -0.1234), (0.0, 0.0004), (None, None), (0.4, -0.00049)],
                               "c double, p double")
    got = [(r.a, r.s) for r in df.select(arrow_number(F.col("c")).alias("a"),
                                         signed_pct(F.col("p")).alias("s")).collect()]
    assert got == [("▲ 1,234", "+2.6%"), ("▼ 5", "-12.3%"), ("0", "0.0%"), (None, None), ("0", "0.0%")]


def test_slicer_options_restricted_by_periods(spark):
    from metamart.operators import reports
    st = star_of(spark, [("P1", date(2019, 1, 1), "Internal", "01", 1), ("P2", date(2020, 12, 1), "External", "01", 2),
                         ("P3", date(2021, 3, 1), "External", "01", 3)])
    ctx = M.FilterContext(periods=("Jan–Jan 2019", "Dec–Dec 2020"))
    got = sorted((r.Slicer, r.Value) for r in reports.slicer_options(st, ctx).collect())
    assert got == [("Classification", "External"), ("Classification", "Internal"),
                   ("Period", "Dec–Dec 2020"), ("Period", "Jan–Jan 2019"), ("Plant", "P1"), ("Plant", "P2")]


def test_filter_context_shift():
    import pytest
    ctx = M.FilterContext(dates=(date(2020, 3, 31), date(2020, 1, 15)), years=None)
    assert ctx.shift(-1).dates == (date(2020, 2, 29), date(2019, 12, 15))
    assert M.FilterContext(years=(2021,)).shift(-12).years == (2020,)
    with pytest.raises(ValueError):
        M.FilterContext(months=("Jan",)).shift(1)
