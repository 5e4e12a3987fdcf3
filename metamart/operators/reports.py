"""The tables behind the report visuals (R1..R10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metamart.functions.formats import arrow_number, signed_pct
from metamart.operators import measures as M
from metamart.operators.gold import Star


def trend_month_class(star: Star, ctx: M.FilterContext = M.ALL) -> DataFrame:
    """Month x classification -> # Incidents; month order, class descending."""
    return (M.totals(star, ctx, ["MonthShort", "MonthNumber", "Classification"])
            .select("MonthShort", "MonthNumber", "Classification", "Incidents")
            .orderBy("MonthNumber", F.desc("Classification")))


def plant_class(star: Star, ctx: M.FilterContext = M.ALL) -> DataFrame:
    """R2: plant x classification -> # Incidents, sorted by the plant total."""
    t = M.totals(star, ctx, ["PlantCode", "Classification"]).select("PlantCode", "Classification", "Incidents")
    total = F.sum("Incidents").over(Window.partitionBy("PlantCode"))
    return (t.withColumn("PlantTotal", total)
            .orderBy("PlantTotal", F.desc("Classification"), "PlantCode"))


def incident_mix(star: Star, ctx: M.FilterContext = M.ALL) -> DataFrame:
    """Incident type label -> # Incidents ascending; types without facts
    do not appear."""
    return (M.totals(star, ctx, ["IncidentTypeName"]).select("IncidentTypeName", "Incidents")
            .filter(F.col("Incidents").isNotNull()).orderBy("Incidents"))


def kpi_cards(star: Star, ctx: M.FilterContext = M.ALL, by: Sequence[str] = ()) -> DataFrame:
    """R4..R7: the four cards (total, Internal, External, latest month) with
    their labels, one row per group; the fact is read once."""
    mf = M.measure_frame(star, ctx, by)
    mf = mf.withColumns({
        **{f"{n}_Chg_Display": arrow_number(F.col(f"{n}_Chg")) for n in ("Incidents", "Internal", "External")},
        **{f"{n}_Pct_Chg_Display": signed_pct(F.col(f"{n}_Pct_Chg")) for n in ("Incidents", "Internal", "External")},
        "Latest_Month_Chg_Display": arrow_number(F.col("Latest_Month_Chg")),
        "Pct_Latest_Month_Chg_Display": signed_pct(F.col("Pct_Latest_Month_Chg")),
    })
    _, date_by = M._split_by(by)
    if not date_by:
        return M.selected_year_columns(star, ctx, (), onto=mf)
    return mf.join(M.selected_year_columns(star, ctx, date_by), list(date_by), "left")


def _status(x, worse_at: float) -> F.Column:
    return (F.when(x >= worse_at, F.lit("worse")).when(x < 0, F.lit("better")))


def kpi_status(star: Star, ctx: M.FilterContext = M.ALL, by: Sequence[str] = ()) -> DataFrame:
    """Colour state of the total card: change >= 1 worse, < 0 better;
    percentage >= 0 worse, < 0 better; otherwise none (NULL)."""
    keys = list(by)
    y = M.year_over_year(star, ctx, by)
    return y.select(*keys, "Incidents_Chg", _status(F.col("Incidents_Chg"), 1).alias("Chg_Status"),
                    "Incidents_Pct_Chg", _status(F.col("Incidents_Pct_Chg"), 0).alias("Pct_Status"))


def slicer_options(star: Star, ctx: M.FilterContext = M.ALL) -> DataFrame:
    """Options of the three slicers.  Periods come from the calendar;
    classifications and plants are those with facts on the visible dates
    (each slicer restricted by the date selection); blank plants excluded."""
    vis = M.visible_dates(star, ctx)
    f = star.fact.join(vis.select("DateKey"), "DateKey", "left_semi")
    periods = vis.select(F.lit("Period").alias("Slicer"), F.col("Period").alias("Value")).distinct()

    def option(slicer, key):
        return F.struct(F.lit(slicer).alias("Slicer"), F.col(key).cast("bigint").alias("Key"))

    # both lists from one pass over the fact: every row names its type and its plant
    used = f.select(F.inline(F.array(option("Classification", "IncidentTypeKey"), option("Plant", "PlantKey")))).distinct()
    names = (star.dim_incident_type.select(option("Classification", "IncidentTypeKey").alias("o"), F.col("Classification").alias("Value"))
             .unionByName(star.dim_plant.filter(F.col("PlantCode").isNotNull())
                          .select(option("Plant", "PlantKey").alias("o"), F.col("PlantCode").alias("Value"))))
    listed = used.join(names.select("o.*", "Value"), ["Slicer", "Key"]).select("Slicer", "Value").distinct()
    return periods.unionByName(listed)
