"""Measures over the star schema, evaluated for all groups at once.

A measure is a function of a filter context (dates, plants,
classifications) and of group-by columns.  The fact table is read once per
measure table: it is joined to the (small, filtered) dimensions and
aggregated to (non-date group columns, DateKey) with partial aggregation;
everything after that -- the visible-date filter, the one-year and
one-month shifts, the latest month -- runs on that small monthly aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metamart.functions.dates import date_key, month_name
from metamart.functions.formats import blank_divide, blank_minus, pct_one_decimal
from metamart.operators.gold import Star

PLANT_COLS = ("PlantKey", "PlantCode")
TYPE_COLS = ("IncidentTypeKey", "Classification", "CodeGroup", "IncidentTypeName", "SortOrder")
DATE_COLS = ("DateKey", "Date", "Year", "MonthNumber", "MonthShort", "Period")
SPLITS = (("Incidents", None), ("Internal", "Internal"), ("External", "External"))


@dataclass(frozen=True)
class FilterContext:
    """Slicer selections; ``None`` means no filter on that column."""
    years: tuple[int, ...] | None = None
    periods: tuple[str, ...] | None = None
    months: tuple[str, ...] | None = None      # MonthShort values
    dates: tuple[date, ...] | None = None
    plants: tuple[str, ...] | None = None
    classes: tuple[str, ...] | None = None

    def without_dates(self) -> "FilterContext":
        return replace(self, years=None, periods=None, months=None, dates=None)

    def shift(self, months: int) -> "FilterContext":
        """The date selection moved by ``months`` (explicit dates with month
        arithmetic, clamped to month ends; years by whole years).  Period and
        month-name selections have no shifted form and raise."""
        if self.periods is not None or self.months is not None:
            raise ValueError("period and month-name selections cannot be shifted")
        if self.years is not None and months % 12:
            raise ValueError("a year selection shifts by whole years only")

        def move(d: date) -> date:
            m = d.month - 1 + months
            y, m = d.year + m // 12, m % 12 + 1
            last = (date(y + (m == 12), m % 12 + 1, 1) - date.resolution).day
            return date(y, m, min(d.day, last))

        return replace(self,
                       years=None if self.years is None else tuple(y + months // 12 for y in self.years),
                       dates=None if self.dates is None else tuple(move(d) for d in self.dates))

    def and_class(self, c: str) -> "FilterContext":
        """Intersecting filter: keep the selection AND classification = c."""
        cur = self.classes
        return replace(self, classes=(c,) if cur is None else tuple(x for x in cur if x == c))

    def date_predicate(self) -> Column:
        p = F.lit(True)
        for col, vals in (("Year", self.years), ("Period", self.periods),
                          ("MonthShort", self.months), ("Date", self.dates)):
            if vals is not None:
                p = p & F.col(col).isin(list(vals))
        return p


ALL = FilterContext()


def _split_by(by: Sequence[str]) -> tuple[list[str], list[str]]:
    date_by = [c for c in by if c in DATE_COLS]
    other = [c for c in by if c not in DATE_COLS]
    unknown = [c for c in other if c not in PLANT_COLS + TYPE_COLS]
    if unknown:
        raise ValueError(f"unknown group-by column(s): {unknown}")
    return other, date_by


def visible_dates(star: Star, ctx: FilterContext) -> DataFrame:
    return star.dim_date.filter(ctx.date_predicate())


def _fact_keys(other_by: Sequence[str]) -> list[str]:
    """Group columns as seen on the fact side: plant names are attached
    after aggregation, so the fact groups by PlantKey."""
    out = []
    for c in other_by:
        k = "PlantKey" if c == "PlantCode" else c
        if k not in out:
            out.append(k)
    return out


def monthly_base(star: Star, ctx: FilterContext, other_by: Sequence[str]) -> DataFrame:
    """Fact restricted by the plant and type filters and summed to
    (other_by on the fact side, DateKey): v (all), v_Internal, v_External.
    The only pass over the fact table.  Plants are matched by key (a semi
    join on the filtered plant keys), never by name on the fact rows, so a
    large plant dimension never has to meet the whole fact.  The later join
    to the visible days is on DateKey, the fact's partition column, so the
    optimizer prunes fact partitions at run time."""
    f = star.fact
    if ctx.plants is not None:
        keys = star.dim_plant.filter(F.col("PlantCode").isin(list(ctx.plants))).select("PlantKey")
        f = f.join(keys, "PlantKey", "left_semi")
    types = star.dim_incident_type
    if ctx.classes is not None:
        types = types.filter(F.col("Classification").isin(list(ctx.classes)))
    f = f.join(F.broadcast(types.select(*TYPE_COLS)), "IncidentTypeKey")
    cls = F.col("Classification")
    return (f.groupBy(*_fact_keys(other_by), "DateKey")
            .agg(F.sum("Incidents").alias("v_Incidents"),
                 F.sum(F.when(cls == "Internal", F.col("Incidents"))).alias("v_Internal"),
                 F.sum(F.when(cls == "External", F.col("Incidents"))).alias("v_External")))


def _with_plant_names(df: DataFrame, star: Star, by: Sequence[str]) -> DataFrame:
    """Attach PlantCode to an aggregated result keyed by PlantKey (plants x
    groups rows, not fact rows); keep the caller's column order."""
    if "PlantCode" not in by:
        return df
    names = star.dim_plant.select("PlantKey", "PlantCode")
    out = df.join(names, "PlantKey", "left")
    rest = [c for c in df.columns if c not in by and c != "PlantKey"]
    return out.select(*by, *rest)


def _sum_values(df: DataFrame, keys: Sequence[str], suffix: str = "") -> DataFrame:
    aggs = [F.sum(f"v_{n}").alias(f"{n}{suffix}") for n, _ in SPLITS]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def date_roles(star: Star, ctx: FilterContext, date_by: Sequence[str]) -> DataFrame:
    """How each calendar day feeds the measures of the visible dates, as
    (DateKey, Role, Anchor, date_by...) rows:

    * ``cur``  -- a visible day feeds its own group (Anchor = that day);
    * ``py``   -- the day one year before a visible day feeds the visible
      day's group (same period last year; distinct per group, so two
      visible days mapping to one prior day count it once).  A month all of
      whose days are visible in a group has the whole month a year earlier:
      all of February has a prior 29th of February too;
    * ``prev`` -- the day one month before a visible day feeds it as the
      "previous month" of Anchor (date filters replaced, so it may lie
      outside the visible dates).

    Bounded by three times the calendar, whatever the size of the fact.
    """
    vis = visible_dates(star, ctx)
    dby = [F.col(c) for c in date_by]
    # shifted days are keyed arithmetically; a day missing from the
    # calendar has no facts, so it simply contributes nothing
    cur = vis.select("DateKey", F.lit("cur").alias("Role"), F.col("Date").alias("Anchor"), *dby)
    none = F.lit(None).cast("date").alias("Anchor")
    shifted = vis.select(F.add_months("Date", -12).alias("Date"), *[c.alias(f"_{n}") for n, c in zip(date_by, dby, strict=True)])
    last = F.last_day(F.max("Date"))
    months = (vis.groupBy(*[c.alias(f"_{n}") for n, c in zip(date_by, dby, strict=True)], F.trunc("Date", "month").alias("_month"))
              .agg(F.count(F.lit(1)).alias("_days"), last.alias("_last")).filter(F.col("_days") == F.dayofmonth("_last")))
    # the days between the shifted end of a whole month and that month's own end
    ends = months.select(F.explode(F.sequence(F.add_months("_last", -12), F.last_day(F.add_months("_last", -12)))).alias("Date"),
                         *[F.col(f"_{n}") for n in date_by])
    py = (shifted.unionByName(ends).select(date_key("Date").alias("DateKey"), F.lit("py").alias("Role"), none,
                                           *[F.col(f"_{n}").alias(n) for n in date_by]).distinct())
    prev = vis.select(date_key(F.add_months("Date", -1)).alias("DateKey"), F.lit("prev").alias("Role"),
                      F.col("Date").alias("Anchor"), *dby)
    return cur.unionByName(py).unionByName(prev)


def measure_frame(star: Star, ctx: FilterContext = ALL, by: Sequence[str] = ()) -> DataFrame:
    """Every number of M1..M17 per group from ONE pass over the fact.

    fact -> (other group columns, DateKey) sums -> join the date roles
    (broadcast, bounded by the calendar) -> sums per (group, anchor day)
    -> per group: current and prior-year sums, and the latest anchor with
    data together with its value and the previous month's value.
    """
    other_by, date_by = _split_by(by)
    keys = _fact_keys(other_by) + list(date_by)
    roles = date_roles(star, ctx, date_by)
    base = monthly_base(star, ctx, other_by)
    j = base.join(F.broadcast(roles), "DateKey")
    role = F.col("Role")
    per_anchor = j.groupBy(*keys, "Anchor").agg(
        *[F.sum(F.when(role == "cur", F.col(f"v_{n}"))).alias(f"cur_{n}") for n, _ in SPLITS],
        *[F.sum(F.when(role == "py", F.col(f"v_{n}"))).alias(f"py_{n}") for n, _ in SPLITS],
        F.sum(F.when(role == "prev", F.col("v_Incidents"))).alias("prev"))
    # the latest anchor with data and the values at it: primitive max_by
    # aggregates (hash aggregation, no sort); anchors without data have a
    # NULL ordering and are skipped
    with_data = F.when(F.col("cur_Incidents").isNotNull(), F.col("Anchor"))
    aggs = ([F.sum(f"cur_{n}").alias(n) for n, _ in SPLITS]
            + [F.sum(f"py_{n}").alias(f"{n}_PY") for n, _ in SPLITS]
            + [F.max(with_data).alias("_lm_date"),
               F.max_by("cur_Incidents", with_data).alias("_lm_cur"),
               F.max_by("prev", with_data).alias("_lm_prev")])
    g = per_anchor.groupBy(*keys).agg(*aggs) if keys else per_anchor.agg(*aggs)
    cols = [F.col(k) for k in keys]
    for n, _ in SPLITS:
        chg = blank_minus(F.col(n), F.col(f"{n}_PY"))
        cols += [F.col(n), F.col(f"{n}_PY"), chg.alias(f"{n}_Chg"),
                 blank_divide(chg, F.col(f"{n}_PY")).alias(f"{n}_Pct_Chg")]
    lm_chg = blank_minus(F.col("_lm_cur"), F.col("_lm_prev"))
    label = F.upper(F.date_format("_lm_date", "MMM"))
    cols += [F.col("_lm_date").alias("LatestMonth"),
             F.col("_lm_cur").alias("Incidents_Latest_Month"),
             F.col("_lm_prev").alias("Incidents_Previous_Month"),
             lm_chg.alias("Latest_Month_Chg"),
             blank_divide(lm_chg, F.col("_lm_prev")).alias("Pct_Latest_Month_Chg"),
             label.alias("Latest_Month_Label"),
             F.concat(F.lit("LATEST MONTH • "), label).alias("Latest_Month_Label2")]
    return _with_plant_names(g.select(*cols), star, list(by))


YOY_COLUMNS = [f"{n}{s}" for n, _ in SPLITS for s in ("", "_PY", "_Chg", "_Pct_Chg")]
LATEST_COLUMNS = ["LatestMonth", "Incidents_Latest_Month", "Incidents_Previous_Month", "Latest_Month_Chg",
                  "Pct_Latest_Month_Chg", "Latest_Month_Label", "Latest_Month_Label2"]


def year_over_year(star: Star, ctx: FilterContext = ALL, by: Sequence[str] = ()) -> DataFrame:
    """M1..M12 per group: current, prior year (dates shifted one year back
    within the calendar), change and percentage, for all, Internal, External.
    Groups where every one of them is blank are not shown."""
    keys = list(by)
    out = measure_frame(star, ctx, by).select(*keys, *YOY_COLUMNS)
    if not keys:
        return out
    return out.filter(F.coalesce(*[F.col(f"{n}{s}") for n, _ in SPLITS for s in ("", "_PY")]).isNotNull())


def totals(star: Star, ctx: FilterContext = ALL, by: Sequence[str] = ()) -> DataFrame:
    """M1..M3 only (no shifted dates needed)."""
    other_by, date_by = _split_by(by)
    vis = visible_dates(star, ctx)
    base = monthly_base(star, ctx, other_by)
    out = _sum_values(base.join(F.broadcast(vis.select("DateKey", *date_by)), "DateKey"),
                      _fact_keys(other_by) + list(date_by))
    return _with_plant_names(out, star, list(by))


def latest_month(star: Star, ctx: FilterContext = ALL, by: Sequence[str] = ()) -> DataFrame:
    """M13..M19 per group: the latest visible date with data, its total,
    the month before (date filters replaced, so it crosses a year end),
    change, percentage and the labels."""
    keys = list(by)
    out = measure_frame(star, ctx, by).select(*keys, *LATEST_COLUMNS)
    return out.filter(F.col("LatestMonth").isNotNull()) if keys else out


def selected_year(star: Star, ctx: FilterContext = ALL, by: Sequence[str] = ()) -> DataFrame:
    """M20..M24 per group: the one visible year or 'All years', the card
    labels, and 'PY <greatest visible year - 1>'.  Only date-table columns
    may be grouped on (labels depend on the calendar alone)."""
    other_by, date_by = _split_by(by)
    if other_by:
        raise ValueError("labels are grouped by calendar columns only")
    return selected_year_columns(star, ctx, date_by)


def selected_year_columns(star: Star, ctx: FilterContext, date_by: Sequence[str] = (),
                          onto: DataFrame | None = None) -> DataFrame:
    """The label columns; without group columns they are two scalar
    subqueries added to ``onto`` (or to a one-row frame)."""
    vis = visible_dates(star, ctx)
    if date_by:
        g = vis.groupBy(*date_by).agg(F.count_distinct("Year").alias("_n"), F.max("Year").alias("_max"))
    else:
        n = vis.agg(F.count_distinct("Year")).scalar()
        mx = vis.agg(F.max("Year")).scalar()
        base = onto if onto is not None else vis.sparkSession.range(1).drop("id")
        g = base.withColumns({"_n": n, "_max": mx})
        date_by = [c for c in base.columns]
    sel = F.when(F.col("_n") == 1, F.col("_max").cast("string")).otherwise(F.lit("All years"))
    return g.select(*date_by, sel.alias("Selected_Year"),
                    F.concat(F.lit("TOTAL INCIDENTS • "), sel).alias("Incidents_Label"),
                    F.concat(F.lit("INTERNAL • "), sel).alias("Internal_Label"),
                    F.concat(F.lit("EXTERNAL • "), sel).alias("External_Label"),
                    F.concat(F.lit("PY "), (F.col("_max") - 1).cast("string")).alias("PY_Label"))


def overview_signal(star: Star, ctx: FilterContext = ALL, by: Sequence[str] = ()) -> DataFrame:
    """One sentence per group from the year and month changes."""
    keys = list(by)
    out = measure_frame(star, ctx, by)
    if keys:
        out = out.filter(F.coalesce(*[F.col(f"{n}{s}") for n, _ in SPLITS for s in ("", "_PY")]).isNotNull())
    return out.select(*keys, signal_text(F.col("Incidents_Pct_Chg"), F.col("Pct_Latest_Month_Chg"),
                                         F.col("LatestMonth")).alias("Overview_Signal"))


def signal_text(total_pct: Column, month_pct: Column, latest: Column) -> Column:
    # a blank month percentage compares as 0: 'increased', shown as 0.0%
    month_val = F.coalesce(month_pct, F.lit(0.0))
    sentence = F.concat(
        F.lit("Total incidents are "), pct_one_decimal(total_pct), F.lit(" "),
        F.when(total_pct >= 0, F.lit("higher")).otherwise(F.lit("lower")),
        F.lit(" than PY, while "), month_name(latest), F.lit(" "),
        F.when(month_val >= 0, F.lit("increased")).otherwise(F.lit("decreased")), F.lit(" "),
        pct_one_decimal(month_val), F.lit(" versus "),
        month_name(F.add_months(latest, -1)),
        F.when(month_val > 0, F.lit(" and should be monitored")).otherwise(F.lit("")),
        F.lit("."))
    return F.when(total_pct.isNull(), F.lit("No prior-year data available for the selected period.")
                  ).otherwise(sentence)
