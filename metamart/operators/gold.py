"""Gold star schema builders (G1..G7) and the output contract (K1)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metamart import schemas
from metamart.functions.dates import calendar_columns, month_short
from metamart.functions.text import type_label
from metamart.operators.keys import dense_keys
from metamart.operators.silver import active_mapping


class ContractViolation(RuntimeError):
    """A gold table breaks NOT NULL or a length limit; nothing is published."""


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    dim_plant: DataFrame
    dim_incident_type: DataFrame
    dim_date: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {"dim_plant": self.dim_plant, "dim_incident_type": self.dim_incident_type,
                "dim_date": self.dim_date, "fact": self.fact}


def plant_years(silver: DataFrame) -> DataFrame:
    """(Plant, Yr, FirstMonth, LastMonth): one pass over silver that feeds
    both the plant and the calendar dimension; bounded by plants x years."""
    return (silver.groupBy("Plant", F.year("Month").alias("Yr"))
            .agg(F.min("Month").alias("FirstMonth"), F.max("Month").alias("LastMonth")))


def dim_plant(silver: DataFrame, keys_source: DataFrame | None = None) -> DataFrame:
    """Distinct plants, keyed 1..n in name order (NULL first).  Keys are
    dense ranks computed without a one-partition sort (see ``dense_keys``)."""
    src = keys_source if keys_source is not None else silver
    plants = src.select(F.col("Plant").alias("PlantCode")).distinct()
    return (dense_keys(plants, ["PlantCode"], key="PlantKey")
            .select("PlantKey", "PlantCode"))


def dim_type(mapping: DataFrame) -> DataFrame:
    """Distinct active (classification, code group); key = sort order,
    Internal first.  Built from mappings: a type may have no facts."""
    types = active_mapping(mapping).select("Classification", "CodeGroup").distinct()
    order = Window.orderBy(F.when(F.col("Classification") == "Internal", 1).otherwise(2),
                           F.col("CodeGroup"), F.col("Classification"))
    # a handful of rows (bounded by the mapping metadata): one window is fine
    return (types.withColumn("SortOrder", F.row_number().over(order).cast("bigint"))
            .select(F.col("SortOrder").alias("IncidentTypeKey"), "Classification", "CodeGroup",
                    type_label("Classification", "CodeGroup").alias("IncidentTypeName"),
                    "SortOrder"))


def year_bounds(silver: DataFrame, keys_source: DataFrame | None = None) -> DataFrame:
    """Per year with data: first and last month (partial aggregation)."""
    if keys_source is not None:
        src = keys_source
        return (src.filter(F.col("Yr").isNotNull()).groupBy("Yr")
                .agg(F.min("FirstMonth").alias("FirstMonth"), F.max("LastMonth").alias("LastMonth")))
    return (silver.groupBy(F.year("Month").alias("Yr"))
            .agg(F.min("Month").alias("FirstMonth"), F.max("Month").alias("LastMonth"))
            .filter(F.col("Yr").isNotNull()))


def periods(silver: DataFrame, years: DataFrame | None = None) -> DataFrame:
    """'Jan–Dec 2019' from the first and last month with data in each year."""
    y = years if years is not None else year_bounds(silver)
    return y.select(F.col("Yr").cast("int").alias("Yr"), F.concat(
        month_short("FirstMonth"), F.lit("–"), month_short("LastMonth"),
        F.lit(" "), F.col("Yr").cast("string")).alias("Period"))


def dim_date(silver: DataFrame, keys_source: DataFrame | None = None) -> DataFrame:
    """Every day from 1 Jan of the first year to 31 Dec of the last, for the
    years that have data (a gap year has no days).  The calendar is bounded
    by the date span, not by the number of rows."""
    years = year_bounds(silver, keys_source)
    per = periods(silver, years)
    bounds = years.agg(F.min("Yr").alias("y0"), F.max("Yr").alias("y1"))
    days = bounds.select(F.explode(F.sequence(F.make_date("y0", F.lit(1), F.lit(1)),
                                              F.make_date("y1", F.lit(12), F.lit(31)),
                                              F.expr("INTERVAL 1 DAY"))).alias("Date"))
    days = calendar_columns(days)
    return (days.join(F.broadcast(per), days.Year == per.Yr, "inner")
            .select("DateKey", "Date", "Year", "MonthNumber", "MonthShort", "Period"))


def fact(silver: DataFrame, dp: DataFrame, dd: DataFrame, dt: DataFrame) -> DataFrame:
    """Silver with the three keys; unmatched rows drop; grain of silver.

    No join is forced: the planner broadcasts a dimension by its size in
    bytes, beyond its limit it shuffles and splits a hot plant.
    """
    plants = dp.select("PlantKey", F.col("PlantCode").alias("Plant"))
    dates = dd.select("DateKey", F.col("Date").alias("Month"))
    types = dt.select("IncidentTypeKey", "Classification", "CodeGroup")
    return (silver.join(plants, "Plant").join(dates, "Month")
            .join(types, ["Classification", "CodeGroup"])
            .select("PlantKey", "DateKey", "IncidentTypeKey",
                    F.col("Incidents").cast("int").alias("Incidents")))


def build_star(silver: DataFrame, mapping: DataFrame) -> Star:
    dp, dt, dd = dim_plant(silver), dim_type(mapping), dim_date(silver)
    return Star(fact(silver, dp, dd, dt), dp, dt, dd)


def gold_counts(star: Star) -> DataFrame:
    """Row counts of the fact, plant and incident-type tables (one row each)."""
    def one(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.lit(name).alias("TableName"), F.count(F.lit(1)).alias("RowCount"))
    return (one("FactIncidents", star.fact)
            .unionByName(one("DimPlant", star.dim_plant))
            .unionByName(one("DimIncidentType", star.dim_incident_type)))


def contract_checks(table: str) -> list:
    """Aggregates counting NULLs in NOT NULL columns and over-long texts."""
    schema = schemas.GOLD_SCHEMAS[table]
    checks = [F.count_if(F.col(f.name).isNull()).alias(f"null:{f.name}")
              for f in schema.fields if not f.nullable]
    checks += [F.count_if(F.length(c) > n).alias(f"length>{n}:{c}")
               for c, n in schemas.GOLD_LENGTHS[table].items()]
    return checks


def contract_violations(df: DataFrame, table: str) -> DataFrame:
    """One row: number of NULLs per NOT NULL column and of over-long texts."""
    return df.agg(*contract_checks(table))


def raise_on_violations(table: str, metrics: dict) -> None:
    bad = {k: v for k, v in metrics.items() if (k.startswith("null:") or k.startswith("length>")) and v}
    if bad:
        raise ContractViolation(f"{table}: {bad}")


def enforce_contract(df: DataFrame, table: str) -> None:
    """Raise ContractViolation when any check counts a bad row."""
    raise_on_violations(table, contract_violations(df, table).first().asDict())
