"""Enrichment of events with zone attributes and hourly context.

Both joins keep the row count: each dimension is made unique on its key first.
How they are joined is left to Spark, which knows the sizes at run time and
splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.numeric import safe_divide
from zoneflow.functions.text import UNKNOWN_ZONE, completeness, upper_key
from zoneflow.functions.time import add_calendar, floor_hour
from zoneflow.operators import schema
from zoneflow.operators.collapse import keep_first

# Weather measures and columns of the fact table.
WEATHER_COLUMNS = [
    "temperature_2m", "relative_humidity_2m", "precipitation", "rain", "snowfall", "weather_code",
    "wind_speed_10m",
]
FACT_COLUMNS = [
    "event_id", "event_datetime", "weather_hour", "event_date", "event_hour", "weekday", "weekday_name",
    "month", "month_name", "quarter", "year", "season", "is_weekend", "is_holiday", "is_business_hour",
    "is_after_hours", "zone_id", "beat", "sector", "precinct", "latitude", "longitude", "initial_call_type",
    "final_call_type", "normalized_service_category", "disposition", *WEATHER_COLUMNS, "data_quality_flag",
    "demand_count",
]


def unique_zones(lookup: DataFrame) -> DataFrame:
    """Zone lookup with normalized keys and one row per zone, the fullest one first."""
    zones = lookup.select(
        upper_key("zone_id").alias("zone_id"),
        upper_key("precinct").alias("precinct"),
        upper_key("sector").alias("sector"),
    )
    return keep_first(zones, ["zone_id"], [-completeness("precinct", "sector"), "precinct", "sector"])


def unique_hours(hourly: DataFrame) -> DataFrame:
    """Hourly context made unique *after* flooring to the wall-clock hour.

    De-duplicating before flooring, or flooring to zoned timestamps, lets two
    rows share one hour on a daylight saving day and doubles events.
    """
    hourly = schema.fill_missing(hourly, {c: "double" for c in WEATHER_COLUMNS})
    hourly = hourly.select(
        floor_hour("weather_hour").alias("weather_hour"), *[F.col(c).cast("double") for c in WEATHER_COLUMNS]
    )
    return keep_first(hourly, ["weather_hour"], [-completeness(*WEATHER_COLUMNS), *WEATHER_COLUMNS])


def join_zone(events: DataFrame, lookup: DataFrame) -> DataFrame:
    """Fill missing precinct and sector from the zone lookup; unmatched zones stay."""
    zones = unique_zones(lookup).select(
        "zone_id", F.col("precinct").alias("_precinct"), F.col("sector").alias("_sector")
    )
    return (
        events.join(zones, "zone_id", "left")
        .withColumns(
            {
                "precinct": F.coalesce("precinct", "_precinct"),
                "sector": F.coalesce("sector", "_sector"),
            }
        )
        .drop("_precinct", "_sector")
    )


def join_hourly(events: DataFrame, hourly: DataFrame) -> DataFrame:
    """Add the weather of the event's hour; events without weather stay."""
    return events.join(unique_hours(hourly), "weather_hour", "left")


def build_fact(events: DataFrame, hourly: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """The 35-column fact table: one row per cleaned event."""
    fact = events.withColumns(
        {
            "zone_id": F.coalesce("zone_id", F.lit(UNKNOWN_ZONE)),
            "demand_count": F.lit(1),
        }
    ).withColumn("beat", F.coalesce("beat", "zone_id"))
    fact = add_calendar(fact)
    if lookup is not None:
        fact = join_zone(fact, lookup)
    fact = join_hourly(fact, hourly)
    fact = schema.fill_missing(fact, {c: "string" for c in FACT_COLUMNS})
    return fact.select(*FACT_COLUMNS)


def lineage(before: DataFrame, after: DataFrame, key: str = "event_id") -> DataFrame:
    """Row and id counts on both sides of a step: lost ids, new ids, extra rows and their share.

    One aggregation over both sides instead of two anti joins and two distinct
    counts; copies of an id are counted before the shuffle.
    """
    sides = before.select(key, F.lit(1).alias("b"), F.lit(0).alias("a")).unionAll(
        after.select(key, F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    per_id = sides.groupBy(key).agg(F.sum("b").alias("b"), F.sum("a").alias("a"))

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("long")

    def ids(condition):
        return F.count(F.when(condition, 1))

    b, a = F.col("b"), F.col("a")
    totals = per_id.agg(
        total(b).alias("input_rows"),
        total(a).alias("output_rows"),
        ids(b > 0).alias("input_ids"),
        ids(a > 0).alias("output_ids"),
        ids((b > 0) & (a == 0)).alias("missing_ids"),
        ids((a > 0) & (b == 0)).alias("new_ids"),
    )
    extra = F.greatest(F.col("output_rows") - F.col("output_ids"), F.lit(0))
    return totals.withColumns(
        {
            "duplicate_rows": extra,
            "duplicate_impact": safe_divide(extra, F.col("input_rows")),
        }
    )


def coverage(fact: DataFrame) -> DataFrame:
    """Run totals in one pass over the fact table: rows, matched rows, weather coverage, bounds."""
    return fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count("temperature_2m").alias("weather_rows"),
        safe_divide(F.count("temperature_2m"), F.count(F.lit(1))).alias("weather_join_coverage"),
        F.min("event_datetime").alias("first_event"),
        F.max("event_datetime").alias("last_event"),
    )
