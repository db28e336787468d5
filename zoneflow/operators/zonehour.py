"""Roll the fact table up to zone-hour features.

Shape of the plan: events are combined per (zone, hour, category) before the
first shuffle, so the volume after it depends on zones, hours and categories
and no longer on events.  The two further steps work on that small table.  The
windows run per zone over observed hours; a zone has at most one row per hour
of the calendar, however many events it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zoneflow.functions.time import CALENDAR_PARTS, add_calendar_parts, epoch_seconds, hour_of
from zoneflow.operators.enrich import WEATHER_COLUMNS

# The calendar columns follow from date and hour, so they are no part of the key:
# the keys stay narrow and the calendar is worked out per zone-hour, not per event.
KEYS = ["zone_id", "event_date", "event_hour"]
MEANS = [c for c in WEATHER_COLUMNS if c != "weather_code"]
# Columns of the zone-hour table.
ZONE_HOUR_COLUMNS = [
    "zone_id", "date", "date_hour", "hour", "weekday", "month", "quarter", "is_weekend", "is_holiday",
    "is_business_hour", "is_after_hours", *WEATHER_COLUMNS, "lag_1_hour_demand", "lag_24_hour_demand",
    "rolling_7_day_avg", "prior_week_same_hour_demand", "category_mix_top_1_share",
    "category_mix_top_3_share", "target_demand_count", "high_demand_flag",
]
LAG_NAMES = {1: "lag_1_hour_demand", 24: "lag_24_hour_demand", 168: "prior_week_same_hour_demand"}


def category_counts(fact: DataFrame) -> DataFrame:
    """Demand per zone-hour and category, with sums and counts that later give the weather means."""
    partials = [F.sum(c).alias(f"_sum_{c}") for c in MEANS] + [F.count(c).alias(f"_n_{c}") for c in MEANS]
    return fact.groupBy(*KEYS, "normalized_service_category").agg(
        F.sum("demand_count").alias("_demand"),
        F.count(F.lit(1)).alias("_rows"),
        F.min("weather_code").alias("weather_code"),
        *partials,
    )


def rollup(fact: DataFrame) -> DataFrame:
    """One row per zone and observed hour: demand, mean weather and category concentration."""
    order = W.partitionBy(*KEYS).orderBy(F.desc("_rows"), F.asc("normalized_service_category"))
    ranked = category_counts(fact).withColumn("_rank", F.row_number().over(order))
    total = F.sum("_rows")

    def top(k: int) -> Column:
        return F.sum(F.when(F.col("_rank") <= k, F.col("_rows")).otherwise(0)) / total

    means = [F.try_divide(F.sum(f"_sum_{c}"), F.sum(f"_n_{c}")).alias(c) for c in MEANS]
    rolled = (
        ranked.groupBy(*KEYS)
        .agg(
            F.sum("_demand").alias("target_demand_count"),
            *means,
            F.min("weather_code").alias("weather_code"),
            top(1).alias("category_mix_top_1_share"),
            top(3).alias("category_mix_top_3_share"),
        )
        .withColumnsRenamed({"event_date": "date", "event_hour": "hour"})
        .withColumn("date_hour", hour_of("date", "hour"))
    )
    return add_calendar_parts(rolled, "date", "hour")


def densify(zone_hour: DataFrame) -> DataFrame:
    """Add a zero-demand row for every missing hour between a zone's first and last hour.

    The spine grows day by day and then by 24 hours, so no row holds a long array.
    """
    span = zone_hour.groupBy("zone_id").agg(
        F.min("date_hour").alias("_first"), F.max("date_hour").alias("_last")
    )
    spine = (
        span.withColumn("date", F.explode(F.sequence(F.col("_first").cast("date"), F.col("_last").cast("date"))))
        .withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
        .withColumn("date_hour", hour_of("date", "hour"))
        .filter("date_hour between _first and _last")
        .select("zone_id", "date", "hour", "date_hour")
    )
    measured = zone_hour.drop("date", "hour", *CALENDAR_PARTS)
    dense = add_calendar_parts(spine.join(measured, ["zone_id", "date_hour"], "left"), "date", "hour")
    undated = zone_hour.filter(F.col("date_hour").isNull())
    return dense.withColumn("target_demand_count", F.coalesce("target_demand_count", F.lit(0))).unionByName(undated)


def add_history(zone_hour: DataFrame, window: int = 168) -> DataFrame:
    """Add demand 1, 24 and 168 rows back and the mean of the rows before, per zone in time order.

    Offsets count observed rows, not hours; on a dense table both are the same.
    """
    by_time = W.partitionBy("zone_id").orderBy("date_hour")
    before = by_time.rowsBetween(-window, -1)
    demand = F.col("target_demand_count")
    columns = {
        name: F.coalesce(F.lag(demand, n).over(by_time), F.lit(0).cast("long")) for n, name in LAG_NAMES.items()
    }
    columns["rolling_7_day_avg"] = F.coalesce(F.avg(demand).over(before), F.lit(0.0))
    return zone_hour.withColumns(columns)


def add_history_by_time(zone_hour: DataFrame, window: int = 168) -> DataFrame:
    """The history that a dense table would give, from the observed rows alone.

    Offsets are hours: frames over the time axis find the row of that hour, or nothing, which is no demand.  The mean
    divides by the hours since the zone's first, at most ``window``.  A row without a time has no history.
    """
    hours = F.floor(epoch_seconds("date_hour") / 3600)
    by_hour = W.partitionBy("zone_id").orderBy("_hour")
    demand = F.sum("target_demand_count")
    none = F.lit(0).cast("long")
    dated = F.col("_hour").isNotNull()
    columns = {
        name: F.when(dated, F.coalesce(demand.over(by_hour.rangeBetween(-n, -n)), none)).otherwise(none)
        for n, name in LAG_NAMES.items()
    }
    first = F.min("_hour").over(W.partitionBy("zone_id"))
    passed = F.least(F.col("_hour") - first, F.lit(window))
    mean = F.try_divide(demand.over(by_hour.rangeBetween(-window, -1)), passed)
    columns["rolling_7_day_avg"] = F.when(dated & (passed > 0), F.coalesce(mean, F.lit(0.0))).otherwise(0.0)
    return zone_hour.withColumn("_hour", hours).withColumns(columns).drop("_hour")


def add_high_demand(zone_hour: DataFrame, quantile: float = 0.75, exact: bool = True) -> DataFrame:
    """Flag hours above the zone's own quantile of hourly demand.

    A window over the zone, which is how the table is partitioned already after
    :func:`add_history`: no second shuffle and no join.
    """
    zone = W.partitionBy("zone_id")
    if exact:
        threshold = F.percentile("target_demand_count", F.lit(quantile)).over(zone)
    else:
        threshold = F.percentile_approx("target_demand_count", F.lit(quantile), F.lit(10000)).over(zone)
    flagged = zone_hour.withColumn("zone_high_threshold", threshold.cast("double"))
    return flagged.withColumn(
        "high_demand_flag", (F.col("target_demand_count") > F.col("zone_high_threshold")).cast("int")
    )


def build(
    fact: DataFrame, exact: bool = True, dense: bool = False, window: int = 168, quantile: float = 0.75,
    by_time: bool = False,
) -> DataFrame:
    """The 26-column zone-hour feature table; history counts rows, or hours with ``by_time`` or on a ``dense`` table."""
    zone_hour = rollup(fact)
    if dense:
        zone_hour = densify(zone_hour)
    history = add_history_by_time if by_time else add_history
    zone_hour = add_high_demand(history(zone_hour, window), quantile, exact)
    return zone_hour.select(*ZONE_HOUR_COLUMNS)
