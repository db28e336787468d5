"""Aggregate marts over the zone-hour table and the fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions import numeric as nu
from zoneflow.functions.text import UNCATEGORIZED, UNKNOWN_ZONE, to_bool, upper_key
from zoneflow.functions.time import add_period, day_name
from zoneflow.operators import schema
from zoneflow.operators.ranking import row_numbers

PERIOD = ["period", "year", "month"]
HOURS = list(range(24))
ALL, WEEKDAY, WEEKEND = "All", "Weekday", "Weekend"
PRECIPITATION_VIEW, TEMPERATURE_VIEW = "Precipitation band", "Temperature band"

# Accepted column names per role, best first, and whether the role is required.
MART_ROLES = {
    "zone_id": (["zone_id", "beat", "zone", "beat_id"], True),
    "date": (["date", "event_date", "service_date"], True),
    "hour": (["hour", "event_hour", "hour_of_day"], True),
    "weekday": (["weekday", "day_of_week"], True),
    "is_weekend": (["is_weekend", "weekend"], False),
    "demand_count": (["target_demand_count", "demand_count", "event_count", "call_count"], True),
    "is_after_hours": (["is_after_hours", "after_hours"], False),
    "high_demand_flag": (["high_demand_flag", "high_demand"], False),
    "temperature": (["temperature_2m", "temperature", "temp"], False),
    "precipitation": (["precipitation", "rain"], False),
    "rain": (["rain", "is_rain"], False),
}


def _sum(c: Column | str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def mart_input(zone_hour: DataFrame) -> DataFrame:
    """Zone-hour rows under the mart names, typed, with defaults and a period; undated rows are dropped."""
    found = {
        role: schema.choose_column(zone_hour.columns, names, role, required)
        for role, (names, required) in MART_ROLES.items()
    }

    def number(role: str, default: float | None) -> Column:
        if found[role] is None:
            return F.lit(default).cast("double")
        return F.coalesce(F.col(found[role]).try_cast("double"), F.lit(default).cast("double"))

    weekday = number("weekday", -1).cast("int")
    columns = {
        "zone_id": upper_key(F.coalesce(F.col(found["zone_id"]).cast("string"), F.lit(UNKNOWN_ZONE))),
        "date": F.col(found["date"]).try_cast("date"),
        "hour": number("hour", -1).cast("int"),
        "weekday": weekday,
        "weekday_name": day_name(weekday),
        "demand_count": number("demand_count", 0).cast("long"),
        "is_weekend": to_bool(found["is_weekend"]) if found["is_weekend"] else weekday.isin(5, 6),
        "is_after_hours": to_bool(found["is_after_hours"]) if found["is_after_hours"] else F.lit(False),
        "high_demand_flag": number("high_demand_flag", 0).cast("long"),
        **{c: number(c, None) for c in ("temperature", "precipitation", "rain")},
    }
    typed = zone_hour.select(*[c.alias(name) for name, c in columns.items()])
    return add_period(typed).filter(F.col("period").isNotNull())


def zone_summary(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Demand, shares, rates and peak hour per zone, optionally per period as well.

    Hours are summed first, so totals and the busiest hour come from one pass.
    """
    demand = F.col("demand_count")
    per_hour = rows.groupBy(*by, "zone_id", "hour").agg(
        F.sum(demand).alias("total"),
        F.count(F.lit(1)).alias("records"),
        _sum(F.when(F.col("is_weekend"), demand)).alias("weekend"),
        _sum(F.when(F.col("is_after_hours"), demand)).alias("after_hours"),
        F.sum("high_demand_flag").alias("high"),
        F.max(demand).alias("peak"),
    )
    return summary_of_hours(per_hour, by)


def summary_of_hours(per_hour: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Zone summary from the totals of each hour of the day."""
    zones = per_hour.groupBy(*by, "zone_id").agg(
        F.sum("total").alias("total_service_demand"),
        F.sum("records").alias("zone_hour_records"),
        F.sum("weekend").alias("weekend_demand"),
        F.sum("after_hours").alias("after_hours_demand"),
        F.sum("high").alias("high_demand_hours"),
        F.max("peak").alias("peak_hour_demand"),
        peak_hour("hour", "total").alias("peak_hour"),
    )
    return zones.withColumns(
        {
            "avg_calls_per_zone_hour": nu.safe_divide("total_service_demand", "zone_hour_records"),
            "weekend_share": nu.safe_divide("weekend_demand", "total_service_demand"),
            "after_hours_share": nu.safe_divide("after_hours_demand", "total_service_demand"),
            "high_demand_hour_rate": nu.safe_divide("high_demand_hours", "zone_hour_records"),
        }
    )


def peak_hour(hour: str, demand: str) -> Column:
    """Hour with the most demand, the earlier one on a tie."""
    return F.max_by(hour, F.struct(demand, -F.col(hour)))


def peak_hours(rows: DataFrame, by: Sequence[str] = ("zone_id",)) -> DataFrame:
    per_hour = rows.groupBy(*by, "hour").agg(F.sum("demand_count").alias("demand_count"))
    return per_hour.groupBy(*by).agg(
        peak_hour("hour", "demand_count").alias("peak_hour"), F.max("demand_count").alias("peak_demand")
    )


def _demand(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("demand_count").alias("demand_count"), F.count(F.lit(1)).alias("zone_hour_records")
    )


def hourly_demand(rows: DataFrame) -> DataFrame:
    return _demand(rows, *PERIOD, "date", "hour", "is_weekend")


def daily_demand(rows: DataFrame) -> DataFrame:
    return _demand(rows, *PERIOD, "date", "weekday", "weekday_name", "is_weekend")


def heatmap(rows: DataFrame) -> DataFrame:
    return _demand(rows, *PERIOD, "zone_id", "hour", "is_weekend")


def weather_context(rows: DataFrame) -> DataFrame:
    """Demand per precipitation band and per temperature band: both views from one grouping-sets pass."""
    banded = rows.filter(F.coalesce("temperature", "precipitation", "rain").isNotNull()).withColumns(
        {
            "precipitation_band": nu.precipitation_band("precipitation", "rain"),
            "temperature_band": nu.temperature_band("temperature"),
        }
    )
    period_keys = [F.col(c) for c in PERIOD]
    wet, warm = F.col("precipitation_band"), F.col("temperature_band")
    grouped = banded.groupingSets([[*period_keys, wet], [*period_keys, warm]], *period_keys, wet, warm).agg(
        F.sum("demand_count").alias("demand_count"),
        F.count(F.lit(1)).alias("zone_hour_records"),
        F.grouping("temperature_band").alias("_wet_view"),
    )
    is_wet = F.col("_wet_view") == 1
    return grouped.select(
        *PERIOD,
        F.when(is_wet, PRECIPITATION_VIEW).otherwise(TEMPERATURE_VIEW).alias("view"),
        F.when(is_wet, wet).otherwise(warm).alias("band"),
        "demand_count",
        "zone_hour_records",
        nu.safe_divide("demand_count", "zone_hour_records").alias("avg_demand_per_zone_hour"),
    )


def category_mix(fact: DataFrame) -> DataFrame:
    """Demand per period, zone and category over every fact row."""
    typed = fact.select(
        upper_key(F.coalesce("zone_id", F.lit(UNKNOWN_ZONE))).alias("zone_id"),
        F.trim(F.coalesce("normalized_service_category", F.lit(UNCATEGORIZED))).alias("service_category"),
        "demand_count",
        F.col("event_date").alias("date"),
    )
    out = add_period(typed).groupBy(*PERIOD, "zone_id", "service_category").agg(
        F.sum("demand_count").alias("demand_count"), F.count(F.lit(1)).alias("event_rows")
    )
    return out.withColumn("sample_based", F.lit(False))


def category_share(fact: DataFrame) -> DataFrame:
    """Events per category and their share of all events; the total is a scalar subquery."""
    counts = fact.groupBy("normalized_service_category").agg(F.count(F.lit(1)).alias("demand_count"))
    total = counts.agg(F.greatest(F.sum("demand_count"), F.lit(1))).scalar()
    return counts.withColumn("share_of_total", F.col("demand_count") / total)


def pivot_hours(rows: DataFrame, key: str, demand: str = "demand_count", hour: str = "hour") -> DataFrame:
    """Demand per key in 24 columns ``h0`` to ``h23``, 0 where there is none."""
    table = rows.groupBy(key).pivot(hour, HOURS).agg(F.sum(demand)).fillna(0)
    return table.withColumnsRenamed({str(h): f"h{h}" for h in HOURS})


# --- filtered views -------------------------------------------------------


def in_periods(rows: DataFrame, start: str, end: str) -> DataFrame:
    """Rows of an inclusive range of ``YYYY-MM`` periods; reversed bounds are swapped."""
    low, high = sorted((start, end))
    return rows.filter(F.col("period").between(low, high))


def of_day_type(rows: DataFrame, day_type: str = ALL) -> DataFrame:
    """All rows, weekdays only or weekends only."""
    if day_type not in (ALL, WEEKDAY, WEEKEND):
        raise ValueError(f"day_type must be {ALL}, {WEEKDAY} or {WEEKEND}")
    return rows if day_type == ALL else rows.filter(F.col("is_weekend") == F.lit(day_type == WEEKEND))


def view(rows: DataFrame, start: str, end: str, day_type: str = ALL) -> DataFrame:
    """Zone summary of the selected periods and days, real after-hours and high-demand values included."""
    return zone_summary(of_day_type(in_periods(rows, start, end), day_type))


def top_zones(summary: DataFrame, n: int) -> DataFrame:
    return summary.orderBy(F.desc("total_service_demand"), "zone_id").limit(n)


def top_zone_heatmap(rows: DataFrame, n: int = 20) -> DataFrame:
    """Hour-by-hour demand of the n busiest zones; the n zone ids are a bounded broadcast."""
    totals = rows.groupBy("zone_id").agg(F.sum("demand_count").alias("total_service_demand"))
    busiest = top_zones(totals, n).select("zone_id")
    return pivot_hours(rows.join(F.broadcast(busiest), "zone_id", "left_semi"), "zone_id")


def hourly_rhythm(rows: DataFrame) -> DataFrame:
    """Demand by hour for weekdays and weekends."""
    return rows.groupBy("hour", "is_weekend").agg(F.sum("demand_count").alias("demand_count")).withColumn(
        "period_type", F.when(F.col("is_weekend"), WEEKEND).otherwise(WEEKDAY)
    )


def peak_of_rhythm(rows: DataFrame) -> DataFrame:
    """Busiest point of the hourly rhythm; the earlier hour, then the weekday, on a tie."""
    order = F.struct("demand_count", -F.col("hour"), ~F.col("is_weekend"))
    best = hourly_rhythm(rows).agg(F.max_by(F.struct("hour", "period_type", "demand_count"), order).alias("p"))
    return best.select("p.*")


def weekly_pattern(rows: DataFrame) -> DataFrame:
    """Demand per weekday, Monday first."""
    return (
        rows.groupBy("weekday", "weekday_name").agg(F.sum("demand_count").alias("demand_count")).orderBy("weekday")
    )


def weather_bands(context: DataFrame, view_name: str) -> DataFrame:
    """Total demand per band of one weather view."""
    return (
        context.filter(F.col("view") == view_name).groupBy("band").agg(F.sum("demand_count").alias("demand_count"))
    )


def top_categories(mix: DataFrame, n: int = 12) -> DataFrame:
    totals = mix.groupBy("service_category").agg(F.sum("demand_count").alias("demand_count"))
    return totals.orderBy(F.desc("demand_count"), "service_category").limit(n)


def view_kpis(rows: DataFrame) -> DataFrame:
    """Totals of a view in one row: demand, records, active zones, top zone and peak hour.

    Cells of zone, hour and weekend flag are combined first; the zone and hour
    totals are then small groupings of that table.
    """
    zone, hour = F.col("zone_id"), F.col("hour")
    weekend = F.col("is_weekend")
    sets = rows.groupingSets([[zone], [hour, weekend]], zone, hour, weekend).agg(
        F.sum("demand_count").alias("demand"),
        F.count(F.lit(1)).alias("records"),
        F.grouping("hour").alias("_is_zone"),
    )
    is_zone = F.col("_is_zone") == 1
    best_hour = F.max_by(
        F.struct("hour", "is_weekend"),
        F.when(~is_zone, F.struct("demand", -F.col("hour"), ~F.col("is_weekend"))),
    )
    top = F.max(F.when(is_zone, F.col("demand")))
    totals = sets.agg(
        F.sum(F.when(is_zone, F.col("demand"))).alias("selected_demand"),
        F.sum(F.when(is_zone, F.col("records"))).alias("selected_records"),
        F.count(F.when(is_zone, F.col("zone_id"))).alias("active_zones"),
        top.alias("top_zone_demand"),
        F.min_by("zone_id", F.when(is_zone, F.struct(-F.col("demand"), F.col("zone_id")))).alias("top_zone"),
        best_hour.alias("_peak"),
    )
    return totals.select(
        "selected_demand", "selected_records", "active_zones", "top_zone", "top_zone_demand",
        F.col("_peak.hour").alias("peak_hour"),
        F.when(F.col("_peak.is_weekend"), WEEKEND).otherwise(WEEKDAY).alias("peak_context"),
    )


# --- zone profile, risk and KPIs ------------------------------------------


def zone_statistics(zone_hour: DataFrame) -> DataFrame:
    """Mean, spread and shares of hourly demand per zone."""
    return zone_hour.groupBy("zone_id").agg(
        F.avg("target_demand_count").alias("avg_hourly_demand"),
        F.stddev("target_demand_count").alias("demand_volatility"),
        F.var_pop("target_demand_count").alias("demand_variance"),
        F.avg(F.col("is_after_hours").cast("double")).alias("after_hours_share"),
        F.avg(F.col("is_weekend").cast("double")).alias("weekend_share"),
        F.avg("high_demand_flag").alias("high_demand_rate"),
    )


def zone_profile(fact: DataFrame) -> DataFrame:
    """Events, first and last event and the most frequent precinct, sector and category per zone.

    Ties go to the lowest value.  Each ``mode`` keeps one counter per distinct
    value of a zone, not per event.
    """
    return fact.groupBy("zone_id").agg(
        F.sum("demand_count").alias("total_events"),
        F.min("event_datetime").alias("first_event"),
        F.max("event_datetime").alias("last_event"),
        F.mode("precinct", True).alias("primary_precinct"),
        F.mode("sector", True).alias("primary_sector"),
        F.mode("normalized_service_category", True).alias("top_category"),
    )


# Weight of each measure in the workload risk score.
RISK_WEIGHTS = {
    "total_events": 0.35,
    "avg_hourly_demand": 0.25,
    "demand_volatility": 0.20,
    "after_hours_share": 0.10,
    "weekend_share": 0.10,
}


def add_risk_score(zones: DataFrame) -> DataFrame:
    """Weighted mean of five measures, each scaled to 0..100 over all zones.

    The bounds come from one scalar subquery, so zones are scaled in parallel
    and no window runs over the whole table.
    """
    measures = list(RISK_WEIGHTS)
    filled = {m: F.coalesce(F.col(m).cast("double"), F.lit(0.0)) for m in measures}
    bounds = zones.agg(
        F.struct(
            *[F.min(c).alias(f"low_{m}") for m, c in filled.items()],
            *[F.max(c).alias(f"high_{m}") for m, c in filled.items()],
        ).alias("b")
    ).scalar()
    scored = zones.withColumn("_b", bounds)
    total = F.lit(0.0)
    for m, weight in RISK_WEIGHTS.items():
        total = total + nu.scale_0_100(F.col(m), F.col(f"_b.low_{m}"), F.col(f"_b.high_{m}")) * weight
    return scored.withColumn("workload_risk_score", F.bround(total, 1)).drop("_b")


def zone_measures(fact: DataFrame, zone_hour: DataFrame) -> DataFrame:
    """Zone profile with the statistics of its hourly demand."""
    return zone_profile(fact).join(zone_statistics(zone_hour), "zone_id", "left")


def risk_table(fact: DataFrame, zone_hour: DataFrame) -> DataFrame:
    """Zone profile with its statistics and workload risk score."""
    return add_risk_score(zone_measures(fact, zone_hour))


def rank_zones(zones: DataFrame, measure: str = "workload_risk_score", blocks: int | None = None) -> DataFrame:
    """Add the rank of each zone by falling measure, zone id on a tie."""
    lowered = zones.withColumn("_fall", -F.col(measure))
    return row_numbers(lowered, "_fall", ["zone_id"], "rank", blocks).drop("_fall")


def zone_weather_summary(zone_hour: DataFrame) -> DataFrame:
    """Zone-hours, mean demand and high-demand rate per precipitation flag and whole degree."""
    return (
        zone_hour.withColumns(
            {
                "precipitation_flag": nu.precipitation_flag("precipitation", "rain"),
                "temperature_bucket": nu.temperature_bucket("temperature_2m"),
            }
        )
        .groupBy("precipitation_flag", "temperature_bucket")
        .agg(
            F.count(F.lit(1)).alias("observed_zone_hours"),
            F.avg("target_demand_count").alias("avg_demand"),
            F.avg("high_demand_flag").alias("high_demand_rate"),
        )
    )


def dimensions(fact: DataFrame) -> dict[str, DataFrame]:
    """The four star-schema dimensions as distinct projections of the fact table."""
    columns = {
        "dim_date": [
            "event_date", "weekday", "weekday_name", "month", "month_name", "quarter", "year", "season",
            "is_weekend", "is_holiday",
        ],
        "dim_location": ["zone_id", "beat", "sector", "precinct", "latitude", "longitude"],
        "dim_service_category": ["normalized_service_category"],
        "dim_weather_hour": [
            "weather_hour", "temperature_2m", "relative_humidity_2m", "precipitation", "rain", "snowfall",
            "weather_code", "wind_speed_10m",
        ],
    }
    return {name: fact.select(*cols).distinct() for name, cols in columns.items()}


def executive_kpis(fact: DataFrame, risk: DataFrame, sample_mode: bool = False) -> DataFrame:
    """Eight headline figures as metric, value and detail rows.

    Events are combined per zone and category first; distinct counts and top
    entries are taken from that small table.
    """
    cells = fact.groupBy("zone_id", "normalized_service_category").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_datetime").alias("lo"), F.max("event_datetime").alias("hi")
    )
    categories = cells.groupBy("normalized_service_category").agg(F.sum("n").alias("n"))
    top_category = categories.agg(
        F.min_by("normalized_service_category", F.struct(-F.col("n"), F.col("normalized_service_category")))
    ).scalar()
    top_zone = risk.agg(F.min_by("zone_id", F.struct(-F.col("workload_risk_score"), F.col("zone_id")))).scalar()
    totals = cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("events"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.count_distinct("zone_id").alias("zones"),
        F.count_distinct("normalized_service_category").alias("categories"),
    ).withColumns({"top_zone": top_zone, "top_category": top_category})
    rows = [
        ("total_service_events", F.col("events"), "Rows in the fact table"),
        ("date_start", F.substring(F.col("lo").cast("string"), 1, 19), "Earliest service-event timestamp"),
        ("date_end", F.substring(F.col("hi").cast("string"), 1, 19), "Latest service-event timestamp"),
        ("unique_zones", F.col("zones"), "Distinct zones/beats"),
        ("unique_categories", F.col("categories"), "Distinct normalized service categories"),
        ("top_workload_risk_zone", F.coalesce("top_zone", F.lit("n/a")), "Highest workload-risk score"),
        ("top_service_category", F.coalesce("top_category", F.lit("n/a")), "Largest event category"),
        ("sample_mode", F.lit(str(sample_mode)), "Whether the run used sample mode"),
    ]
    return totals.select(F.inline(F.array(*[metric_row(*r) for r in rows])))


def metric_row(metric: str, value: Column, detail: str) -> Column:
    return F.struct(
        F.lit(metric).alias("metric"), value.cast("string").alias("value"), F.lit(detail).alias("detail")
    )


def dashboard_kpis(rows: DataFrame, before: DataFrame, after: DataFrame, mapped_polygons: int) -> DataFrame:
    """One row of dashboard totals: lineage counts, zone-hour counts, bounds and the sorted periods."""
    from zoneflow.operators.enrich import lineage

    cells = rows.groupBy("zone_id", "period").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi")
    )
    totals = cells.agg(
        F.sum("n").alias("zone_hour_records"),
        F.count_distinct("zone_id").alias("active_zones_beats"),
        F.min("lo").cast("string").alias("date_start"),
        F.max("hi").cast("string").alias("date_end"),
        F.sort_array(F.collect_set("period")).alias("periods"),
    )
    traced = lineage(before, after).select(
        F.col("input_rows").alias("cleaned_input_events"),
        F.col("output_rows").alias("fact_output_rows"),
        F.col("output_ids").alias("unique_event_ids"),
        F.col("duplicate_rows").alias("post_enrichment_duplicate_fact_rows"),
        F.col("duplicate_impact").alias("post_enrichment_duplicate_impact"),
    )
    record = traced.select(F.struct("*").alias("r")).scalar()
    return (
        totals.withColumn("_l", record)
        .select("*", "_l.*")
        .drop("_l")
        .withColumns(
            {
                "period_start": F.get("periods", F.lit(0)),
                "period_end": F.try_element_at("periods", F.lit(-1)),
                "mapped_beat_polygons": F.lit(mapped_polygons),
            }
        )
    )
