"""Named reports over the fact, zone-hour, prediction and profile tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from zoneflow.functions import numeric as nu

Tables = Mapping[str, DataFrame]
REPORTS: dict[str, Callable[[Tables], DataFrame]] = {}
TOP = 25


def report(fn):
    REPORTS[fn.__name__] = fn
    return fn


def _count(df: DataFrame, *keys: str, name: str = "demand_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


@report
def demand_by_hour_weekday(t: Tables) -> DataFrame:
    counts = t["fact"].groupBy("weekday_name", "event_hour").agg(
        F.count(F.lit(1)).alias("demand_count"), F.min("weekday").alias("_weekday")
    )
    return counts.orderBy("_weekday", "event_hour").drop("_weekday")


@report
def demand_by_month(t: Tables) -> DataFrame:
    return _count(t["fact"], "year", "month", "month_name").orderBy("year", "month")


@report
def demand_by_zone(t: Tables) -> DataFrame:
    return _count(t["fact"], "zone_id", "precinct", "sector").orderBy(F.desc("demand_count"), "zone_id")


@report
def demand_by_service_category(t: Tables) -> DataFrame:
    return _count(t["fact"], "normalized_service_category").orderBy(
        F.desc("demand_count"), "normalized_service_category"
    )


@report
def top_demand_zones(t: Tables) -> DataFrame:
    return _count(t["fact"], "zone_id").orderBy(F.desc("demand_count"), "zone_id").limit(TOP)


@report
def peak_demand_windows(t: Tables) -> DataFrame:
    counts = t["fact"].groupBy("weekday_name", "event_hour").agg(
        F.count(F.lit(1)).alias("demand_count"), F.min("weekday").alias("_weekday")
    )
    return counts.orderBy(F.desc("demand_count"), "_weekday", "event_hour").limit(TOP).drop("_weekday")


@report
def weekend_vs_weekday_demand(t: Tables) -> DataFrame:
    return _count(t["fact"], "is_weekend")


@report
def business_vs_after_hours_demand(t: Tables) -> DataFrame:
    return _count(t["fact"], "is_after_hours")


@report
def weather_and_demand_relationship(t: Tables) -> DataFrame:
    bucketed = t["fact"].withColumns(
        {
            "temperature_bucket": nu.temperature_bucket("temperature_2m"),
            "precipitation_flag": nu.precipitation_flag("precipitation"),
        }
    )
    return _count(bucketed, "temperature_bucket", "precipitation_flag").orderBy("temperature_bucket")


@report
def zone_category_concentration(t: Tables) -> DataFrame:
    return _count(t["fact"], "zone_id", "normalized_service_category").orderBy("zone_id", F.desc("demand_count"))


@report
def demand_volatility_by_zone(t: Tables) -> DataFrame:
    return (
        t["zone_hour"]
        .groupBy("zone_id")
        .agg(
            F.avg("target_demand_count").alias("avg_hourly_demand"),
            F.var_pop("target_demand_count").alias("demand_variance"),
        )
        .orderBy(F.desc("demand_variance"), "zone_id")
    )


@report
def monthly_trend(t: Tables) -> DataFrame:
    return _count(t["fact"], "year", "month").orderBy("year", "month")


@report
def workload_risk_score_by_zone(t: Tables) -> DataFrame:
    return (
        t["zone_hour"]
        .groupBy("zone_id")
        .agg(
            F.avg("target_demand_count").alias("avg_hourly_demand"),
            F.avg("high_demand_flag").alias("high_demand_rate"),
            F.avg(F.col("is_after_hours").cast("int")).alias("after_hours_share"),
            F.avg(F.col("is_weekend").cast("int")).alias("weekend_share"),
        )
        .orderBy(F.desc("high_demand_rate"), F.desc("avg_hourly_demand"), "zone_id")
    )


@report
def top_forecasted_high_demand_zones(t: Tables) -> DataFrame:
    return (
        t["predictions"]
        .groupBy("zone_id")
        .agg(
            F.avg("predicted_high_demand_probability").alias("avg_predicted_probability"),
            F.avg("workload_risk_score").alias("avg_workload_risk_score"),
        )
        .orderBy(F.desc("avg_predicted_probability"), "zone_id")
        .limit(TOP)
    )


@report
def cluster_profile_summary(t: Tables) -> DataFrame:
    return (
        t["profiles"]
        .groupBy("cluster_id", "cluster_name")
        .agg(
            F.count(F.lit(1)).alias("zone_count"),
            F.avg("avg_hourly_demand").alias("avg_hourly_demand"),
            F.avg("after_hours_share").alias("after_hours_share"),
        )
        .orderBy(F.desc("avg_hourly_demand"), "cluster_id")
    )


@report
def data_quality_summary(t: Tables) -> DataFrame:
    return _count(t["fact"], "data_quality_flag", name="row_count").orderBy(F.desc("row_count"), "data_quality_flag")


@report
def zone_hour_weather_summary(t: Tables) -> DataFrame:
    from zoneflow.operators.marts import zone_weather_summary

    return zone_weather_summary(t["zone_hour"])


def export(tables: Tables, folder: str, names: Iterable[str] | None = None) -> DataFrame:
    """Write each named report as CSV and list its row count, or its error instead of stopping.

    Rows are counted while they are written.
    """
    spark = next(iter(tables.values())).sparkSession
    results = []
    for name in REPORTS if names is None else names:
        seen = Observation(name)
        try:
            rows = REPORTS[name](tables).observe(seen, F.count(F.lit(1)).alias("rows"))
            rows.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")
            results.append((name, int(seen.get["rows"]), None))
        except Exception as error:  # a failing report must not stop the others
            results.append((name, None, f"{type(error).__name__}: {error}"))
    return spark.createDataFrame(results, "name string, rows long, error string")
