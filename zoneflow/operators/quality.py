"""Data-quality metrics as one long metric, value, detail table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.numeric import percent
from zoneflow.functions.time import iso_text
from zoneflow.operators.marts import metric_row

# Checked columns with the wording of their metric.
CHECKED = {
    "zone_id": "Zone/beat coverage",
    "normalized_service_category": "Service category coverage",
    "temperature_2m": "Weather join coverage",
    "latitude": "Latitude availability",
    "longitude": "Longitude availability",
}
COUNTED = ["zone_id", "normalized_service_category"]


def _share(part: Column, whole: Column) -> Column:
    return percent(F.when(whole > 0, part / whole))


def metrics(fact: DataFrame, zone_hour: DataFrame | None = None, sample_mode: bool = False) -> DataFrame:
    """Row counts, duplicate ids, date bounds, missing shares and distinct counts.

    The fact table is first combined per zone and category, with the missing
    count of every column; all figures come from that small table.  Surplus
    copies of an id are the only figure that needs a grouping on the id.
    """
    present = [c for c in COUNTED if c in fact.columns]
    by_cell = fact.groupBy(*present).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min("event_datetime").alias("_first"),
        F.max("event_datetime").alias("_last"),
        *[F.count(c).alias(f"_n_{c}") for c in fact.columns if c not in present],
    )
    known = {c: F.when(F.col(c).isNotNull(), F.col("_rows")).otherwise(0) for c in present}
    total = by_cell.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.min("_first").alias("first"),
        F.max("_last").alias("last"),
        *[F.count_distinct(c).alias(f"distinct_{c}") for c in present],
        *[F.coalesce(F.sum(known.get(c, F.col(f"_n_{c}"))), F.lit(0)).alias(f"_n_{c}") for c in fact.columns],
    )
    per_id = fact.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    surplus = per_id.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).scalar()
    total = total.withColumn("surplus", surplus)

    rows = F.col("rows")
    missing = {c: _share(rows - F.col(f"_n_{c}"), rows) for c in fact.columns}
    entries = [
        metric_row("sample_mode", F.lit(str(sample_mode)), "Pipeline run mode"),
        metric_row("fact_rows", rows, "Rows in fact_service_events"),
        metric_row("duplicate_event_ids", F.col("surplus"), "Duplicate event identifiers after cleaning"),
        metric_row("date_start", iso_text("first"), "Earliest parsed service-event timestamp"),
        metric_row("date_end", iso_text("last"), "Latest parsed service-event timestamp"),
        metric_row("missing_event_datetime_pct", missing["event_datetime"], "Missing or unparsed event timestamps"),
    ]
    for c, detail in CHECKED.items():
        if c in fact.columns:
            entries.append(metric_row(f"missing_{c}_pct", missing[c], detail))
        if c in present:
            entries.append(metric_row(f"distinct_{c}", F.col(f"distinct_{c}"), detail))
    if zone_hour is not None:
        hours = zone_hour.agg(
            F.struct(F.count(F.lit(1)).alias("n"), F.avg("high_demand_flag").alias("rate")).alias("z")
        ).scalar()
        total = total.withColumn("_z", hours)
        entries += [
            metric_row("zone_hour_rows", F.col("_z.n"), "Rows in zone-hour feature table"),
            metric_row(
                "high_demand_rate_pct", percent("_z.rate"),
                "Share of observed zone-hours above zone-specific threshold",
            ),
        ]
    columns = [
        F.when(rows > F.col(f"_n_{c}"), metric_row(f"column_missingness:{c}", missing[c], "Column-level missingness"))
        for c in fact.columns
    ]
    listed = F.filter(F.array(*entries, *columns), lambda e: e.isNotNull())
    return total.select(F.inline(listed))


def missing_ratios(fact: DataFrame) -> DataFrame:
    """Weather coverage and missing coordinates as ratios of all rows, in one row."""
    return fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.avg(F.col("temperature_2m").isNotNull().cast("double")).alias("weather_join_coverage"),
        F.avg(F.col("latitude").isNull().cast("double")).alias("missing_latitude_pct"),
        F.avg(F.col("longitude").isNull().cast("double")).alias("missing_longitude_pct"),
    )
