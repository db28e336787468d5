"""The whole flow: raw files to cleaned events, fact, zone-hours, marts and reports.

Every stage writes its table and the next one reads it back.  No stage is
computed twice, and a failed run resumes from the last written table.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.operators import audit, cleaning, collapse, enrich, forecast, marts, planner, quality, segments, zonehour
from zoneflow.plans import reports
from zoneflow.sources import readers, writers


@dataclass(frozen=True)
class Sources:
    events: str
    weather: str
    zones: str
    polygons: str | None = None


def prepare_events(spark: SparkSession, sources: Sources, out: str) -> tuple[DataFrame, DataFrame]:
    """Write the duplicate audit and the collapsed events; return both."""
    raw = readers.read_events(spark, sources.events, position=True)
    place = ("source_file", "source_row")
    copies = audit.canonical_copies(
        readers.read_events(spark, sources.events, missing=False), keep=()
    )
    audited = writers.write_table(audit.groups(copies), f"{out}/duplicate_audit")
    cleaned = cleaning.clean_events(raw, keep=place)
    events = collapse.collapse_events(cleaned, place, audited)
    return audited, writers.write_table(events.drop(*place), f"{out}/cleaned_events")


def run(spark: SparkSession, sources: Sources, out: str, run_tag: str) -> dict[str, DataFrame]:
    """Run every stage; the returned tables are read from the written files."""
    started = time.time()
    audited, events = prepare_events(spark, sources, out)
    weather = writers.write_table(readers.read_weather(spark, sources.weather), f"{out}/weather")
    zones = readers.read_zone_lookup(spark, sources.zones)

    fact = writers.write_table(enrich.build_fact(events, weather, zones), f"{out}/fact", partition_by=["year"])
    fact = fact.select(*enrich.FACT_COLUMNS)
    hours = writers.write_table(zonehour.build(fact), f"{out}/zone_hour", sort_by=["zone_id", "date_hour"])

    rows = marts.mart_input(hours)
    measures = writers.write_table(marts.zone_measures(fact, hours), f"{out}/zone_measures")
    risk = writers.write_table(marts.add_risk_score(measures), f"{out}/zone_risk")
    features = writers.write_table(segments.zone_features(hours), f"{out}/zone_features")
    segmented = writers.write_table(segments.quintiles(features), f"{out}/zone_segments")
    profiles = writers.write_table(segments.profiles(segmented), f"{out}/cluster_profiles")
    predictions = writers.write_table(forecast.baseline_table(hours), f"{out}/model_predictions")
    categories = marts.category_share(fact)
    small = {
        "zone_summary": marts.zone_summary(rows),
        "zone_summary_by_period": marts.zone_summary(rows, marts.PERIOD),
        "hourly_demand": marts.hourly_demand(rows),
        "day_of_week_demand": marts.daily_demand(rows),
        "day_hour_heatmap": marts.heatmap(rows),
        "weather_context_summary": marts.weather_context(rows),
        "service_category_mix": marts.category_mix(fact),
        "category_summary": categories,
        "workload_risk_scores": marts.rank_zones(risk),
        "scenario_plan": planner.plan(risk),
        "recommendations": planner.recommendations(risk, categories),
        "executive_kpis": marts.executive_kpis(fact, risk),
        "data_quality": quality.metrics(fact, hours),
        "audit_reasons": audit.reason_counts(audited),
        "audit_verdict": audit.verdict(audited),
    }
    for name, mart in small.items():
        writers.write_csv(mart, f"{out}/marts/{name}", single_file=True)
    polygons = 0 if sources.polygons is None else readers.read_geojson(spark, sources.polygons).count()
    writers.write_record(marts.dashboard_kpis(rows, events, fact, polygons), f"{out}/marts/dashboard_kpis")

    tables = {
        "fact": fact, "zone_hour": hours, "predictions": predictions, "profiles": profiles, "events": events,
        "audit": audited, "risk": risk,
    }
    exported = reports.export(tables, f"{out}/reports")
    figures = enrich.coverage(fact).first().asDict()
    figures |= enrich.lineage(events, fact).first().asDict()
    figures |= hours.agg(
        F.count(F.lit(1)).alias("zone_hour_rows"), F.count_distinct("zone_id").alias("zones")
    ).first().asDict()
    figures["elapsed_seconds"] = round(time.time() - started, 1)
    writers.record_run(spark, f"{out}/run_metadata", run_tag, figures)
    writers.publish({**small, "cluster_profiles": profiles, "model_predictions": predictions, "zone_summary": risk})
    return {**tables, **small, "reports": exported}
