"""Query catalogue: every operator of the library run on the given tables.

Each entry takes a session and a folder of tables and returns a DataFrame.
Measures whose last digits depend on summation order are rounded to six places;
dates are shown as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions import text as tx
from zoneflow.functions import time as tm
from zoneflow.operators import (
    audit, cleaning, collapse, enrich, forecast, geo, marts, partials, planner, quality, ranking, sampling, schema,
    segments, stats, zonehour,
)
from zoneflow.operators.sizing import cut_lineage
from zoneflow.plans import reports
from zoneflow.sources import builds, changelog, given, readers, writers
from zoneflow.streaming import rollups

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BATCHES = 12
SLICES = 4
QUANTILES = {"p50": 0.5, "p75": 0.75, "p95": 0.95}
VIEW_START, VIEW_END = "1997-11", "1996-03"  # reversed on purpose: the bounds are swapped


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def tidy(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column and show dates as text."""
    columns = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DoubleType):
            columns[field.name] = F.round(field.name, places)
        elif isinstance(field.dataType, T.DateType):
            columns[field.name] = F.col(field.name).cast("string")
    return df.withColumns(columns) if columns else df


def written_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Zone-hour table written once, for queries that read it several times."""
    return cut_lineage(given.zone_hour(spark, folder))


# --- calendar and enrichment ----------------------------------------------


@query
def calendar_features(spark: SparkSession, folder: str) -> DataFrame:
    """Hour key, calendar parts, season and time flags of every event."""
    events = tm.add_calendar(given.cleaned_events(spark, folder))
    return tidy(
        events.select(
            "event_id", "weather_hour", "event_date", "event_hour", "weekday", "weekday_name", "month", "month_name",
            "quarter", "year", "season", "is_weekend", "is_holiday", "is_business_hour", "is_after_hours",
        )
    )


@query
def holiday_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per day with the holiday flag and season, over several years."""
    events = tm.add_calendar(given.order_events(spark, folder))
    return tidy(
        events.groupBy("event_date", "is_holiday", "season").agg(F.count(F.lit(1)).alias("events"))
    )


@query
def enrich_fact(spark: SparkSession, folder: str) -> DataFrame:
    """The 35-column fact table."""
    return tidy(given.fact(spark, folder))


@query
def weather_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(enrich.coverage(given.fact(spark, folder)))


@query
def lineage_check(spark: SparkSession, folder: str) -> DataFrame:
    """Nothing lost, added or doubled between cleaned events and fact table."""
    return tidy(enrich.lineage(given.cleaned_events(spark, folder), given.fact(spark, folder)))


# --- zone-hour features ---------------------------------------------------


@query
def zone_hour_demand(spark: SparkSession, folder: str) -> DataFrame:
    rolled = zonehour.rollup(given.fact(spark, folder))
    return tidy(rolled.select("zone_id", "date_hour", "target_demand_count", *zonehour.MEANS, "weather_code"))


@query
def category_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Share of the largest and of the three largest categories per zone-hour."""
    rolled = zonehour.rollup(given.fact(spark, folder))
    return tidy(rolled.select("zone_id", "date_hour", "category_mix_top_1_share", "category_mix_top_3_share"))


@query
def lag_features(spark: SparkSession, folder: str) -> DataFrame:
    built = given.zone_hour(spark, folder)
    return built.select("zone_id", "date_hour", "target_demand_count", *zonehour.LAG_NAMES.values())


@query
def rolling_mean(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(given.zone_hour(spark, folder).select("zone_id", "date_hour", "rolling_7_day_avg"))


def _high_demand(spark: SparkSession, folder: str, exact: bool) -> DataFrame:
    rolled = zonehour.rollup(given.fact(spark, folder))
    flagged = zonehour.add_high_demand(rolled, exact=exact)
    return tidy(flagged.select("zone_id", "date_hour", "zone_high_threshold", "high_demand_flag"))


@query
def high_demand_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Hours above the zone's interpolated 75% quantile."""
    return _high_demand(spark, folder, True)


@query
def high_demand_approx(spark: SparkSession, folder: str) -> DataFrame:
    """Hours above the zone's discrete 75% quantile."""
    return _high_demand(spark, folder, False)


@query
def time_history(spark: SparkSession, folder: str) -> DataFrame:
    """Lags and rolling mean by hours, as on the dense table, for the observed hours only."""
    built = given.zone_hour(spark, folder, by_time=True)
    return tidy(
        built.select(
            "zone_id", "date_hour", "target_demand_count", "lag_1_hour_demand", "lag_24_hour_demand",
            "prior_week_same_hour_demand", "rolling_7_day_avg",
        )
    )


@query
def dense_zone_hour(spark: SparkSession, folder: str) -> DataFrame:
    """Zone-hour table with every hour present, so lags are hours."""
    built = given.zone_hour(spark, folder, dense=True)
    return tidy(
        built.select(
            "zone_id", "date_hour", "hour", "weekday", "is_weekend", "is_holiday", "target_demand_count",
            "lag_1_hour_demand", "lag_24_hour_demand", "prior_week_same_hour_demand", "rolling_7_day_avg",
            "high_demand_flag",
        )
    )


@query
def zone_hour_features(spark: SparkSession, folder: str) -> DataFrame:
    """The full zone-hour feature table."""
    return tidy(given.zone_hour(spark, folder))


# --- named reports --------------------------------------------------------

# report -> table it reads: the events of one month or the orders of several years
REPORT_TABLES = {
    "q01": ("demand_by_hour_weekday", "fact"),
    "q02": ("demand_by_month", "order_fact"),
    "q03": ("demand_by_zone", "fact"),
    "q04": ("demand_by_service_category", "order_fact"),
    "q05": ("top_demand_zones", "fact"),
    "q06": ("peak_demand_windows", "fact"),
    "q07": ("weekend_vs_weekday_demand", "fact"),
    "q08": ("business_vs_after_hours_demand", "fact"),
    "q09": ("weather_and_demand_relationship", "fact"),
    "q10": ("zone_category_concentration", "fact"),
    "q11": ("demand_volatility_by_zone", "zone_hour"),
    "q12": ("monthly_trend", "order_fact"),
    "q13": ("workload_risk_score_by_zone", "zone_hour"),
    "q14": ("top_forecasted_high_demand_zones", "predictions"),
    "q15": ("cluster_profile_summary", "profiles"),
    "q16": ("data_quality_summary", "fact"),
    "q17": ("zone_hour_weather_summary", "zone_hour"),
}


def _report_input(spark: SparkSession, folder: str, table: str) -> dict[str, DataFrame]:
    if table == "order_fact":
        return {"fact": given.order_fact(spark, folder)}
    if table == "predictions":
        return {table: forecast.baseline_table(written_hours(spark, folder))}
    if table == "profiles":
        return {table: _quintile_profiles(spark, folder)}
    return {table: getattr(given, table)(spark, folder)}


def _report_query(name: str, table: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return tidy(reports.REPORTS[name](_report_input(spark, folder, table)))

    return run


for _number, (_name, _table) in REPORT_TABLES.items():
    QUERIES[f"{_number}_{_name}"] = _report_query(_name, _table)


# --- dimensions and marts -------------------------------------------------


def _dimension_query(name: str) -> Query:
    return lambda spark, folder: tidy(marts.dimensions(given.fact(spark, folder))[name])


for _name in ("dim_date", "dim_location", "dim_service_category", "dim_weather_hour"):
    QUERIES[_name] = _dimension_query(_name)


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    return marts.mart_input(given.zone_hour(spark, folder))


def _long_rows(spark: SparkSession, folder: str) -> DataFrame:
    return marts.mart_input(given.order_zone_hour(spark, folder))


@query
def zone_summary(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(marts.zone_summary(_rows(spark, folder)))


@query
def zone_summary_by_period(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(marts.zone_summary(_long_rows(spark, folder), marts.PERIOD))


@query
def hourly_demand(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(marts.hourly_demand(_rows(spark, folder)))


@query
def daily_demand(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(marts.daily_demand(_long_rows(spark, folder)))


@query
def demand_heatmap(spark: SparkSession, folder: str) -> DataFrame:
    return marts.heatmap(_rows(spark, folder))


@query
def weather_context(spark: SparkSession, folder: str) -> DataFrame:
    """Demand per precipitation band and per temperature band."""
    return tidy(marts.weather_context(_rows(spark, folder)))


@query
def category_mix_mart(spark: SparkSession, folder: str) -> DataFrame:
    return marts.category_mix(given.order_fact(spark, folder))


@query
def category_share(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(marts.category_share(given.fact(spark, folder)))


@query
def peak_hours(spark: SparkSession, folder: str) -> DataFrame:
    return marts.peak_hours(_rows(spark, folder))


@query
def weekday_hour_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return marts.pivot_hours(given.fact(spark, folder), "weekday_name", hour="event_hour")


@query
def top_zone_heatmap(spark: SparkSession, folder: str) -> DataFrame:
    return marts.top_zone_heatmap(marts.mart_input(written_hours(spark, folder)), n=5)


@query
def filtered_view(spark: SparkSession, folder: str) -> DataFrame:
    """Zone summary of a range of months."""
    return tidy(marts.view(_long_rows(spark, folder), VIEW_START, VIEW_END))


def _sliced_mart(spark: SparkSession, rows: DataFrame) -> partials.CellMart:
    """Mart of cells from a slice for every fourth year; one slice first comes with half its hours, then again."""
    mart = partials.CellMart(spark, rollups.run_folder(spark, "cells"))
    own = F.col("year") % SLICES
    mart.write_slice(rows.where((own == 1) & (F.col("hour") < 12)), "1")
    for number in range(SLICES):
        mart.write_slice(rows.where(own == number), str(number))
    return mart


@query
def incremental_mart(spark: SparkSession, folder: str) -> DataFrame:
    """Zone summary by period from slices, one of which was replaced."""
    return tidy(_sliced_mart(spark, cut_lineage(_long_rows(spark, folder))).summary(marts.PERIOD))


@query
def incremental_view(spark: SparkSession, folder: str) -> DataFrame:
    """Weekend summary of a range of months, from cells alone."""
    mart = _sliced_mart(spark, cut_lineage(_long_rows(spark, folder)))
    return tidy(mart.summary(start=VIEW_START, end=VIEW_END, day_type=marts.WEEKEND))


@query
def sketch_view(spark: SparkSession, folder: str) -> DataFrame:
    """Quantiles of hourly demand and active days of a range of months from merged sketches, held against the rows.

    A quantile is within bounds if at most its share of the rows, and two percent, is smaller, and at least its share
    less two percent is not larger; active days are if they differ by at most five percent.
    """
    rows = cut_lineage(_long_rows(spark, folder))
    found = _sliced_mart(spark, rows).distribution(start=VIEW_START, end=VIEW_END)
    chosen = marts.in_periods(rows, VIEW_START, VIEW_END).select("zone_id", "demand_count", "date")
    shares = chosen.join(found, "zone_id").groupBy("zone_id", "zone_hours", "active_days").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("date").alias("days"),
        *[F.avg((F.col("demand_count") < F.col(q)).cast("int")).alias(f"{q}_below") for q in QUANTILES],
        *[F.avg((F.col("demand_count") <= F.col(q)).cast("int")).alias(f"{q}_upto") for q in QUANTILES],
    )
    within = [
        ((F.col(f"{q}_below") <= share + 0.02) & (F.col(f"{q}_upto") >= share - 0.02)).alias(f"{q}_within")
        for q, share in QUANTILES.items()
    ]
    days = F.abs(F.col("active_days") - F.col("days")) <= 0.05 * F.col("days")
    return shares.select("zone_id", "zone_hours", *within, days.alias("days_within"))


@query
def weekend_view(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(marts.view(_long_rows(spark, folder), VIEW_START, VIEW_END, marts.WEEKEND))


@query
def view_kpis(spark: SparkSession, folder: str) -> DataFrame:
    rows = marts.in_periods(_long_rows(spark, folder), VIEW_START, VIEW_END)
    return marts.view_kpis(marts.of_day_type(rows, marts.WEEKDAY))


@query
def hourly_rhythm(spark: SparkSession, folder: str) -> DataFrame:
    return marts.hourly_rhythm(_rows(spark, folder))


@query
def rhythm_peak(spark: SparkSession, folder: str) -> DataFrame:
    return marts.peak_of_rhythm(_rows(spark, folder))


@query
def weekly_pattern(spark: SparkSession, folder: str) -> DataFrame:
    return marts.weekly_pattern(_rows(spark, folder))


@query
def weather_band_totals(spark: SparkSession, folder: str) -> DataFrame:
    return marts.weather_bands(marts.weather_context(_rows(spark, folder)), marts.TEMPERATURE_VIEW)


@query
def top_categories(spark: SparkSession, folder: str) -> DataFrame:
    return marts.top_categories(marts.category_mix(given.order_fact(spark, folder)))


# --- zone profile, risk, plan ---------------------------------------------


@query
def zone_profile(spark: SparkSession, folder: str) -> DataFrame:
    return marts.zone_profile(given.fact(spark, folder))


@query
def zone_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(marts.zone_statistics(given.zone_hour(spark, folder)))


def _risk(spark: SparkSession, folder: str) -> DataFrame:
    """Zone risk table, written once like every table that several steps read."""
    fact = given.fact(spark, folder)
    return marts.add_risk_score(cut_lineage(marts.zone_measures(fact, zonehour.build(fact))))


@query
def risk_score(spark: SparkSession, folder: str) -> DataFrame:
    """Zones with their workload risk score and rank."""
    ranked = marts.rank_zones(_risk(spark, folder))
    return tidy(
        ranked.select(
            "zone_id", "workload_risk_score", "total_events", "avg_hourly_demand", "after_hours_share",
            "weekend_share", "high_demand_rate", "rank",
        )
    )


@query
def scenario_plan(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(planner.plan(_risk(spark, folder)))


@query
def recommendations(spark: SparkSession, folder: str) -> DataFrame:
    return planner.recommendations(_risk(spark, folder), marts.category_share(given.fact(spark, folder)))


@query
def executive_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return marts.executive_kpis(given.fact(spark, folder), _risk(spark, folder))


@query
def dashboard_kpis(spark: SparkSession, folder: str) -> DataFrame:
    cleaned, fact = given.order_events(spark, folder), given.order_fact(spark, folder)
    kpis = marts.dashboard_kpis(marts.mart_input(zonehour.build(fact)), cleaned, fact, given.zone_polygons(spark, folder).where("zone_id <> 'Z99'").count())
    return tidy(kpis.withColumn("periods", F.array_join("periods", ",")))


# --- cleaning, collapse, audit, quality -----------------------------------


@query
def clean_events(spark: SparkSession, folder: str) -> DataFrame:
    """Messy raw records resolved, parsed and normalized."""
    return tidy(cleaning.clean_events(given.raw_records(spark, folder)))


@query
def record_completeness(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = given.cleaned_events(spark, folder)
    return cleaned.groupBy(cleaning.completeness_score().alias("record_completeness_score")).agg(
        F.count(F.lit(1)).alias("events")
    )


@query
def collapse_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Latest order line per key with the number of copies."""
    order = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity"]
    lines = given.keyed_lines(spark, folder).select("l_orderkey", "l_linenumber", *order)
    best = collapse.collapse(lines, ["l_orderkey", "l_linenumber"], order)
    return best.select("l_orderkey", "l_linenumber", *order, "duplicate_count")


@query
def first_per_key(spark: SparkSession, folder: str) -> DataFrame:
    order = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity"]
    lines = given.keyed_lines(spark, folder).select("l_orderkey", "l_linenumber", *order)
    first = collapse.keep_first(lines, ["l_orderkey", "l_linenumber"], order)
    return first.select("l_orderkey", "l_linenumber", *order)


@query
def collapse_events(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned copies collapsed to unique ids with their audited duplicate history."""
    copies = given.copied_events(spark, folder)
    cleaned = cleaning.clean_events(copies.withColumn("event_datetime", F.col("event_datetime").cast("string")), keep=("source_row_number",))
    audited = audit.groups(audit.canonical_copies(copies, keep=("source_row_number",)))
    out = collapse.collapse_events(cleaned, ["source_row_number"], audited)
    return out.select(
        "event_id", "event_datetime", "zone_id", "normalized_service_category", "disposition", "source_row_number",
        "record_completeness_score", "duplicate_count", "duplicate_reason", "has_duplicate_history",
        "duplicate_collapse_rule",
    )


def _copies(spark: SparkSession, folder: str) -> DataFrame:
    return audit.canonical_copies(given.copied_events(spark, folder), keep=("source_row_number",))


@query
def duplicate_audit(spark: SparkSession, folder: str) -> DataFrame:
    """One row per duplicated id: what differs between its copies and why."""
    return audit.groups(_copies(spark, folder))


@query
def audit_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return audit.reason_counts(audit.groups(_copies(spark, folder)))


@query
def audit_flags(spark: SparkSession, folder: str) -> DataFrame:
    return audit.flag_counts(audit.groups(_copies(spark, folder)))


@query
def audit_verdict(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(audit.verdict(audit.groups(_copies(spark, folder))))


@query
def audit_largest(spark: SparkSession, folder: str) -> DataFrame:
    return audit.largest_groups(audit.groups(_copies(spark, folder))).select(
        "event_id", "duplicate_group_size", "duplicate_reason"
    )


@query
def audit_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Every copy in the largest groups overall and per reason."""
    copies = cut_lineage(_copies(spark, folder))
    return audit.samples(copies, cut_lineage(audit.groups(copies))).select(
        "event_id", "source_row_number", "queued_datetime", "zone_id", "normalized_service_category", "disposition",
        "duplicate_group_size", "duplicate_reason",
    )


@query
def quality_metrics(spark: SparkSession, folder: str) -> DataFrame:
    fact = cut_lineage(given.fact(spark, folder))
    return quality.metrics(fact, cut_lineage(zonehour.build(fact)))


@query
def missing_ratios(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(quality.missing_ratios(given.fact(spark, folder)))


@query
def row_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Stable keys of events: SHA-256 of their fields."""
    e = given.service_events(spark, folder)
    return e.select("event_id", tx.sha_key("event_id", "beat", "final_call_type").alias("fallback_key"))


@query
def upsert_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Altered copies merged into the service events by id."""
    copies = given.copied_events(spark, folder)
    current, new = (copies.filter(F.col("source_row_number") == n) for n in (1, 2))
    merged = collapse.upsert(current, new, ["event_id"], ["event_datetime"])
    return merged.select("event_id", "event_datetime", "beat", "final_call_type", "disposition", "source_row_number")


# --- segments -------------------------------------------------------------


@query
def zone_cluster_features(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(segments.zone_features(given.order_zone_hour(spark, folder)))


@query
def zone_feature_vector(spark: SparkSession, folder: str) -> DataFrame:
    """Nine segmentation features of the event zones."""
    return tidy(segments.zone_features(given.zone_hour(spark, folder)))


def _quintile_profiles(spark: SparkSession, folder: str) -> DataFrame:
    features = cut_lineage(segments.zone_features(given.zone_hour(spark, folder)))
    return segments.profiles(cut_lineage(segments.quintiles(features)))


@query
def quintile_segments(spark: SparkSession, folder: str) -> DataFrame:
    segmented = segments.quintiles(cut_lineage(segments.zone_features(given.zone_hour(spark, folder))))
    return tidy(segmented.select("zone_id", "cluster_id", "avg_hourly_demand"))


@query
def cluster_names(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(_quintile_profiles(spark, folder).select("zone_id", "cluster_id", "cluster_name"))


@query
def cluster_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(segments.cluster_rollup(_quintile_profiles(spark, folder)))


@query
def kmeans_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Zones clustered on their features, with principal components and cluster names."""
    _, segmented = segments.fit_clusters(segments.zone_features(given.zone_hour(spark, folder)))
    return tidy(segments.profiles(cut_lineage(segmented)))


# --- forecast -------------------------------------------------------------


@query
def model_frame(spark: SparkSession, folder: str) -> DataFrame:
    """Model input with its part of the temporal split."""
    frame = forecast.model_frame(written_hours(spark, folder))
    train, test = forecast.split(frame)
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("date_hour_epoch").alias("first_epoch"),
        F.max("date_hour_epoch").alias("last_epoch"),
        F.sum(forecast.LABEL).alias("high_demand_rows"),
    )


@query
def baseline_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(forecast.baseline_table(written_hours(spark, folder)))


@query
def baseline_metrics(spark: SparkSession, folder: str) -> DataFrame:
    predicted = forecast.baseline_table(written_hours(spark, folder))
    return tidy(forecast.metrics(predicted, "baseline_prediction", "baseline"))


@query
def baseline_auc(spark: SparkSession, folder: str) -> DataFrame:
    predicted = forecast.baseline_table(written_hours(spark, folder))
    return tidy(forecast.auc(predicted, "baseline_probability"))


@query
def baseline_report(spark: SparkSession, folder: str) -> DataFrame:
    """Per-class report of the baseline."""
    predicted = forecast.baseline_table(written_hours(spark, folder))
    return tidy(forecast.class_report(predicted, "baseline_prediction"))


@query
def highest_risk_hours(spark: SparkSession, folder: str) -> DataFrame:
    predicted = forecast.baseline_table(written_hours(spark, folder))
    return tidy(forecast.highest_risk(predicted))


@query
def forest_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Random-forest predictions for the later zone-hours, trained on all earlier ones."""
    _, predicted = forecast.fit_and_predict(forecast.forest_pipeline(), given.zone_hour(spark, folder))
    return tidy(predicted)


@query
def mlp_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Neural-network predictions for the later zone-hours."""
    _, predicted = forecast.fit_and_predict(forecast.mlp_pipeline(), given.zone_hour(spark, folder))
    return tidy(predicted)


@query
def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Baseline and forest side by side on the later zone-hours."""
    _, predicted = forecast.fit_and_predict(forecast.forest_pipeline(trees=20, depth=8), given.zone_hour(spark, folder))
    return tidy(forecast.compare(predicted))


def _sound(predicted: DataFrame) -> DataFrame:
    """Test rows with the label and the baseline, and whether what the model adds is in order."""
    p = F.col("predicted_high_demand_probability")
    return predicted.select(
        "zone_id", "date_hour", forecast.LABEL, "baseline_prediction",
        F.round("baseline_probability", 6).alias("baseline_probability"),
        p.between(0, 1).alias("is_probability"),
        ((p > 0.5) == (F.col("ml_prediction") == 1)).alias("flag_follows"),
        (F.abs(F.col("workload_risk_score") - p * 100) <= 0.0500001).alias("risk_follows"),
    )


@query
def forest_checked(spark: SparkSession, folder: str) -> DataFrame:
    """Forest predictions: rows, labels and baseline as they are, flag and risk held against the probability."""
    small = forecast.forest_pipeline(trees=21, depth=8)
    return _sound(forecast.fit_and_predict(small, given.zone_hour(spark, folder))[1])


@query
def network_checked(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of a network with early stopping, checked in the same way."""
    return _sound(forecast.network_and_predict(given.zone_hour(spark, folder))[2])


@query
def network_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Training steps of the network in one row: rows fitted and held back, and whether the best weights were kept."""
    steps = forecast.network_and_predict(given.zone_hour(spark, folder))[1]
    last, best = F.max("step"), F.max(F.when(F.col("kept"), F.col("step")))
    full = forecast.Stopping()
    return steps.agg(
        F.max("fit_rows").alias("fit_rows"), F.max("validation_rows").alias("validation_rows"),
        F.count_if("kept").alias("kept_steps"), F.max("validation_loss").between(0, 10).alias("losses_finite"),
        (F.max(F.when(F.col("kept"), F.col("validation_loss"))) <= F.min("validation_loss") + full.tolerance).alias("best_kept"),
        ((last - best == full.patience) | (last * full.step >= full.most)).alias("stopped_by_rule"),
    )


@query
def kmeans_checked(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters held against the quintiles: zones, clusters, zones nearer to another centre, and whether the cost is lower."""
    features = cut_lineage(segments.zone_features(given.zone_hour(spark, folder)))
    _, segmented = segments.fit_clusters(features)
    return segments.clustering_check(cut_lineage(segmented), cut_lineage(segments.quintiles(features)))


# --- statistics -----------------------------------------------------------


@query
def wilcoxon(spark: SparkSession, folder: str) -> DataFrame:
    """Rank-sum test of hourly demand, weekdays against weekends."""
    tested = stats.rank_sum(written_hours(spark, folder), "target_demand_count", "is_weekend")
    return tidy(tested)


@query
def kruskal(spark: SparkSession, folder: str) -> DataFrame:
    """Kruskal-Wallis test of hourly demand across zones."""
    return tidy(stats.kruskal(written_hours(spark, folder), "target_demand_count", "zone_id"))


def _clustered_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Zone-hours with the cluster name of their zone."""
    names = _quintile_profiles(spark, folder).select("zone_id", "cluster_name")
    return cut_lineage(given.zone_hour(spark, folder).join(names, "zone_id"))


@query
def kruskal_by_cluster(spark: SparkSession, folder: str) -> DataFrame:
    """Kruskal-Wallis test of hourly demand across cluster names."""
    return tidy(stats.kruskal(_clustered_hours(spark, folder), "target_demand_count", "cluster_name"))


@query
def group_ci_by_cluster(spark: SparkSession, folder: str) -> DataFrame:
    """Mean hourly demand per cluster name with its 95% interval."""
    return tidy(stats.group_intervals(_clustered_hours(spark, folder), "target_demand_count", "cluster_name"))


@query
def group_ci(spark: SparkSession, folder: str) -> DataFrame:
    """Mean hourly demand per zone with its 95% interval."""
    return tidy(stats.group_intervals(given.zone_hour(spark, folder), "target_demand_count", "zone_id"))


@query
def ols(spark: SparkSession, folder: str) -> DataFrame:
    """Regression of hourly demand on weather and calendar."""
    return tidy(stats.ols(written_hours(spark, folder)))


@query
def ols_single(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(stats.ols_single(given.zone_hour(spark, folder), "target_demand_count", "temperature_2m"))


@query
def demand_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Zone-hours numbered by demand over the whole table."""
    rolled = cut_lineage(
        zonehour.rollup(given.fact(spark, folder)).select("zone_id", "date_hour", "target_demand_count")
    )
    return ranking.row_numbers(rolled, "target_demand_count", ["zone_id", "date_hour"], "rank")


@query
def event_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Events numbered by disposition, whose missing values come first."""
    events = given.service_events(spark, folder).select("event_id", F.col("disposition").cast("double").alias("measure"))
    return ranking.row_numbers(events, "measure", ["event_id"], "rank")


# --- geography ------------------------------------------------------------


@query
def polygon_centroid(spark: SparkSession, folder: str) -> DataFrame:
    """Area and centroid of one polygon per customer, holes and multi-part shapes included."""
    return tidy(geo.centroids(given.customer_polygons(spark, folder)))


@query
def polygon_vertices(spark: SparkSession, folder: str) -> DataFrame:
    """Outer-ring vertices of the customer polygons."""
    return tidy(geo.vertices(given.customer_polygons(spark, folder)))


@query
def polygon_wkt(spark: SparkSession, folder: str) -> DataFrame:
    return geo.wkt(given.customer_polygons(spark, folder))


@query
def choropleth(spark: SparkSession, folder: str) -> DataFrame:
    """Zone polygons with demand, rank, intensity and colour."""
    summary = cut_lineage(marts.zone_summary(_rows(spark, folder)))
    coloured = geo.choropleth(given.zone_polygons(spark, folder), summary)
    return tidy(coloured.withColumns({c: F.col(c).cast("double") for c in ("peak_hour", "rank")}))


@query
def map_coverage(spark: SparkSession, folder: str) -> DataFrame:
    summary = cut_lineage(marts.zone_summary(_rows(spark, folder)))
    coloured = geo.choropleth(given.zone_polygons(spark, folder), summary)
    return geo.map_coverage(coloured, summary)


@query
def points_in_degrees(spark: SparkSession, folder: str) -> DataFrame:
    """Points on the projected grid, one per order, turned into degrees; those that are degrees stay."""
    orders = given.table(spark, folder, "orders")
    key, feet = F.col("o_orderkey"), F.col("o_orderkey") % 4 != 0
    points = orders.select(
        key.alias("key"),
        F.when(feet, 1_200_000 + key % 9_973 * 31).otherwise(-122 - key % 7 / 10).cast("double").alias("x"),
        F.when(feet, 100_000 + F.col("o_custkey") % 9_967 * 29).otherwise(47 + key % 9 / 10).cast("double").alias("y"),
    )
    return tidy(geo.reproject(points))


@query
def mapped_zones(spark: SparkSession, folder: str) -> DataFrame:
    """Zones with the centre and the text of their polygon; some have none."""
    shapes = given.customer_polygons(spark, folder).where("type = 'Polygon'")
    nations = given.table(spark, folder, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("zone_id"), F.col("c_nationkey").alias("nation")
    )
    mapped = geo.map_zones(nations, shapes)
    return tidy(mapped.select("zone_id", "nation", "area", "centroid_longitude", "centroid_latitude", "geometry_wkt"))


# --- streaming ------------------------------------------------------------


@query
def stream_zone_hour(spark: SparkSession, folder: str) -> DataFrame:
    """Events counted per zone and hour as a stream, the last hours included."""
    counts = rollups.zone_hour_counts(given.event_stream(spark, folder))
    run, cell = rollups.run_folder(spark, "zone-hour"), ["zone_id", "date_hour"]
    log = rollups.drain_upserts(counts, run, cell, ["demand_count"], mode="update")
    return log.read().select(*cell, "demand_count")


@query
def stream_late_events(spark: SparkSession, folder: str) -> DataFrame:
    """Hours counted until they close, from files out of order; late events, counted too, make up for what is missing."""
    run = rollups.run_folder(spark, "late")
    events = given.table(spark, folder, "events")
    zoned = events.select(given.zone_code(F.col("user_id") % 8).alias("zone_id"), F.col("ts").alias("event_datetime"))
    for part in range(3):  # a later file goes back to the first days
        zoned.where(F.dayofyear("event_datetime") % 3 == part).write.mode("append").parquet(f"{run}/in")
    stream = spark.readStream.schema(zoned.schema).option("maxFilesPerTrigger", 1).parquet(f"{run}/in")
    hours = rollups.drain_closed_hours(stream, run)
    late = hours.late().groupBy("zone_id", rollups.floor_hour("event_datetime").alias("date_hour")).agg(
        F.count(F.lit(1)).alias("demand_count")
    )
    parts = hours.closed().unionByName(hours.still_open()).unionByName(late)
    return parts.groupBy("zone_id", "date_hour").agg(F.sum("demand_count").alias("demand_count"))


@query
def stream_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines de-duplicated on order and line number as a stream, counted per line number.

    Copies may lie years apart, so no watermark fits: each batch is added as keyed
    changes, and the first batch that holds a key keeps it.
    """
    key = ["l_orderkey", "l_linenumber"]
    run = rollups.run_folder(spark, "dedupe")
    kept = rollups.drain_upserts(given.line_stream(spark, folder), run, key, ["l_shipdate"], keep=changelog.FIRST).read()
    return kept.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("lines"))


@query
def stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Latest event per zone kept by keyed upserts from a stream."""
    run = rollups.run_folder(spark, "upsert")
    log = rollups.drain_upserts(given.event_stream(spark, folder), run, ["zone_id"], ["event_datetime", "event_id"])
    return log.read().select("zone_id", "event_id", "event_datetime", "final_call_type")


@query
def upsert_levels(spark: SparkSession, folder: str) -> DataFrame:
    """State of every user after the events came in twelve batches, merged on three levels of a log.

    A batch holds the events of every twelfth number; of a user's events in one batch the latest counts.
    """
    log = changelog.ChangeLog(spark, rollups.run_folder(spark, "levels"), ["user_id"], fan=3)
    events = given.table(spark, folder, "events").select("user_id", "event_id", "ts", "event_type", "value")
    for number in range(BATCHES):
        log.append(events.where(F.col("event_id") % BATCHES == number), number, ["ts", "event_id"], tag=f"run-{number}")
    return tidy(log.read().drop(changelog.LOADED).withColumnRenamed(changelog.TAG, "load_tag"))


# --- files ----------------------------------------------------------------


@query
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Raw records written as CSV, read back by header, cleaned and counted per zone and flag."""
    path = f"{rollups.run_folder(spark, 'csv')}/events"
    given.raw_records(spark, folder).write.option("header", True).csv(path)
    cleaned = cleaning.clean_events(readers.read_events(spark, path))
    return cleaned.groupBy("zone_id", "data_quality_flag").agg(F.count(F.lit(1)).alias("events"))


@query
def numbered_source_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of CSV files numbered in file order: files, rows and number bounds."""
    path = f"{rollups.run_folder(spark, 'numbered')}/lines"
    given.keyed_lines(spark, folder).select("l_orderkey").write.option("header", True).csv(path)
    numbered = readers.numbered_rows(readers.read_events(spark, path, position=True))
    per_file = numbered.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"), F.max("source_row_number").alias("last"),
        F.count_distinct("source_row_number").alias("distinct_numbers"),
    )
    return per_file.agg(
        F.sum("n").alias("rows"), F.sum("last").alias("highest_numbers"), F.sum("distinct_numbers").alias("numbers")
    )


@query
def report_export(spark: SparkSession, folder: str) -> DataFrame:
    """Named reports written as CSV with their row counts; one without its table is listed as failed."""
    tables = {"fact": given.order_fact(spark, folder)}
    names = ["monthly_trend", "demand_by_service_category", "demand_volatility_by_zone"]
    done = reports.export(tables, rollups.run_folder(spark, "reports"), names)
    return done.select("name", F.coalesce("rows", F.lit(-1).cast("long")).alias("rows"), F.col("error").isNotNull().alias("failed"))


@query
def catalog_load(spark: SparkSession, folder: str) -> DataFrame:
    """Events loaded into a catalog table in three batches, one of them twice."""
    run = rollups.run_folder(spark, "catalog")
    name = "events_" + run.rsplit("-", 1)[1]
    events = given.cleaned_events(spark, folder).select(
        "event_id", "event_datetime", "zone_id", (F.col("event_id").cast("long") % 2 == 0).alias("is_even")
    )
    for batch in (0, 1, 2, 1):
        writers.load_table(events.where(F.col("event_id").cast("long") % 3 == batch), name, batch, run)
    return spark.table(name).withColumnRenamed(writers.BATCH, "batch")


@query
def capped_sample(spark: SparkSession, folder: str) -> DataFrame:
    """A hundred events of each type, drawn by a seeded hash."""
    events = given.table(spark, folder, "events").select("event_id", "event_type", "user_id")
    return sampling.capped_sample(events, 100, ["event_id"], seed=42, by=["event_type"])


@query
def capped_sample_all(spark: SparkSession, folder: str) -> DataFrame:
    """Five hundred orders, drawn by a seeded hash."""
    orders = given.table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return sampling.capped_sample(orders, 500, ["o_orderkey"], seed=7)


@query
def tracked_build(spark: SparkSession, folder: str) -> DataFrame:
    """Daily events built from files: first, again, with another parameter, and after more files came."""
    run = rollups.run_folder(spark, "build")
    events = f"{folder}/events.parquet"
    given.table(spark, folder, "events").where("event_id % 2 = 0").write.parquet(f"{run}/more")

    def daily(least: int):
        def build(files):
            rows = spark.read.parquet(*files).where(F.col("value") >= least)
            return rows.groupBy(F.col("ts").cast("date").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("events"))

        return build

    steps = []
    for number, (inputs, least) in enumerate([([events], 0), ([events], 0), ([events], 5), ([events, f"{run}/more"], 5)]):
        made = builds.build_tracked(spark, f"{run}/daily", inputs, daily(least), {"least": least}, additive=True)
        total = made.table.agg(F.sum("events").alias("events"))
        steps.append(cut_lineage(total.select(F.lit(number).alias("step"), F.lit(made.decision).alias("decision"), "events")))
    return steps[0].union(steps[1]).union(steps[2]).union(steps[3])


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    """Events per type, from which the files below are made."""
    return given.table(spark, folder, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum("user_id").alias("users"),
        F.min("ts").alias("first"), (F.count(F.lit(1)) % 2 == 0).alias("is_even"),
    )


@query
def weather_file(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly weather written as a file with a preamble and units in its header, later rows of an hour included, and read."""
    path = f"{rollups.run_folder(spark, 'weather')}/file"
    hours = given.weather(spark, folder)
    names = [c for c in hours.columns if c != "weather_hour"]
    header = F.lit(",".join(["time", *[f"{c} (unit)" for c in names]]))
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]
    time = F.substring(F.col("weather_hour").cast("string"), 1, 16)
    later = F.concat(F.substring(time, 1, 14), F.lit("30"))
    first, again = F.concat_ws(",", time, *values), F.concat_ws(",", later, *[F.lit("-1")] * len(names))
    rows = hours.select(time.alias("at"), F.explode(F.array(first, again)).alias("value"))
    top = hours.agg(F.array(F.lit("latitude,longitude"), F.lit("47.6,-122.3"), F.lit(""), header).alias("lines"))
    preamble = top.select(F.posexplode("lines").alias("n", "value")).select(F.concat(F.lit(" "), F.col("n")).alias("at"), "value")
    preamble.unionByName(rows).orderBy("at", F.substring("value", 15, 2)).coalesce(1).select("value").write.text(path)
    return tidy(readers.read_weather(spark, path))


@query
def lookup_file(spark: SparkSession, folder: str) -> DataFrame:
    """Zone lookup written as CSV under other headers and read back."""
    path = f"{rollups.run_folder(spark, 'lookup')}/zones"
    zones = given.zone_lookup(spark, folder)
    zones.select(
        F.lower("zone_id").alias(" Beat"), F.lower("precinct").alias("First__Precinct"), F.lower("sector").alias("SECTOR")
    ).write.option("header", True).csv(path)
    return readers.read_zone_lookup(spark, path)


@query
def source_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Written CSV sources and a missing one: readable, columns and rows that parse among the first hundred."""
    run = rollups.run_folder(spark, "inventory")
    events = given.table(spark, folder, "events").select("event_id", "event_type")
    writers.write_csv(events, f"{run}/events")
    writers.write_csv(_counts(spark, folder).select("event_type", "events"), f"{run}/counts", single_file=True)
    listed = readers.inventory(spark, {n: f"{run}/{n}" for n in ("events", "counts", "absent")})
    return listed.select("source", "exists", "readable", "columns", "sample_rows")


@query
def trial_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A trial run that reads a given number of rows of the raw extract."""
    path = f"{rollups.run_folder(spark, 'trial')}/events"
    given.raw_records(spark, folder).write.option("header", True).csv(path)
    trial = readers.read_events(spark, path, columns=["CAD Event Number"], rows=150)
    return trial.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("CAD Event Number").alias("distinct_rows"))


@query
def single_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Events per type as one CSV file, read back with its number of files."""
    path = f"{rollups.run_folder(spark, 'single')}/counts"
    writers.write_csv(_counts(spark, folder).select("event_type", "events", "users"), path, single_file=True)
    back = readers.read_csv_text(spark, path)
    files = back.agg(F.count_distinct(F.col("_metadata.file_path")).alias("n")).scalar()
    return back.select("event_type", F.col("events").cast("long").alias("events"), F.col("users").cast("long").alias("users"), files.alias("files"))


@query
def preview_file(spark: SparkSession, folder: str) -> DataFrame:
    """The first 5,000 events by user and number as a preview file."""
    path = f"{rollups.run_folder(spark, 'preview')}/events"
    events = given.table(spark, folder, "events").select("user_id", "event_id", "event_type")
    writers.write_preview(events, path, ["user_id", "event_id"])
    back = readers.read_csv_text(spark, path)
    return back.select(F.col("user_id").cast("long").alias("user_id"), F.col("event_id").cast("long").alias("event_id"), "event_type")


@query
def json_record(spark: SparkSession, folder: str) -> DataFrame:
    """Totals as a record in a JSON file, with a list of the types, read back."""
    path = f"{rollups.run_folder(spark, 'record')}/totals"
    writers.write_record(
        _counts(spark, folder).agg(F.sum("events").alias("events"), F.array_sort(F.collect_list("event_type")).alias("types")), path
    )
    back = spark.read.schema("events long, types array<string>").json(path)
    return back.select("events", F.array_join("types", ",").alias("types"))


@query
def run_records(spark: SparkSession, folder: str) -> DataFrame:
    """Figures of three runs, one of them recorded twice."""
    path = f"{rollups.run_folder(spark, 'runs')}/log"
    n = given.table(spark, folder, "events").count()
    for tag, events in (("2024/01", n), ("b", n + 1), ("2024/01", n + 2)):
        writers.record_run(spark, path, tag, {"events": events, "note": None})
    return readers.optional_table(spark, path, "run_tag string").select(
        "run_tag", F.col("details")["events"].alias("events"), F.col("details")["note"].isNull().alias("no_note")
    )


@query
def optional_input(spark: SparkSession, folder: str) -> DataFrame:
    """Events, and a table that is not there, side by side."""
    absent = readers.optional_table(spark, f"{rollups.run_folder(spark, 'none')}/table", "event_id long, event_type string")
    present = readers.optional_table(spark, f"{folder}/events.parquet", "event_id long").select("event_id", "event_type")
    return present.unionByName(absent).groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


@query
def published_view(spark: SparkSession, folder: str) -> DataFrame:
    """The zone summary under its published name."""
    summary = cut_lineage(marts.zone_summary(_rows(spark, folder)))
    names = writers.publish({"zone_summary": summary, "other": summary})
    return spark.table(names[0]).select("zone_id", F.col("total_service_demand").cast("long").alias("demand"), F.lit(",".join(names)).alias("views"))


@query
def export_types(spark: SparkSession, folder: str) -> DataFrame:
    """Events per type with a flag as a number and a time as text, read through a view."""
    writers.register({"export_types_input": _counts(spark, folder)})
    return spark.table("export_types_input")


@query
def server_hosts(spark: SparkSession, folder: str) -> DataFrame:
    """Host of an address per customer, without account and port."""
    c = given.table(spark, folder, "customer")
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    address = F.concat(F.lit("mongodb://u"), key, F.lit(":p@H"), nation, F.lit(".example:27017/db"))
    address = F.when(F.col("c_custkey") % 10 == 0, F.lit(None)).when(F.col("c_custkey") % 10 == 1, F.lit("no address")).otherwise(address)
    return c.select("c_custkey", tx.uri_host(address).alias("host"))


@query
def field_mapping(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical fields, the raw columns behind them, and how many records fill each."""
    raw = schema.require_columns(given.raw_records(spark, folder), ["CAD Event Number"])
    report = schema.mapping_report(spark, schema.resolve(raw.columns))
    filled = raw.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in raw.columns]).unpivot([], list(raw.columns), "raw_column", "filled")
    return report.join(filled, "raw_column", "left")


@query
def geojson_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Polygons written as a GeoJSON file of one line, with braces and quotes in a property, and read in pieces."""
    path = f"{rollups.run_folder(spark, 'geojson')}/shapes"
    shapes = given.customer_polygons(spark, folder)
    note = F.concat(F.lit('a "{'), F.substring("zone_id", 2, 20), F.lit('}" \\ b'))
    properties = F.to_json(F.struct(F.lower("zone_id").alias("Beat"), note.alias("note")))
    geometry = F.concat(F.lit('{"type": "'), F.col("type"), F.lit('", "coordinates": '), F.col("coordinates"), F.lit("}"))
    feature = F.concat(F.lit('{"type": "Feature", "properties": '), properties, F.lit(', "geometry": '), geometry, F.lit("}"))
    bounds = shapes.agg(F.lit(0).alias("n"), F.lit('{"type": "FeatureCollection", "crs": {"a": "}"}, "features": [{}').alias("value"))
    ends = shapes.agg(F.lit(2).alias("n"), F.lit("]}").alias("value"))
    body = shapes.select(F.lit(1).alias("n"), F.concat(F.lit(", "), feature).alias("value"))
    lines = bounds.unionByName(body).unionByName(ends).orderBy("n").coalesce(1)
    lines.select("value").write.option("lineSep", " ").text(path)
    back = readers.read_geojson(spark, path)
    rings = F.when(F.col("type") == "Polygon", F.size(F.from_json("coordinates", geo.POLYGON)))
    return back.select("zone_id", "type", F.col("properties")["note"].alias("note"), F.coalesce(rings, F.lit(3)).alias("parts_of_text"))
