import pytest
from pyspark.sql import functions as F

from zoneflow.operators import marts, planner, quality, zonehour
from zoneflow.sources import given

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fact"))
    given.fact(spark, FOLDER).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def hours(spark, fact, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hours"))
    zonehour.build(fact).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_mart_input_accepts_other_names_and_types(spark):
    df = spark.createDataFrame(
        [(" k1 ", "2024-01-06", "7", "5", "3", "yes"), (None, "2024-01-08", None, None, None, "no"), ("Z", None, "1", "1", "1", "no")],
        "Beat string, Event_Date string, Hour string, Day_Of_Week string, Call_Count string, After_Hours string",
    )
    rows = {r.zone_id: r for r in marts.mart_input(df).collect()}
    assert set(rows) == {"K1", "UNKNOWN"}
    a, b = rows["K1"], rows["UNKNOWN"]
    assert (a.hour, a.weekday_name, a.demand_count, a.is_weekend, a.is_after_hours, a.period) == (7, "Saturday", 3, True, True, "2024-01")
    assert (b.hour, b.weekday_name, b.demand_count, b.is_weekend, b.temperature) == (-1, "Unknown", 0, False, None)
    with pytest.raises(ValueError, match="no date column"):
        marts.mart_input(df.drop("Event_Date"))


def test_totals_agree_between_grains(spark, fact, hours):
    rows = marts.mart_input(hours)
    zones = marts.zone_summary(rows).agg(F.sum("total_service_demand"), F.sum("zone_hour_records")).first()
    assert tuple(zones) == (fact.count(), hours.count())
    for mart in (marts.hourly_demand(rows), marts.daily_demand(rows), marts.heatmap(rows)):
        assert tuple(mart.agg(F.sum("demand_count"), F.sum("zone_hour_records")).first()) == tuple(zones)
    views = marts.weather_context(rows).groupBy("view").agg(F.sum("zone_hour_records").alias("n")).collect()
    assert len({r.n for r in views}) == 1 and len(views) == 2
    assert marts.category_share(fact).agg(F.sum("share_of_total")).first()[0] == pytest.approx(1.0)


def test_peak_hour_is_a_true_maximum_with_early_ties(spark):
    rows = spark.createDataFrame(
        [("Z", 9, 3), ("Z", 7, 1), ("Z", 7, 2), ("Z", 8, 1)], "zone_id string, hour int, demand_count long"
    ).withColumns({"is_weekend": F.lit(False), "is_after_hours": F.lit(True), "high_demand_flag": F.lit(0).cast("long")})
    row = marts.zone_summary(rows).first()
    assert (row.peak_hour, row.peak_hour_demand, row.total_service_demand) == (7, 3, 7)
    assert (row.after_hours_share, row.weekend_share) == (1.0, 0.0)


def test_views(spark, hours):
    rows = marts.mart_input(hours)
    whole = marts.zone_summary(rows)
    assert marts.view(rows, "2024-12", "2023-01").exceptAll(whole).count() == 0
    parts = [marts.view(rows, "2024-01", "2024-01", d).agg(F.sum("total_service_demand")).first()[0] for d in ("Weekday", "Weekend")]
    assert sum(parts) == whole.agg(F.sum("total_service_demand")).first()[0]
    assert marts.view(rows, "2020-01", "2020-02").count() == 0
    with pytest.raises(ValueError):
        marts.view(rows, "2024-01", "2024-01", "Holiday")


def test_risk_score_and_rank(spark):
    zones = spark.createDataFrame(
        [("a", 100, 4.0, 1.0, 0.5, 0.3), ("b", 200, 8.0, 3.0, 0.5, 0.1), ("c", 150, None, 2.0, 0.5, 0.2)],
        "zone_id string, total_events long, avg_hourly_demand double, demand_volatility double, after_hours_share double, weekend_share double",
    )
    scored = {r.zone_id: r.workload_risk_score for r in marts.add_risk_score(zones).collect()}
    assert scored == {"a": 27.5, "b": 85.0, "c": 37.5}  # the constant column counts 50
    ranks = {r.zone_id: r["rank"] for r in marts.rank_zones(marts.add_risk_score(zones)).collect()}
    assert ranks == {"b": 1, "c": 2, "a": 3}


def test_mode_ties_take_the_lowest_value(spark):
    df = spark.createDataFrame([("Z", v) for v in "baab"], "zone_id string, normalized_service_category string").withColumns(
        {"precinct": F.lit(None).cast("string"), "sector": F.lit("s"), "demand_count": F.lit(1), "event_datetime": F.lit(1)}
    )
    row = marts.zone_profile(df).first()
    assert (row.top_category, row.primary_precinct, row.primary_sector) == ("a", None, "s")


def test_scenario_plan(spark):
    zones = spark.createDataFrame([("a", 1000, 70.0), ("b", 10, 30.0)], "zone_id string, total_events long, workload_risk_score double")
    a = {r.zone_id: r for r in planner.plan(zones).collect()}["a"]
    assert a.priority_weight == pytest.approx(0.7) and a.projected_demand == pytest.approx(1155)
    assert a.resources_needed == pytest.approx(81.8125) and a.allocated_resources == pytest.approx(21)
    assert a.projected_capacity == pytest.approx(252) and a.workload_gap == pytest.approx(729.75)
    assert a.coverage_pct == pytest.approx(0.2181818) and a.recommendation_text == planner.REVIEW
    table = {r.input: r.value for r in planner.assumptions_table(spark, planner.Assumptions(high_risk_threshold=80)).collect()}
    assert len(table) == 7 and table["high_risk_threshold"] == 80


def test_recommendations_on_empty_input(spark):
    risk = spark.createDataFrame([], "zone_id string, workload_risk_score double")
    cats = spark.createDataFrame([], "normalized_service_category string, demand_count long")
    texts = [r.evidence_signal for r in planner.recommendations(risk, cats).orderBy("recommendation_id").collect()]
    assert len(texts) == 8 and texts[0].endswith("highest-risk zones") and texts[3].startswith("top service categories")


def test_quality_metrics(spark, fact, hours):
    doubled = fact.unionAll(fact.limit(3))
    table = {r.metric: r.value for r in quality.metrics(doubled, hours).collect()}
    assert table["duplicate_event_ids"] == "3"
    assert table["fact_rows"] == str(fact.count() + 3)
    assert table["column_missingness:initial_call_type"] == "100.0"
    assert "column_missingness:event_id" not in table
    assert table["zone_hour_rows"] == str(hours.count())


def test_pivot_and_small_views(spark, hours):
    rows = marts.mart_input(hours)
    pivot = marts.pivot_hours(rows, "zone_id")
    assert pivot.columns == ["zone_id", *[f"h{h}" for h in range(24)]]
    days = [r.weekday for r in marts.weekly_pattern(rows).collect()]
    assert days == sorted(days)
    assert marts.top_zone_heatmap(rows, 3).count() == 3
