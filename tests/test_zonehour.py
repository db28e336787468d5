import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from zoneflow.functions import time as tm
from zoneflow.operators import enrich, zonehour
from zoneflow.operators.cleaning import CLEAN_COLUMNS
from zoneflow.sources import given

START = datetime(2024, 3, 9, 22)
FOLDER = "/root/testdata/sf0.001"


def events(spark, rows):
    """Cleaned events from (id, time, zone, category)."""
    df = spark.createDataFrame(rows, "event_id string, event_datetime timestamp_ntz, zone_id string, normalized_service_category string")
    blank = {c: F.lit(None).cast("double" if c in ("latitude", "longitude") else "string") for c in CLEAN_COLUMNS if c not in df.columns}
    return df.withColumns(blank)


def weather(spark, rows):
    return spark.createDataFrame(rows, "weather_hour timestamp_ntz, temperature_2m double")


def test_spring_forward_does_not_double_events(spark, zone):
    """02:00 and 03:00 are one instant on this day in Los Angeles, but two wall-clock hours."""
    fact = enrich.build_fact(
        events(spark, [("1", datetime(2021, 3, 14, 3, 10), "Z1", "C")]),
        weather(spark, [(datetime(2021, 3, 14, 2), 1.0), (datetime(2021, 3, 14, 3), 2.0), (datetime(2021, 3, 14, 3, 20), None)]),
    )
    [row] = fact.collect()
    assert (row.temperature_2m, row.weather_hour, row.event_hour) == (2.0, datetime(2021, 3, 14, 3), 3)
    assert fact.columns == enrich.FACT_COLUMNS and len(fact.columns) == 35


def test_zone_lookup_fills_gaps_and_keeps_rows(spark):
    lookup = spark.createDataFrame(
        [(" z1", "west", None), ("Z1", "west", "k"), ("Z2", "east", "e")], "zone_id string, precinct string, sector string"
    )
    cleaned = events(spark, [("1", START, "Z1", "C"), ("2", START, "Z3", "C"), ("3", START, None, "C")])
    rows = {r.event_id: r for r in enrich.build_fact(cleaned, weather(spark, [(START, 1.0)]), lookup).collect()}
    assert (rows["1"].precinct, rows["1"].sector) == ("WEST", "K")
    assert rows["2"].precinct is None and rows["2"].temperature_2m == 1.0
    assert (rows["3"].zone_id, rows["3"].beat) == ("UNKNOWN", "UNKNOWN")


def test_lineage_finds_lost_new_and_doubled_ids(spark):
    before = spark.createDataFrame([("a",), ("b",), ("c",)], "event_id string")
    after = spark.createDataFrame([("a",), ("a",), ("b",), ("d",)], "event_id string")
    row = enrich.lineage(before, after).first()
    assert (row.missing_ids, row.new_ids, row.duplicate_rows) == (1, 1, 1)
    assert row.duplicate_impact == pytest.approx(1 / 3)


def history(spark, dense):
    """One zone seen at hours 0, 5 and 9 with demand 2, 4 and 6."""
    rows = [(str((h, i)), START + timedelta(hours=h), "Z1", "C") for h, n in ((0, 2), (5, 4), (9, 6)) for i in range(n)]
    fact = enrich.build_fact(events(spark, rows), weather(spark, [(START, 1.0)]))
    built = zonehour.build(fact, dense=dense).orderBy("date_hour").collect()
    return [r for r in built if r.target_demand_count > 0], built


def test_offsets_count_observed_rows(spark, zone):
    seen, built = history(spark, dense=False)
    assert len(built) == 3 and len(built[0]) == 26
    assert [r.lag_1_hour_demand for r in seen] == [0, 2, 4]
    assert [r.rolling_7_day_avg for r in seen] == [0.0, 2.0, 3.0]
    assert [r.date_hour for r in seen] == [START, START + timedelta(hours=5), START + timedelta(hours=9)]


def test_dense_table_counts_hours(spark, zone):
    seen, built = history(spark, dense=True)
    assert len(built) == 10
    assert [r.lag_1_hour_demand for r in seen] == [0, 0, 0]
    assert [r.rolling_7_day_avg for r in seen] == pytest.approx([0.0, 2 / 5, 6 / 9])
    assert {r.hour for r in built} == {22, 23, *range(8)}
    assert all(r.is_weekend for r in built)


def test_quantile_modes(spark):
    """1, 2, 3, 4, 10, 12: interpolated 8.5, discrete 10."""
    hours = spark.createDataFrame([("Z", n) for n in (1, 2, 3, 4, 10, 12)], "zone_id string, target_demand_count long")
    for exact, threshold, flagged in ((True, 8.5, 2), (False, 10.0, 1)):
        rows = zonehour.add_high_demand(hours, exact=exact).collect()
        assert {r.zone_high_threshold for r in rows} == {threshold}
        assert sum(r.high_demand_flag for r in rows) == flagged


def test_category_mix_and_null_dates(spark):
    mix = "AAAABBBCCD"
    rows = [(str(i), START, "Z1", c) for i, c in enumerate(mix)] + [("n1", None, "Z1", "A"), ("n2", None, "Z1", "B")]
    rolled = zonehour.rollup(enrich.build_fact(events(spark, rows), weather(spark, [(START, 4.0)])))
    by_hour = {r.date_hour: r for r in rolled.collect()}
    assert by_hour[START].category_mix_top_1_share == pytest.approx(0.4)
    assert by_hour[START].category_mix_top_3_share == pytest.approx(0.9)
    assert by_hour[START].temperature_2m == 4.0
    assert by_hour[None].target_demand_count == 2 and by_hour[None].category_mix_top_1_share == 0.5


def test_properties_on_given_tables(spark):
    fact = given.fact(spark, FOLDER)
    assert fact.count() == given.cleaned_events(spark, FOLDER).count()
    hours = zonehour.build(fact)
    checks = hours.agg(
        F.sum("target_demand_count").alias("demand"), F.count("*").alias("n"),
        F.count_distinct("zone_id", "date_hour").alias("keys"),
        F.max("category_mix_top_3_share").alias("top3"),
        F.count(F.when(F.col("category_mix_top_1_share") > F.col("category_mix_top_3_share"), 1)).alias("wrong"),
    ).first()
    assert checks.demand == fact.count() and checks.n == checks.keys
    assert checks.top3 <= 1 + 1e-9 and checks.wrong == 0
    first = hours.groupBy("zone_id").agg(F.min_by("lag_1_hour_demand", "date_hour").alias("lag"))
    assert first.filter("lag <> 0").count() == 0


def test_plan_combines_before_the_first_shuffle(spark):
    """Events meet the wire once, already combined; the tables after it are small."""
    from pyspark.sql import DataFrame

    def plan(df: DataFrame) -> str:
        return df._jdf.queryExecution().executedPlan().toString()

    text = plan(zonehour.build(given.fact(spark, FOLDER)))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert text.count("SortMergeJoin") == 0
    main = text.split("Scan parquet")[0]
    assert main.count("Exchange hashpartitioning(zone_id") == 3


def test_history_by_time_equals_the_dense_table(spark):
    rng = random.Random(17)
    hours = {z: sorted(rng.sample(range(600), n)) for z, n in (("a", 200), ("b", 5), ("c", 1), ("d", 0))}
    start = datetime(2024, 3, 1)
    rows = [(z, start + timedelta(hours=h), rng.randrange(1, 9)) for z, hs in hours.items() for h in hs] + [("a", None, 4)]
    df = spark.createDataFrame(rows, "zone_id string, date_hour timestamp_ntz, target_demand_count long")
    df = tm.add_calendar_parts(df.withColumn("date", F.col("date_hour").cast("date")).withColumn("hour", F.hour("date_hour")), "date", "hour")
    dated = df.where("date_hour is not null")
    names = ["zone_id", "date_hour", *zonehour.LAG_NAMES.values(), "rolling_7_day_avg"]
    dense = zonehour.add_history(zonehour.densify(dated)).where("target_demand_count > 0").select(*names)
    by_time = zonehour.add_history_by_time(df).select(*names)
    rounded = lambda d: sorted(tuple(round(x, 9) if isinstance(x, float) else str(x) for x in r) for r in d.collect())
    assert rounded(by_time.where("date_hour is not null")) == rounded(dense)
    assert [tuple(r)[2:] for r in by_time.where("date_hour is null").collect()] == [(0, 0, 0, 0.0)]
    plan = by_time._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
