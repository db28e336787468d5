from datetime import datetime

import pytest
from pyspark.sql import functions as F

from zoneflow.operators import audit, cleaning, collapse, schema
from zoneflow.sources import given


def test_normalize_names():
    assert schema.normalize_name(" CAD Event # & Number__ ") == "cad_event_and_number"
    assert schema.weather_name("temperature_2m (Â°C)") == "temperature_2m"
    assert schema.lookup_name(" First__Precinct ") == "first_precinct"


def test_resolve_prefers_exact_then_partial_names():
    found = schema.resolve(["CAD Event Number", "Final Call Type", "Dispatch Beat", "My Latitude Value"])
    assert found["event_id"] == "CAD Event Number"
    assert found["final_call_type"] == "Final Call Type"
    assert found["call_type"] == "Final Call Type"  # contains "call_type"
    assert found["latitude"] == "My Latitude Value"
    assert found["disposition"] is None


def test_schema_helpers(spark):
    df = spark.createDataFrame([("1", "x")], "A string, b string")
    assert schema.choose_column(df.columns, ["z", "a"], "role") == "A"
    assert schema.choose_column(df.columns, ["z"], "role", required=False) is None
    with pytest.raises(ValueError, match="no role column"):
        schema.choose_column(df.columns, ["z"], "role")
    with pytest.raises(ValueError, match="missing required columns: q"):
        schema.require_columns(df, ["b", "q"])
    assert schema.coerce_numbers(df, ["A", "b", "c"]).select("A", "b", "c").first() == (1.0, 0.0, 0.0)
    assert schema.fill_missing(df, {"n": "double"}).first().n is None
    report = {r.canonical_field: r.raw_column for r in schema.mapping_report(spark, {"a": "X", "b": None}).collect()}
    assert report == {"a": "X", "b": "MISSING"}


def test_clean_events(spark):
    raw = spark.createDataFrame(
        [
            (" 1 ", "01/05/2024 01:02:03 PM", " k1 ", "dv - no/assault", "1,047.5"),
            ("2", "bad", None, None, "REDACTED"),
        ],
        "`Event Number` string, `Created At` string, Beat string, `Final Call Type` string, Lat string",
    )
    first, second = cleaning.clean_events(raw).orderBy("event_id").collect()
    assert first.asDict() == {
        "event_id": "1", "event_datetime": datetime(2024, 1, 5, 13, 2, 3), "call_type": "dv - no/assault",
        "initial_call_type": None, "final_call_type": "dv - no/assault", "service_category": None,
        "normalized_service_category": "Dv - No/Assault", "disposition": None, "zone_id": "K1", "beat": "K1",
        "sector": None, "precinct": None, "latitude": 1047.5, "longitude": None, "neighborhood": None,
        "reporting_area": None, "data_quality_flag": "ok",
    }
    assert (second.zone_id, second.beat, second.latitude) == ("UNKNOWN", None, None)
    assert second.data_quality_flag == "missing_datetime;missing_zone;missing_category"
    unflagged = cleaning.clean_events(raw, flag_zone_before_fill=False).filter("event_id = '2'").first()
    assert unflagged.data_quality_flag == "missing_datetime;missing_category"


def test_ids_are_generated_when_the_source_has_none(spark):
    raw = spark.createDataFrame([("a",), ("a",)], "beat string")
    ids = [r.event_id for r in cleaning.clean_events(raw).collect()]
    assert len(set(ids)) == 2 and all(i.startswith("generated_") for i in ids)


def test_collapse_orders_score_then_time_then_row(spark):
    rows = [("a", 8, 1, 1), ("a", 7, 9, 9), ("b", 5, None, 3), ("b", 5, 2, 1), ("c", 1, 1, 1), ("c", 1, 1, 2), (None, 1, 1, 1), (None, 2, 1, 1)]
    df = spark.createDataFrame(rows, "k string, score int, ts int, row int")
    best = {r.k: (r.score, r.ts, r.row, r.duplicate_count) for r in collapse.collapse(df, ["k"], ["score", "ts", "row"]).collect()}
    assert best == {"a": (8, 1, 1, 2), "b": (5, 2, 1, 2), "c": (1, 1, 2, 2), None: (2, 1, 1, 2)}
    first = {r.k: r.row for r in collapse.keep_first(df, ["k"], ["row", "score"]).collect()}
    assert first == {"a": 1, "b": 1, "c": 1, None: 1}


def test_collapse_survives_a_hot_key(spark):
    """Half of all rows share one key; each task must send one row of it."""
    df = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 1000).cast("string"))).alias("k"),
        F.col("id").alias("v"),
    )
    out = collapse.collapse(df, ["k"], ["v"])
    hot = out.filter("k = 'hot'").first()
    assert (hot.v, hot.duplicate_count) == (199_998, 100_000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_upsert_replaces_and_keeps(spark):
    current = spark.createDataFrame([("a", 1, 0), ("b", 1, 0)], "k string, v int, t int")
    new = spark.createDataFrame([("b", 2, 1), ("b", 3, 2), ("c", 4, 1)], "k string, v int, t int")
    merged = {r.k: r.v for r in collapse.upsert(current, new, ["k"], ["t"]).collect()}
    assert merged == {"a": 1, "b": 3, "c": 4}


def test_collapse_events_without_audit(spark):
    folder = "/root/testdata/sf0.001"
    copies = given.copied_events(spark, folder).withColumn("event_datetime", F.col("event_datetime").cast("string"))
    cleaned = cleaning.clean_events(copies, keep=("source_row_number",))
    out = collapse.collapse_events(cleaned, ["source_row_number"])
    assert out.count() == out.select("event_id").distinct().count() == 1000
    assert out.agg(F.sum("duplicate_count")).first()[0] == copies.count()
    assert out.filter("has_duplicate_history <> (duplicate_count > 1)").count() == 0
    assert out.select("duplicate_reason").distinct().count() == 1


def audit_of(spark, rows):
    names = "event_id string, event_datetime string, beat string, final_call_type string, disposition string, extra string"
    return audit.groups(audit.canonical_copies(spark.createDataFrame(rows, names)))


@pytest.mark.parametrize(
    "change, reason",
    [
        ({}, "A"), ({"extra": "other"}, "B"), ({"event_datetime": "2024-01-01 00:01:00"}, "C"), ({"beat": "Z9"}, "D"),
        ({"final_call_type": "moved"}, "E"), ({"disposition": "x"}, "F"), ({"disposition": None}, "F"),
        ({"beat": "Z9", "disposition": "x"}, "G"), ({"beat": " z1 "}, "B"),
    ],
)
def test_audit_reasons(spark, change, reason):
    base = {
        "event_id": "1", "event_datetime": "2024-01-01 00:00:00", "beat": "Z1", "final_call_type": "t",
        "disposition": "d", "extra": "e",
    }
    [group] = audit_of(spark, [tuple(base.values()), tuple({**base, **change}.values())]).collect()
    assert group.duplicate_reason[0] == reason
    assert group.duplicate_group_size == 2 and group.rows_beyond_first == 1
    assert group.possible_event_update_or_history == (reason in "CDEFG")


def test_audit_ignores_single_records_and_passes_exact_copies(spark):
    row = ("1", "2024-01-01 00:00:00", "Z1", "t", "d", "e")
    groups = audit_of(spark, [row, row, row, ("2", *row[1:])])
    [only] = groups.collect()
    assert (only.event_id, only.duplicate_group_size) == ("1", 3)
    verdict = audit.verdict(groups).first()
    assert verdict.status == audit.PASS and verdict.rows_beyond_first == 2
    assert audit.verdict(groups.filter("false")).first().status == audit.PASS


def test_audit_samples_are_bounded_per_reason_but_complete_per_group(spark):
    rows = [(str(i % 50), "2024-01-01 00:00:00", "Z1", "t", str(i), "e") for i in range(500)]
    names = "event_id string, event_datetime string, beat string, final_call_type string, disposition string, extra string"
    copies = audit.canonical_copies(
        spark.createDataFrame(rows, names).withColumn("source_row_number", F.monotonically_increasing_id()),
        keep=("source_row_number",),
    )
    sampled = audit.samples(copies, audit.groups(copies))
    assert sampled.select("event_id").distinct().count() == 20
    assert sampled.count() == 200
