import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from zoneflow.operators import cleaning, collapse
from zoneflow.plans import pipeline, reports
from zoneflow.plans.catalogue import QUERIES
from zoneflow.sources import given, readers, writers
from zoneflow.streaming import rollups

FOLDER = "/root/testdata/sf0.001"
WEATHER_CSV = """latitude,longitude,elevation
47.6,-122.3,10

time,temperature_2m (°C),rain (mm)
2024-01-01T00:00,1.5,0.0
2024-01-01T01:00,,0.2
2024-01-01T01:30,9.9,0.9
bad,2.0,1.0
"""


def test_read_events(spark, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text('﻿CAD Event Number,Beat,Note\n1,"K1, north",NA\n2,K2,"said ""x"""\n', encoding="utf-8")
    df = readers.read_events(spark, str(path))
    assert df.columns == ["CAD Event Number", "Beat", "Note"]
    rows = df.orderBy("CAD Event Number").collect()
    assert (rows[0].Beat, rows[0].Note, rows[1].Note) == ("K1, north", None, 'said "x"')
    raw = readers.read_events(spark, str(path), columns=["Note"], missing=False, rows=1)
    assert raw.columns == ["Note"] and raw.count() == 1 and raw.first().Note == "NA"


def test_rows_are_numbered_in_file_order(spark, tmp_path):
    for part in range(3):
        (tmp_path / f"p{part}.csv").write_text("n\n" + "".join(f"{i}\n" for i in range(1, 2001 + part)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # several blocks per file
    try:
        numbered = readers.numbered_rows(readers.read_events(spark, str(tmp_path), position=True))
        assert numbered.filter(F.col("n").cast("long") != F.col("source_row_number")).count() == 0
        assert numbered.count() == 6003
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_read_weather(spark, tmp_path, zone):
    path = tmp_path / "weather.csv"
    path.write_text("﻿" + WEATHER_CSV, encoding="utf-8")
    rows = {r.weather_hour: r for r in readers.read_weather(spark, str(path)).collect()}
    assert set(rows) == {datetime(2024, 1, 1, 0), datetime(2024, 1, 1, 1), None}
    assert rows[datetime(2024, 1, 1, 1)].temperature_2m is None  # the first row of the hour is kept
    assert rows[datetime(2024, 1, 1, 0)].temperature_2m == 1.5 and rows[datetime(2024, 1, 1, 0)].snowfall is None
    (tmp_path / "none.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="time,"):
        readers.read_weather(spark, str(tmp_path / "none.csv"))


def geojson(tmp_path):
    path = tmp_path / "zones.geojson"
    features = [
        {"properties": {"Beat": " k1 ", "n": 3}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}},
        {"properties": {"Beat": "K2"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]]]}},
    ]
    path.write_text("﻿" + json.dumps({"type": "FeatureCollection", "features": features}, indent=1), encoding="utf-8")
    return str(path)


def test_read_lookup_and_geojson(spark, tmp_path):
    (tmp_path / "zones.csv").write_text("BEAT,First__Precinct,Sector,Shape_Area\n k1,West,k,2.5\n")
    assert readers.read_zone_lookup(spark, str(tmp_path / "zones.csv")).first().asDict() == {
        "zone_id": "K1", "beat": "K1", "precinct": "WEST", "sector": "K", "shape_area": "2.5",
    }
    (tmp_path / "bad.csv").write_text("zone\nk1\n")
    with pytest.raises(ValueError, match="beat"):
        readers.read_zone_lookup(spark, str(tmp_path / "bad.csv"))
    rows = {r.zone_id: r for r in readers.read_geojson(spark, geojson(tmp_path)).collect()}
    assert set(rows) == {"K1", "K2"} and rows["K1"].properties["n"] == "3"
    assert json.loads(rows["K2"].coordinates)[0][0][1] == [1, 0]


def test_inventory_and_report_metrics(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x" * 2048)
    rows = {r.source: r for r in readers.inventory(spark, {"a": str(tmp_path / "a.csv"), "b": str(tmp_path / "no")}).collect()}
    assert (rows["a"].exists, rows["a"].size_readable, rows["b"].exists) == (True, "2.00 KB", False)
    (tmp_path / "c.csv").write_text("k,v\n" + "1,2\n" * 150)
    [c] = readers.inventory(spark, {"c": str(tmp_path / "c.csv")}).collect()
    assert (c.readable, c.columns, c.sample_rows, rows["b"].readable) == (True, "k, v", readers.SAMPLE_ROWS, False)
    with pytest.raises(FileNotFoundError, match="b "):
        readers.inventory(spark, {"b": str(tmp_path / "no")}, strict=True)
    (tmp_path / "r.md").write_text("# T\n- Rows: `1,234`\n- Coverage: `25.15%`\n- Rows: `9`\n- Mode: full\n")
    found = {r.label: (r.text, r.number) for r in readers.report_metrics(spark, str(tmp_path / "r.md"), ["Rows", "Coverage", "Mode", "None"]).collect()}
    assert found == {"Rows": ("1,234", 1234.0), "Coverage": ("25.15%", pytest.approx(0.2515)), "Mode": ("full", None)}
    assert readers.optional_table(spark, str(tmp_path / "missing"), "a string").count() == 0


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(2, True, datetime(2024, 1, 2)), (1, False, datetime(2024, 1, 1))], "k int, b boolean, t timestamp_ntz")
    writers.write_csv(df, str(tmp_path / "csv"), single_file=True)
    assert len(list((tmp_path / "csv").glob("part-*.csv"))) == 1
    writers.write_preview(df, str(tmp_path / "preview"), ["k"], 1)
    assert spark.read.csv(str(tmp_path / "preview"), header=True).first().k == "1"
    assert writers.sql_types(df).orderBy("k").first() == (1, 0, "2024-01-01 00:00:00")
    writers.write_record(df.limit(1), str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 1
    with pytest.raises(ValueError, match="one row"):
        writers.write_record(df, str(tmp_path / "json"))
    table = writers.write_table(df, str(tmp_path / "t"), partition_by=["k"], sort_by=["t"])
    assert table.filter("k = 2").count() == 1
    calls = []
    build = lambda: calls.append(1) or df
    for mode in ("skip", "skip", "overwrite"):
        writers.build_once(spark, str(tmp_path / "once"), build, mode)
    assert len(calls) == 2
    assert writers.publish({"zone_summary": df}) == ["tableau_zone_summary"]
    assert spark.sql("select count(*) n from tableau_zone_summary").first().n == 2
    assert writers.register({"facts_sql": df}) == ["facts_sql"]


def test_runs_keep_the_last_record_of_a_tag(spark, tmp_path):
    for tag, rows in (("r1", 1), ("r/2 é", 5), ("r1", 2)):
        writers.record_run(spark, str(tmp_path / "runs"), tag, {"rows": rows, "none": None})
    runs = {r.run_tag: r.details for r in writers.read_runs(spark, str(tmp_path / "runs")).collect()}
    assert runs == {"r1": {"rows": "2", "none": None}, "r/2 é": {"rows": "5", "none": None}}


def test_late_events_are_dropped_and_first_seen_kept(spark, tmp_path):
    schema = "event_id string, event_datetime timestamp_ntz, zone_id string"
    source = str(tmp_path / "in")
    batches = [
        [("1", datetime(2024, 1, 1, 0, 5), "Z"), ("2", datetime(2024, 1, 1, 5), "Z"), ("1", datetime(2024, 1, 1, 0, 6), "Z")],
        [("3", datetime(2024, 1, 1, 0, 30), "Z"), ("4", datetime(2024, 1, 1, 9), "Z")],
        [("5", datetime(2024, 1, 1, 5, 30), "Z"), ("6", datetime(2024, 1, 1, 12), "Z")],
    ]
    counts, run = {}, str(tmp_path / "run")
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        rows = rollups.drain_to_parquet(rollups.zone_hour_counts(stream), run)
        counts = {r.date_hour.hour: r.demand_count for r in rows.collect()}
    assert counts == {0: 2, 5: 1, 9: 1}  # event 3 came 8 hours late, event 5 after its hour had closed
    stream = spark.readStream.schema(schema).parquet(source)
    kept = rollups.drain_to_parquet(rollups.first_seen(stream, delay="1 day"), str(tmp_path / "dedupe"))
    assert sorted(r.event_id for r in kept.collect()) == ["1", "2", "3", "4", "5", "6"]


@pytest.mark.parametrize("name", ["stream_zone_hour", "stream_dedupe", "stream_upsert"])
def test_streams_read_folder_tables(spark, tmp_path, name):
    for table in ("events", "lineitem"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").repartition(3).write.parquet(str(tmp_path / f"{table}.parquet"))
    found, same = (sorted(map(tuple, QUERIES[name](spark, f).collect())) for f in (str(tmp_path), FOLDER))
    assert found == same and len(found) > 0
    if name == "stream_zone_hour":
        assert sum(r[2] for r in found) == spark.read.parquet(f"{FOLDER}/events.parquet").where("ts is not null").count()


def test_records_without_an_id_are_all_kept(spark):
    raw = spark.createDataFrame([(None, "a"), (" ", "b"), ("", "c"), ("7", "d"), ("7", "e")], "event_id string, call_type string")
    events = collapse.collapse_events(cleaning.clean_events(raw), ["call_type"])
    assert sorted(r.call_type for r in events.collect()) == ["a", "b", "c", "e"]


def test_building_reports_runs_no_job_but_file_listings(spark):
    tracker = spark.sparkContext.statusTracker()
    group = "plan-only"
    for name in [q for q in QUERIES if q.startswith(("q01", "q02", "q03", "q05", "q09", "q12"))]:
        spark.sparkContext.setJobGroup(group, name)
        QUERIES[name](spark, FOLDER)
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert all(s.name.startswith("parquet") for s in stages if s)


def test_stream_upserts(spark, tmp_path):
    source, run = str(tmp_path / "in"), str(tmp_path / "run")
    for rows in ([("a", 1), ("b", 1)], [("b", 2), ("c", 1)]):
        spark.createDataFrame(rows, "k string, v int").write.mode("append").parquet(source)
        stream = spark.readStream.schema("k string, v int").parquet(source)
        log = rollups.drain_upserts(stream, run, ["k"], ["v"])
    assert {r.k: r.v for r in log.read().collect()} == {"a": 1, "b": 2, "c": 1}


def test_closed_hours_and_late_events(spark, tmp_path):
    """Out-of-order batches: an hour is counted once, late events stand apart, the state holds the hours within the delay."""
    hours = rollups.ClosedHours(spark, str(tmp_path / "hours"))
    at = lambda h, m=0: datetime(2024, 1, 1 + h // 24, h % 24, m)
    batches = [
        [("a", at(0, 5)), ("a", at(0, 50)), ("b", at(1))],
        [("a", at(0, 59)), ("a", at(5, 30)), ("b", None)],        # closes hours before 3
        [("a", at(1)), ("b", at(2, 59)), ("b", at(3)), ("b", at(4))],
        [],
        [("a", at(100, 10))],
        [("b", at(97)), ("b", at(98))],
    ]
    frames = [spark.createDataFrame(b, "zone_id string, event_datetime timestamp_ntz") for b in batches]
    for number, df in enumerate(frames):
        hours.apply(df, number)
        if number in (1, 2):
            hours.apply(df, number)  # a retry
    got = lambda df: sorted((r.zone_id, r.date_hour, r.demand_count) for r in df.collect())
    assert got(hours.closed()) == [("a", at(0), 3), ("a", at(5), 1), ("b", at(1), 1), ("b", at(3), 1), ("b", at(4), 1)]
    assert got(hours.still_open()) == [("a", at(100), 1), ("b", at(98), 1)]
    late = sorted(((r.zone_id, r.event_datetime) for r in hours.late().collect()), key=str)
    assert late == sorted([("a", at(1)), ("b", at(2, 59)), ("b", at(97)), ("b", None)], key=str)
    for number in range(12):
        hours.apply(spark.createDataFrame([("a", at(101 + number))], frames[0].schema), 6 + number)
    assert hours.still_open().count() == 3


def test_report_export_lists_failures(spark, tmp_path):
    fact = spark.createDataFrame([("ok",), ("ok",)], "data_quality_flag string")
    rows = {r.name: r for r in reports.export({"fact": fact}, str(tmp_path), ["data_quality_summary", "top_demand_zones"]).collect()}
    assert rows["data_quality_summary"].rows == 1 and rows["data_quality_summary"].error is None
    assert rows["top_demand_zones"].rows is None and "zone_id" in rows["top_demand_zones"].error


def test_pipeline_from_raw_files(spark, tmp_path):
    records = given.raw_records(spark, FOLDER)
    twice = records.unionAll(records.limit(40))
    twice.coalesce(2).write.option("header", True).csv(str(tmp_path / "events"))
    (tmp_path / "weather.csv").write_text(WEATHER_CSV)
    (tmp_path / "zones.csv").write_text("beat,precinct,sector\nz00,west,k\n")
    sources = pipeline.Sources(str(tmp_path / "events"), str(tmp_path / "weather.csv"), str(tmp_path / "zones.csv"), geojson(tmp_path))
    out = str(tmp_path / "out")
    tables = pipeline.run(spark, sources, out, "run-1")
    assert tables["events"].count() == tables["fact"].count() == 1000
    assert tables["audit"].count() == 40
    assert tables["audit"].select("duplicate_reason").distinct().first()[0].startswith("A.")
    assert tables["events"].filter("has_duplicate_history").count() == 40
    assert tables["reports"].filter("error is not null").count() == 0
    assert tables["zone_hour"].agg(F.sum("target_demand_count")).first()[0] == 1000
    kpis = spark.read.json(f"{out}/marts/dashboard_kpis").first()
    assert (kpis.fact_output_rows, kpis.post_enrichment_duplicate_fact_rows, kpis.mapped_beat_polygons) == (1000, 0, 2)
    [run] = writers.read_runs(spark, f"{out}/run_metadata").collect()
    assert run.details["output_rows"] == "1000"


def test_json_objects_of_one_long_line_are_read_in_pieces(spark, tmp_path):
    notes = ["plain", "}{", '"', "\\", '\\"}', "", "{" * 9, "ü}" * 40]
    features = [
        {"type": "Feature", "properties": {"Beat": f"z{i}", "note": notes[i % len(notes)], "deep": {"a": {"b": i}}},
         "geometry": {"type": "Polygon", "coordinates": [[[i, 0.5], [1, 2], [i, 3]]]}}
        for i in range(500)
    ]
    whole = {"type": "FeatureCollection", "meta{": 'x"}{', "crs": {"p": {"n": "}"}}, "features": features, "end": {"q": 1}}
    (tmp_path / "one.json").write_text("\ufeff" + json.dumps(whole, ensure_ascii=False))
    (tmp_path / "two.json").write_text(json.dumps(whole, indent=1) + "\n")
    (tmp_path / "none.json").write_text(json.dumps({"type": "FeatureCollection", "features": []}))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        objects = readers.read_json_objects(spark, str(tmp_path)).collect()
        read = readers.read_geojson(spark, str(tmp_path)).collect()
        split = spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert split > 20
    want = [whole["crs"], *features, whole["end"]]
    for name in ("one", "two"):
        own = sorted((o.number, o.text) for o in objects if o.source_file.endswith(f"{name}.json"))
        assert [json.loads(t) for _, t in own] == want
    assert len(objects) == 2 * len(want)
    assert sorted((r.zone_id, r.properties["note"]) for r in read) == sorted(2 * [(f"Z{i}", notes[i % len(notes)]) for i in range(500)])
