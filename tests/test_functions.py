import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from zoneflow.functions import numeric as nu
from zoneflow.functions import text as tx
from zoneflow.functions import time as tm


def one(spark, column, **fields):
    """Value of a column expression over one row of text or number fields."""
    types = {str: "string", int: "long", float: "double", bool: "boolean", datetime: "timestamp_ntz", date: "date"}
    schema = ", ".join(f"{n} {types[type(v)] if v is not None else 'string'}" for n, v in fields.items())
    return spark.createDataFrame([tuple(fields.values())], schema).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "raw, clean", [("  a \t b\n", "a b"), ("", None), ("nan", None), ("<NA>", None), ("  ", None), ("NaN", "NaN"), (None, None)]
)
def test_clean_text(spark, raw, clean):
    assert one(spark, tx.clean_text("x"), x=raw) == clean


@pytest.mark.parametrize(
    "raw", ["dv - no/assault 7-eleven o'neil", "ALL CAPS", "mixed cASE word", "a1b2c3", "-lead", "été/ÉTÉ", "", "x"]
)
def test_title_case_matches_python(spark, raw):
    assert one(spark, tx.title_case("x"), x=raw) == raw.title()


def test_category(spark):
    df = spark.createDataFrame(
        [("dv-no  assault", "x"), (None, "b/c -d"), (None, None)], "a string, b string"
    )
    found = [r.v for r in df.select(tx.normalize_category("a", "b").alias("v")).collect()]
    assert found == ["Dv - No Assault", "B/C - D", "Uncategorized"]


@pytest.mark.parametrize("raw, number", [("1,234.5", 1234.5), ("REDACTED", None), ("nan", None), (" 7 ", 7.0), (None, None)])
def test_to_number(spark, raw, number):
    assert one(spark, tx.to_number("x"), x=raw) == number


def test_quality_flag(spark):
    df = spark.createDataFrame(
        [(None, None, "Uncategorized"), ("t", "z", "C"), ("t", None, "C")], "t string, z string, c string"
    )
    flags = df.select(tx.quality_flag(F.col("t"), F.col("z"), F.col("c")).alias("v")).collect()
    assert [r.v for r in flags] == ["missing_datetime;missing_zone;missing_category", "ok", "missing_zone"]


def test_fingerprint_separates_fields_and_nulls(spark):
    rows = [("ab", "c"), ("a", "bc"), (None, "abc"), ("abc", None), (None, None)]
    df = spark.createDataFrame(rows, "a string, b string").select(tx.fingerprint("a", "b").alias("h"))
    assert df.distinct().count() == len(rows)


@pytest.mark.parametrize(
    "uri, host",
    [
        ("mongodb+srv://user:secret@cluster0.example.net/db", "cluster0.example.net"),
        ("https://example.org:8080/x", "example.org"),
        ("nothing", "unknown-host"),
        (None, "unknown-host"),
    ],
)
def test_uri_host_hides_credentials(spark, uri, host):
    assert one(spark, tx.uri_host("x"), x=uri) == host


@pytest.mark.parametrize(
    "size, label", [(0, "0.00 B"), (1023, "1,023.00 B"), (1536, "1.50 KB"), (5 * 1024**3, "5.00 GB"), (3000 * 1024**4, "3,000.00 TB")]
)
def test_human_size(spark, size, label):
    assert one(spark, tx.human_size("x"), x=size) == label


@pytest.mark.parametrize(
    "n, label", [(1_250_000.0, "1.25M"), (12_300.0, "12.3K"), (999.0, "999"), (-2000.0, "-2.0K"), (None, "Unavailable")]
)
def test_compact_count(spark, n, label):
    assert one(spark, tx.compact_count(F.col("x").cast("double")), x=n) == label


def test_text_formats(spark):
    assert one(spark, tx.integer_text("x"), x=1234567) == "1,234,567"
    assert one(spark, tx.percent_text("x"), x=0.2515) == "25.15%"
    assert one(spark, tx.report_int("x", "Fact output rows"), x="- Fact output rows: `6,471,289`") == 6471289
    assert one(spark, tx.report_percent("x", "Weather join coverage"), x="- Weather join coverage: `25.15%`") == pytest.approx(0.2515)
    assert one(spark, tx.report_value("x", "Other"), x="- Fact output rows: `1`") is None
    assert [one(spark, tx.to_bool("x"), x=v) for v in ("TRUE", "1", "yes", "Y", "no", None)] == [True] * 4 + [False] * 2


@pytest.mark.parametrize(
    "text, parsed",
    [
        ("06/02/2009 03:43:08 AM", datetime(2009, 6, 2, 3, 43, 8)),
        ("12/31/2020 12:00:00 AM", datetime(2020, 12, 31)),
        ("1/5/2020 12:30:00 pm", datetime(2020, 1, 5, 12, 30)),
        ("2026 Jul 04 01:02:03 PM", datetime(2026, 7, 4, 13, 2, 3)),
        (" 2024-01-05 01:02:03 ", datetime(2024, 1, 5, 1, 2, 3)),
        ("2024-01-05T01:02", datetime(2024, 1, 5, 1, 2)),
        ("2021-03-14 02:30:00", datetime(2021, 3, 14, 2, 30)),  # inside a daylight saving gap
        ("03/14/2021 02:30:00 AM", datetime(2021, 3, 14, 2, 30)),
        ("02/30/2021 01:00:00 AM", None),
        ("13/01/2021 01:00:00 AM", None),
        ("01/01/2021 13:00:00 PM", None),
        ("2026 Foo 04 01:02:03 PM", None),
        ("xx", None),
        (None, None),
    ],
)
def test_parse_timestamp(spark, zone, text, parsed):
    assert one(spark, tm.parse_timestamp("x"), x=text) == parsed


def test_hours_ignore_the_session_zone(spark, zone):
    t = datetime(2021, 3, 14, 2, 59, 59)
    assert one(spark, tm.floor_hour("t"), t=t) == datetime(2021, 3, 14, 2)
    assert one(spark, tm.hour_of("d", "3"), d=date(2024, 3, 10)) == datetime(2024, 3, 10, 3)
    assert one(spark, tm.instant_to_ntz(tm.ntz_to_instant("t")), t=t) == t
    assert one(spark, tm.iso_text("t"), t=t) == "2021-03-14 02:59:59"
    assert one(spark, tm.epoch_seconds("t"), t=t) == int((t - datetime(1970, 1, 1)).total_seconds())


def test_calendar(spark, zone):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 15, 9),), (datetime(2024, 1, 16, 17, 59),), (datetime(2024, 6, 22, 18),), (None,)],
        "event_datetime timestamp_ntz",
    )
    rows = tm.add_calendar(df).orderBy(F.col("event_datetime").asc_nulls_last()).collect()
    assert [r.weekday_name for r in rows] == ["Monday", "Tuesday", "Saturday", None]
    assert [r.is_holiday for r in rows] == [True, False, False, None]
    assert [r.is_business_hour for r in rows] == [False, True, False, None]
    assert [r.is_after_hours for r in rows] == [True, False, True, None]
    assert [r.season for r in rows] == ["Winter", "Winter", "Summer", None]
    assert [(r.month_name, r.quarter, r.weekday) for r in rows][2] == ("June", 2, 5)


def test_holidays_match_the_calendar(spark):
    from zoneflow.plans.oracle import _holiday_list

    listed = {date.fromisoformat(p[7:17]) for p in _holiday_list(1999, 2041).split(", ")}
    expected = {d for d in listed if 2000 <= d.year <= 2040}
    found = {r.holiday for r in tm.holiday_dates(spark, 2000, 2040).collect()}
    assert found == expected
    assert {date(2021, 12, 31), date(2022, 12, 26)} <= found


@pytest.mark.parametrize(
    "mm, band",
    [(0.0, "No measured precipitation"), (0.5, "Trace to 0.5 mm"), (0.50001, "0.5 to 2 mm"), (2.0, "0.5 to 2 mm"),
     (10.0, "2 to 10 mm"), (10.1, "10+ mm"), (-1.0, "nan")],
)
def test_precipitation_band(spark, mm, band):
    assert one(spark, nu.precipitation_band("p", "r"), p=mm, r=99.0) == band


@pytest.mark.parametrize("c, band", [(-3.0, "Below 0 C"), (0.0, "Below 0 C"), (5.0, "0 to 5 C"), (25.1, "25+ C"), (math.nan, "nan")])
def test_temperature_band(spark, c, band):
    assert one(spark, nu.temperature_band("t"), t=c) == band


def test_bands_of_missing_values(spark):
    df = spark.sql("select cast(null as double) t, cast(null as double) p, 3.0d r")
    row = df.select(nu.temperature_band("t"), nu.precipitation_band("p", "r"), nu.precipitation_flag("p", "t")).first()
    assert tuple(row) == ("nan", "2 to 10 mm", "no_precipitation")


def test_ratios_and_rounding(spark):
    assert one(spark, nu.safe_divide("a", "b"), a=1, b=0) == 0.0
    assert one(spark, nu.safe_divide("a", "b", None), a=1, b=0) is None
    assert one(spark, nu.clip01("a"), a=1.7) == 1.0
    assert one(spark, nu.percent("a"), a=0.123456) == 12.35
    assert one(spark, nu.risk_from_probability("a"), a=0.0025) == 0.2  # half to even
    assert one(spark, nu.temperature_bucket("a"), a=2.5) == 3.0  # half away from zero
    scale = nu.scale_0_100(F.col("a"), F.col("lo"), F.col("hi"))
    assert one(spark, scale, a=5.0, lo=5.0, hi=5.0) == 50.0
    assert one(spark, scale, a=5.0, lo=0.0, hi=20.0) == 25.0
    assert one(spark, tm.day_name("n"), n=9) == "Unknown"
