"""The event model derived from the given TPC-H-like tables.

Every frame here is computed by Spark from the tables in a folder, so its size
follows theirs.  ``events`` plays the service events, ``nation`` and ``region``
the zone lookup, ``orders`` and ``customer`` the events of several years.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.functions import text as tx
from zoneflow.functions.time import floor_hour
from zoneflow.operators import enrich, zonehour
from zoneflow.operators.cleaning import CLEAN_COLUMNS, add_category

FIRST_DAY = "2024-01-01"
REPORTED_DAYS = 20  # on later days of a month the weather station leaves its measures empty
KNOWN_ZONES = 7     # zones Z00..Z06 have a sector and a precinct in the lookup, the others have none


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def zone_code(number: Column) -> Column:
    return F.concat(F.lit("Z0"), number.cast("string"))


def service_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a beat, a category, a disposition from JSON and a position."""
    e = table(spark, folder, "events")
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").alias("event_datetime"),
        F.when(F.col("user_id") % 50 != 49, zone_code(F.col("user_id") % 8)).alias("beat"),
        F.col("event_type").alias("final_call_type"),
        F.when(F.col("event_id") % 97 != 0, F.get_json_object("props", "$.k")).alias("disposition"),
        F.when(F.col("event_id") % 31 != 0, 47.5 + (F.col("user_id") % 100) / 1000).alias("latitude"),
        F.when(F.col("event_id") % 31 != 0, -122.4 + (F.col("user_id") % 70) / 1000).alias("longitude"),
        "value",
        F.col("props").alias("raw_props"),
    )


def cleaned_events(spark: SparkSession, folder: str) -> DataFrame:
    """Service events in the 17-column cleaned layout."""
    events = add_category(service_events(spark, folder), "final_call_type")
    category = F.col("normalized_service_category")
    events = events.withColumns(
        {
            "zone_id": F.coalesce("beat", F.lit(tx.UNKNOWN_ZONE)),
            "data_quality_flag": tx.quality_flag(F.col("event_datetime"), F.col("beat"), category),
        }
    )
    absent = {c: F.lit(None).cast("string") for c in CLEAN_COLUMNS if c not in events.columns}
    return events.withColumns(absent).select(*CLEAN_COLUMNS)


def weather(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly weather for the event hours, measures by arithmetic on the hour, empty on the last days of a month."""
    hours = table(spark, folder, "events").select(floor_hour("ts").alias("weather_hour")).distinct()
    reported = F.dayofmonth("weather_hour") <= REPORTED_DAYS
    n = F.datediff(F.col("weather_hour").cast("date"), F.lit(FIRST_DAY).cast("date")) * 24 + F.hour("weather_hour")
    rain = F.when(n % 4 == 0, (n % 37) / F.lit(3.0)).otherwise(0.0)
    measures = {
        "temperature_2m": F.when(n % 97 != 0, (n * 7 % 350) / F.lit(10.0) - 5),
        "relative_humidity_2m": (n % 50 + 40).cast("double"),
        "precipitation": rain,
        "rain": rain * 0.8,
        "snowfall": F.when(n % 50 == 0, 1.5).otherwise(0.0),
        "weather_code": (n % 5).cast("double"),
        "wind_speed_10m": F.when(n % 53 != 0, (n % 23) * F.lit(0.5)),
    }
    return hours.select("weather_hour", *[F.when(reported, m).alias(c) for c, m in measures.items()])


def zone_lookup(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    known = F.col("n_nationkey") < KNOWN_ZONES
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        zone_code(F.col("n_nationkey")).alias("zone_id"),
        F.when(known, F.col("n_name")).alias("sector"),
        F.when(known, F.col("r_name")).alias("precinct"),
    )


def fact(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.build_fact(
        cleaned_events(spark, folder), weather(spark, folder), zone_lookup(spark, folder)
    )


def zone_hour(spark: SparkSession, folder: str, **options) -> DataFrame:
    return zonehour.build(fact(spark, folder), **options)


def order_events(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as events over several years: zone from the customer's nation, category from the priority."""
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    zone = zone_code(F.col("c_nationkey") % 8)
    events = joined.select(
        F.col("o_orderkey").cast("string").alias("event_id"),
        F.col("o_orderdate").alias("event_datetime"),
        zone.alias("zone_id"),
        zone.alias("beat"),
        F.col("o_orderpriority").alias("final_call_type"),
        F.lit("ok").alias("data_quality_flag"),
    )
    events = add_category(events, "final_call_type")
    absent = {c: F.lit(None).cast("string") for c in CLEAN_COLUMNS if c not in events.columns}
    events = events.withColumns(absent)
    return events.withColumns({c: F.col(c).cast("double") for c in ("latitude", "longitude")}).select(*CLEAN_COLUMNS)


def order_fact(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.build_fact(order_events(spark, folder), weather(spark, folder), zone_lookup(spark, folder))


def order_zone_hour(spark: SparkSession, folder: str, **options) -> DataFrame:
    return zonehour.build(order_fact(spark, folder), **options)


def copied_events(spark: SparkSession, folder: str) -> DataFrame:
    """Service events plus altered copies of some, one kind of change per class of duplicate."""
    first = service_events(spark, folder).withColumn("source_row_number", F.lit(1))
    kind = F.col("event_id").cast("long") % 40
    later = F.col("event_datetime") + F.expr("interval 1 minute")
    copies = first.filter(kind <= 6).withColumns(
        {
            "raw_props": F.when(kind == 1, F.concat("raw_props", F.lit(" "))).otherwise(F.col("raw_props")),
            "event_datetime": F.when(kind.isin(2, 6), later).otherwise(F.col("event_datetime")),
            "beat": F.when(kind == 3, "Z99").otherwise(F.col("beat")),
            "final_call_type": F.when(kind.isin(4, 6), "moved").otherwise(F.col("final_call_type")),
            "disposition": F.when(kind == 5, "x").otherwise(F.col("disposition")),
            "source_row_number": F.lit(2),
        }
    )
    return first.unionByName(copies)


def raw_records(spark: SparkSession, folder: str) -> DataFrame:
    """Service events as a messy raw extract: other headers, three time formats, stray case and spaces."""
    e = service_events(spark, folder)
    n = F.col("event_id").cast("long")
    ts, d = F.col("event_datetime"), F.col("event_datetime").cast("date").cast("string")
    part = {name: F.lpad(c.cast("string"), 2, "0") for name, c in {
        "month": F.month(ts), "day": F.dayofmonth(ts), "hour12": (F.hour(ts) + 11) % 12 + 1,
        "minute": F.minute(ts), "second": F.second(ts).cast("int"), "hour": F.hour(ts),
    }.items()}
    half = F.when(F.hour(ts) < 12, "AM").otherwise("PM")
    clock12 = F.concat(part["hour12"], F.lit(":"), part["minute"], F.lit(":"), part["second"], F.lit(" "), half)
    slashed = F.concat(part["month"], F.lit("/"), part["day"], F.lit("/"), F.year(ts).cast("string"), F.lit(" "), clock12)
    named = F.concat(F.year(ts).cast("string"), F.lit(" Jan "), part["day"], F.lit(" "), clock12)
    iso = F.concat(d, F.lit(" "), part["hour"], F.lit(":"), part["minute"], F.lit(":"), part["second"])
    queued = F.when(n % 5 == 0, slashed).when(n % 5 == 1, named).when(n % 5 == 2, "not a time").otherwise(iso)
    queued = F.when((n % 5 == 1) & (F.month(ts) != 1), iso).otherwise(queued)
    return e.select(
        F.concat(F.lit(" "), F.col("event_id")).alias("CAD Event Number"),
        queued.alias("CAD Event Original Time Queued"),
        F.concat(F.lower("beat"), F.lit("  ")).alias("Dispatch Beat"),
        F.when(n % 7 == 0, "nan").otherwise(F.concat(F.upper("final_call_type"), F.lit("-  o'neil/7-eleven"))).alias(
            "Final Call Type"
        ),
        F.when(n % 3 == 0, F.concat(F.lit("dv  -no "), F.col("final_call_type"))).alias("Event Group"),
        F.col("disposition").alias("CAD Event Clearance Description"),
        F.when(n % 11 == 0, "1,047.5").when(n % 11 == 1, "REDACTED").otherwise(F.col("latitude").cast("string")).alias(
            "Dispatch Latitude"
        ),
    )


def keyed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines, whose (order, line) key repeats, as input for the collapse of duplicates."""
    return table(spark, folder, "lineitem")


def _square(x: Column, y: Column, side: Column) -> Column:
    """Closed ring of a square with its lower left corner at (x, y), as JSON text."""
    corners = [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]
    points = [F.concat(F.lit("["), a.cast("string"), F.lit(","), b.cast("string"), F.lit("]")) for a, b in corners]
    return F.concat(F.lit("["), F.concat_ws(",", *points), F.lit("]"))


def customer_polygons(spark: SparkSession, folder: str) -> DataFrame:
    """One geometry per customer: squares, squares with a hole, and pairs of squares."""
    c = table(spark, folder, "customer")
    key = F.col("c_custkey")
    x, y = (key % 100).cast("double"), (F.col("c_nationkey") * 5).cast("double")
    side = (F.col("c_nationkey") + 4).cast("double")
    outer, far = _square(x, y, side), _square(x + 200, y, side)
    hole = _square(x + 1, y + 1, F.lit(2.0))
    kind = key % 3

    def wrap(text: Column) -> Column:
        return F.concat(F.lit("["), text, F.lit("]"))

    both = wrap(F.concat_ws(",", wrap(outer), wrap(far)))
    with_hole = wrap(F.concat_ws(",", outer, hole))
    return c.select(
        F.concat(F.lit("C"), key.cast("string")).alias("zone_id"),
        F.when(kind == 2, "MultiPolygon").otherwise("Polygon").alias("type"),
        F.when(kind == 0, wrap(outer)).when(kind == 1, with_hole).otherwise(both).alias("coordinates"),
    )


def zone_polygons(spark: SparkSession, folder: str) -> DataFrame:
    """Zones of the lookup that have a sector, plus one the events never reach, as polygon keys."""
    nation = zone_lookup(spark, folder).where("sector is not null")
    return nation.select("zone_id").unionAll(
        nation.agg(F.lit("Z99").alias("zone_id"))
    )


def _stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """File stream over a table, which may be one file or a folder of files."""
    schema = table(spark, folder, name).schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]")  # a stream takes a file by pattern only


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a file stream with their zone."""
    return _stream(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").alias("event_datetime"),
        zone_code(F.col("user_id") % 8).alias("zone_id"),
        F.col("event_type").alias("final_call_type"),
    )


def line_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as a file stream."""
    return _stream(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
