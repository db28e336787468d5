"""Readers for raw event extracts, hourly weather, zone lookups, polygons and reports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zoneflow.functions import text as tx
from zoneflow.functions.time import floor_hour
from zoneflow.operators import schema
from zoneflow.operators.collapse import keep_first
from zoneflow.operators.enrich import WEATHER_COLUMNS
from zoneflow.operators.sizing import cut_lineage

SAMPLE_ROWS = 100
BYTE_ORDER_MARK = "\ufeff"
# Texts read as missing in a raw extract.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]
FEATURE_SCHEMA = "type string, properties map<string, string>, geometry struct<type: string, coordinates: string>"
# The rest of quoted text, and text before a brace that stands outside quoted text with that brace.
UP_TO_QUOTE = r'^(?:[^"\\]++|\\.)*+"'
UP_TO_BRACE = r'^(?:[^"{]++|"(?:[^"\\]++|\\.)*+")*+[{]'


def read_csv_text(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """CSV with a header, every column as text; a byte order mark in the first name is dropped."""
    df = spark.read.options(header=True, inferSchema=False, escape='"', **options).csv(path)
    return df.toDF(*[c.removeprefix(BYTE_ORDER_MARK) for c in df.columns])


def read_events(
    spark: SparkSession,
    path: str | list[str],
    columns: Iterable[str] | None = None,
    rows: int | None = None,
    missing: bool = True,
    position: bool = False,
) -> DataFrame:
    """Raw event extract as text columns.

    ``columns`` prunes the scan, ``rows`` caps it for a trial run, ``missing``
    turns the usual missing-value texts into null, and ``position`` adds
    :func:`source_position` as ``source_file`` and ``source_row``.
    """
    df = read_csv_text(spark, path)
    place = source_position() if position else {}
    names = list(df.columns if columns is None else columns)
    df = df.select(*[F.col(f"`{c}`") for c in names], *[c.alias(n) for n, c in place.items()])
    if missing:
        df = df.withColumns({c: F.when(~F.col(f"`{c}`").isin(MISSING_TEXTS), F.col(f"`{c}`")) for c in names})
    return df if rows is None else df.limit(rows)


def source_position() -> dict[str, Column]:
    """File and sortable position of a row in it, for the scan of a text file.

    Within a file, rows order by the start of their block and then by the running
    id, which rises along each block.  Nothing is shuffled to get it.
    """
    return {
        "source_file": F.col("_metadata.file_path"),
        "source_row": F.struct(
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id")
        ),
    }


def numbered_rows(df: DataFrame) -> DataFrame:
    """Turn the position into the exact row number inside each file, from 1.

    Only the blocks of a file are counted and summed up, one row per block; the
    rows themselves are not sorted.
    """
    block = F.col("source_row.block")
    spans = df.groupBy("source_file", block.alias("_block")).agg(
        F.min("source_row.id").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    earlier = W.partitionBy("source_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    spans = spans.select(
        "source_file", "_block", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    placed = df.withColumn("_block", block).join(spans, ["source_file", "_block"])
    number = F.col("_offset") + F.col("source_row.id") - F.col("_first") + 1
    return placed.withColumn("source_row_number", number).drop("_block", "_first", "_offset", "source_row")


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Hourly weather CSV behind a preamble: the header is the first line that starts with ``time,``.

    Only the header line comes to the driver.  Lines after it are split on the
    executors.  The first row of an hour is kept.
    """
    lines = spark.read.text(path).select("value", *[c.alias(n) for n, c in source_position().items()])
    lines = lines.withColumn("value", F.regexp_replace("value", BYTE_ORDER_MARK, ""))
    starts = lines.filter(F.lower("value").startswith("time,"))
    headers = starts.groupBy("source_file").agg(
        F.min_by("value", "source_row").alias("header"), F.min("source_row").alias("header_row")
    )
    names = [r.header for r in headers.select("header").distinct().limit(2).collect()]
    if len(names) != 1:
        raise ValueError(f"expected one kind of header line starting with 'time,' in {path}, found {len(names)}")
    columns = [schema.weather_name(c) for c in names[0].split(",")]
    body = lines.join(headers.select("source_file", "header_row"), "source_file")
    body = body.filter((F.col("source_row") > F.col("header_row")) & (F.trim("value") != ""))
    fields = F.from_csv("value", ", ".join(f"`{c}` string" for c in columns))
    typed = body.select("source_file", "source_row", fields.alias("f")).select("source_file", "source_row", "f.*")
    typed = schema.fill_missing(typed, {c: "string" for c in WEATHER_COLUMNS})
    hourly = typed.select(
        floor_hour(F.trim("time").try_cast("timestamp_ntz")).alias("weather_hour"),
        *[tx.nan_to_null(F.col(c).try_cast("double")).alias(c) for c in WEATHER_COLUMNS],
        "source_file",
        "source_row",
    )
    first = keep_first(hourly, ["weather_hour"], ["source_file", "source_row"])
    return first.drop("source_file", "source_row")


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with normalized names and keys; needs a ``beat`` column."""
    zones = schema.rename_with(read_csv_text(spark, path), schema.lookup_name)
    schema.require_columns(zones, ["beat"])
    precinct = next((c for c in ("first_precinct", "precinct") if c in zones.columns), None)
    zones = zones.withColumns(
        {
            "zone_id": tx.upper_key("beat"),
            "precinct": F.upper(precinct) if precinct else F.lit(None).cast("string"),
            "sector": F.upper("sector") if "sector" in zones.columns else F.lit(None).cast("string"),
        }
    ).withColumn("beat", F.col("zone_id"))
    wanted = ["zone_id", "beat", "precinct", "sector", "shape_area", "shape_length", "objectid"]
    return zones.select(*[c for c in wanted if c in zones.columns])


def _sum_before(pieces: DataFrame, measure: Column, name: str) -> DataFrame:
    """Add the sum of a measure over all earlier pieces of a file: sums inside blocks, shifted by totals per block."""
    place, earlier = W.partitionBy("source_file", "block"), (W.unboundedPreceding, -1)
    measured = pieces.withColumn("_measure", measure)
    totals = measured.groupBy("source_file", "block").agg(F.sum("_measure").alias("_total"))
    shift = F.sum("_total").over(W.partitionBy("source_file").orderBy("block").rowsBetween(*earlier))
    totals = totals.select("source_file", "block", F.coalesce(shift, F.lit(0)).alias("_shift"))
    inside = F.coalesce(F.sum("_measure").over(place.orderBy("id").rowsBetween(*earlier)), F.lit(0))
    summed = measured.withColumn("_inside", inside).join(totals, ["source_file", "block"])
    return summed.withColumn(name, F.col("_inside") + F.col("_shift")).drop("_measure", "_inside", "_shift")


def read_json_objects(spark: SparkSession, path: str, depth: int = 2) -> DataFrame:
    """``source_file, number, text`` of the objects at a depth of JSON files (1 is the outermost), in file order.

    A file may be one long line: Spark splits it, and reads each split in pieces that end with a closing brace.  Whether
    a piece begins inside quoted text, and how deep, follows from counts of quotes and braces before it, summed up by
    blocks; only the pieces of one object come together.  Objects are held one at a time, never a whole file.
    """
    lines = spark.read.option("lineSep", "}").text(path)
    place = source_position()
    bare = F.regexp_replace("value", r"\\.", "")

    def outside(text: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(text, r'"[^"]*+"', ""), r'"[^"]*+$', "")

    def braces(text: Column) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit("")))

    after = F.when(F.contains(bare, F.lit('"')), F.regexp_replace(bare, r'^[^"]*+"', "")).otherwise("")
    pieces = lines.select(
        place["source_file"].alias("source_file"), place["source_row"].alias("at"), F.replace("value", F.lit(BYTE_ORDER_MARK), F.lit("")).alias("value"),
        (F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))).alias("quotes"),
        braces(outside(bare)).alias("opened"), braces(outside(after)).alias("opened_quoted"),
    )
    pieces = cut_lineage(pieces.select("source_file", "at.block", "at.id", "value", "quotes", "opened", "opened_quoted"))
    pieces = _sum_before(pieces, F.col("quotes"), "_quotes")
    quoted, closes = F.col("_quotes") % 2 == 1, (F.col("_quotes") + F.col("quotes")) % 2 == 0
    pieces = pieces.withColumn("opens", F.when(quoted, F.col("opened_quoted")).otherwise(F.col("opened")))
    pieces = _sum_before(pieces, F.col("opens") - closes.cast("int"), "level")
    within = (F.col("level") >= depth) | (F.col("level") + F.col("opens") >= depth)
    starts = (F.col("level") < depth) & within
    numbered = _sum_before(pieces.withColumn("starts", starts), F.col("starts").cast("int"), "_started")
    unquoted = F.when(F.col("_quotes") % 2 == 1, F.regexp_replace("value", UP_TO_QUOTE, "")).otherwise(F.col("value"))
    lead = F.aggregate(
        F.sequence(F.lit(1), F.lit(depth) - F.col("level")), unquoted, lambda t, _: F.regexp_replace(t, UP_TO_BRACE, "")
    )
    text = F.concat(F.when(F.col("starts"), F.concat(F.lit("{"), lead)).otherwise(F.col("value")), F.lit("}"))
    return (
        numbered.where(within)
        .groupBy("source_file", (F.col("_started") + F.col("starts").cast("int")).alias("number"))
        .agg(F.array_sort(F.collect_list(F.struct("block", "id", text.alias("text")))).alias("parts"))
        .select("source_file", "number", F.array_join("parts.text", "").alias("text"))
    )


def read_geojson(spark: SparkSession, path: str, zone_property: str = "beat") -> DataFrame:
    """Features of GeoJSON files of any size: ``zone_id``, geometry type, coordinates as JSON text and all properties."""
    objects = read_json_objects(spark, path).select(F.from_json("text", FEATURE_SCHEMA).alias("f"))
    shaped = F.col("f.geometry").isNotNull() | F.col("f.properties").isNotNull()
    features = objects.where((F.coalesce("f.type", F.lit("Feature")) == "Feature") & shaped)
    properties = F.transform_keys("f.properties", lambda k, v: F.lower(F.trim(k)))
    return features.select(
        tx.upper_key(properties[zone_property]).alias("zone_id"),
        F.col("f.geometry.type").alias("type"),
        F.col("f.geometry.coordinates").alias("coordinates"),
        properties.alias("properties"),
    )


def inventory(spark: SparkSession, sources: Mapping[str, str], strict: bool = False) -> DataFrame:
    """One row per source: size, last change, columns, and whether it exists and can be read as CSV with a header.

    File listings give size and time.  ``sample_rows`` counts the rows among the first ``SAMPLE_ROWS`` that parse, so
    a source costs no full read.  ``strict`` raises for missing sources.
    """
    found, missing = None, []
    for name, path in sources.items():
        try:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        except AnalysisException:
            missing.append(name)
            continue
        try:
            content = spark.read.option("header", True).option("recursiveFileLookup", True).csv(path)
            columns, sample = content.columns, content.limit(SAMPLE_ROWS).count()
        except (AnalysisException, SparkRuntimeException):
            columns, sample = [], None
        row = files.agg(
            F.lit(name).alias("source"), F.lit(path).alias("path"), F.lit(True).alias("exists"),
            F.count(F.lit(1)).alias("files"), F.sum("length").alias("size_bytes"),
            F.max("modificationTime").cast("string").alias("last_modified"),
            F.lit(bool(columns)).alias("readable"), F.lit(", ".join(columns) or None).alias("columns"),
            F.lit(sample).cast("long").alias("sample_rows"),
        )
        found = row if found is None else found.unionAll(row)
    if missing and strict:
        raise FileNotFoundError("missing sources: " + ", ".join(f"{n} ({sources[n]})" for n in missing))
    columns = "source string, path string, exists boolean, files long, size_bytes long, last_modified string, readable boolean, columns string, sample_rows long"
    absent = spark.createDataFrame([(n, sources[n], False, None, None, None, False, None, None) for n in missing], columns)
    listed = absent if found is None else found.unionAll(absent)
    return listed.withColumn("size_readable", tx.human_size("size_bytes"))


def report_metrics(spark: SparkSession, path: str, labels: Iterable[str]) -> DataFrame:
    """Values behind labels in text reports, one row per label found, the first line winning."""
    lines = spark.read.text(path).select("value", *[c.alias(n) for n, c in source_position().items()])
    values = F.filter(
        F.array(*[F.struct(F.lit(n).alias("label"), tx.report_value("value", n).alias("text")) for n in labels]),
        lambda e: e["text"].isNotNull(),
    )
    found = lines.select("source_file", "source_row", F.inline(values))
    first = keep_first(found, ["label"], ["source_file", "source_row"])
    number = F.regexp_replace("text", "[,%]", "").try_cast("double")
    return first.select(
        "label", "text", F.when(F.col("text").endswith("%"), number / 100).otherwise(number).alias("number")
    )


def optional_table(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """Parquet table, or an empty one of the given columns when there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], columns)
