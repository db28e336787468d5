"""Clean raw event records into the 17-column event table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions import text as tx
from zoneflow.functions.time import parse_timestamp
from zoneflow.operators import schema

# Columns of a cleaned event, and those that are cleaned as text, as keys, for the category and the score.
CLEAN_COLUMNS = [
    "event_id", "event_datetime", "call_type", "initial_call_type", "final_call_type", "service_category",
    "normalized_service_category", "disposition", "zone_id", "beat", "sector", "precinct", "latitude",
    "longitude", "neighborhood", "reporting_area", "data_quality_flag",
]
TEXT_FIELDS = [
    "event_id", "call_type", "initial_call_type", "final_call_type", "service_category", "disposition",
    "neighborhood", "reporting_area",
]
KEY_FIELDS = ["beat", "sector", "precinct"]
CATEGORY_SOURCES = ["service_category", "final_call_type", "initial_call_type", "call_type"]
SCORED_COLUMNS = [
    "event_datetime", "zone_id", "beat", "sector", "precinct", "latitude", "longitude",
    "normalized_service_category", "disposition",
]


def add_category(df: DataFrame, *candidates: str) -> DataFrame:
    """Add the normalized category of the first present candidate.

    Two steps, so that the spaced text is worked out once and not at each of
    its uses inside the title case.
    """
    name = "normalized_service_category"
    spaced = df.withColumn(name, tx.category_text(*candidates))
    return spaced.withColumn(name, tx.category_title(name))


def _own_text(raw: DataFrame, keep) -> Column:
    """What tells a record without an id from others: its place in the source if known.

    Without a place all fields and a number that Spark gives the row; equal records then stay apart, but the id may
    differ from one run to the next.
    """
    place = [c for c in ("source_file", "source_row") if c in keep and c in raw.columns]
    fields = F.to_json(F.struct(*[F.col(f"`{c}`") for c in place or raw.columns]))
    return fields if place else F.concat(fields, F.monotonically_increasing_id().cast("string"))


def clean_events(
    raw: DataFrame,
    mapping: Mapping[str, str | None] | None = None,
    keep: tuple[str, ...] = (),
    flag_zone_before_fill: bool = True,
) -> DataFrame:
    """Resolve, parse and normalize raw records; the input columns named in ``keep`` stay.

    With ``flag_zone_before_fill=False`` a missing zone is not flagged, because
    its default is already in place when the flag is built.
    """
    mapping = schema.resolve(raw.columns) if mapping is None else mapping
    generated = "_own"
    events = schema.canonicalize(raw.withColumn(generated, F.sha2(_own_text(raw, keep), 256)), mapping, [*keep, generated])
    events = events.withColumns(
        {
            **{c: tx.clean_text(c) for c in TEXT_FIELDS},
            **{c: F.upper(tx.clean_text(c)) for c in KEY_FIELDS},
            "event_datetime": parse_timestamp("event_datetime"),
            "latitude": tx.to_number("latitude"),
            "longitude": tx.to_number("longitude"),
        }
    )
    named = F.nullif(F.trim(F.col("event_id").cast("string")), F.lit(""))
    events = events.withColumn("event_id", F.coalesce(named, F.concat(F.lit("generated_"), F.col(generated))))
    events = events.withColumn("zone_id", F.coalesce("beat", F.lit(tx.UNKNOWN_ZONE)))
    events = add_category(events, *CATEGORY_SOURCES)
    flagged_zone = "beat" if flag_zone_before_fill else "zone_id"
    return events.withColumn(
        "data_quality_flag",
        tx.quality_flag(F.col("event_datetime"), F.col(flagged_zone), F.col("normalized_service_category")),
    ).select(*CLEAN_COLUMNS, *keep)


def completeness_score() -> Column:
    """How many of the nine scored fields of a cleaned event hold a value."""
    return tx.completeness(*SCORED_COLUMNS)
