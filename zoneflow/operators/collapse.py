"""One best record per key.

The best record is found with ``max_by``, an aggregate that Spark combines
before the shuffle: each task sends one row per key, so a key that holds a third
of all rows costs no more than any other.  A window ``row_number`` next to a
group count would send, sort and buffer every copy in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLLAPSE_RULE = "max(record_completeness_score, event_datetime, source_row_number)"


def _best(df: DataFrame, key: Sequence[str], pick, order: Sequence[Column | str], extra: Sequence[Column]) -> DataFrame:
    payload = [c for c in df.columns if c not in key]
    chosen = pick(F.struct(*payload), F.struct(*order)).alias("_record")
    grouped = df.groupBy(*key).agg(chosen, *extra)
    added = [c for c in grouped.columns if c not in key and c != "_record"]
    return grouped.select(
        *[c if c in key else F.col(f"_record.{c}").alias(c) for c in df.columns], *added
    )


def collapse(
    df: DataFrame, key: Sequence[str], order: Sequence[Column | str], count_as: str | None = "duplicate_count"
) -> DataFrame:
    """Keep the record with the highest order values per key and count the copies.

    The order values compare left to right, larger first, null lowest.
    """
    extra = [F.count(F.lit(1)).alias(count_as)] if count_as else []
    return _best(df, key, F.max_by, order, extra)


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the record with the lowest order values per key."""
    return _best(df, key, F.min_by, order, [])


def collapse_events(cleaned: DataFrame, source_order: Sequence[str], audit: DataFrame | None = None) -> DataFrame:
    """Collapse cleaned events to unique ids: most complete, then latest, then last in the source.

    ``audit`` (see :func:`zoneflow.operators.audit.groups`) adds the reason of each
    duplicate group; without it the group size comes from the data itself.
    """
    from zoneflow.operators.cleaning import completeness_score

    scored = cleaned.withColumn("record_completeness_score", completeness_score())
    events = collapse(
        scored, ["event_id"], ["record_completeness_score", "event_datetime", *source_order]
    )
    if audit is None:
        reason = F.lit("duplicate_audit_not_available")
    else:
        labels = audit.select(
            "event_id",
            F.col("duplicate_group_size").alias("_audited_size"),
            F.col("duplicate_reason").alias("_audited_reason"),
        )
        events = events.join(labels, "event_id", "left")
        events = events.withColumn("duplicate_count", F.coalesce("_audited_size", F.lit(1).cast("long")))
        reason = F.coalesce("_audited_reason", F.lit("not_duplicated"))
    return events.withColumns(
        {
            "duplicate_reason": reason,
            "has_duplicate_history": F.col("duplicate_count") > 1,
            "duplicate_collapse_rule": F.lit(COLLAPSE_RULE),
        }
    ).drop("_audited_size", "_audited_reason")


def upsert(current: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[Column | str] = ()) -> DataFrame:
    """Keyed merge: a new record replaces the current one, the rest of both stays.

    Both sides go through one aggregation, so each is shuffled once.  Among new
    records with one key the highest ``order`` wins.
    """
    both = current.withColumn("_is_new", F.lit(0)).unionByName(
        new.withColumn("_is_new", F.lit(1)), allowMissingColumns=True
    )
    return collapse(both, key, ["_is_new", *order], count_as=None).drop("_is_new")
