"""Audit of duplicate event ids: what differs inside each group of copies.

Whether a family of fields differs is read from the lowest and highest hash of
the family, two fixed-width aggregates that are combined before the shuffle.
No list of copies is ever built, however large a group is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zoneflow.functions import text as tx
from zoneflow.functions.numeric import safe_divide
from zoneflow.functions.time import iso_text, parse_timestamp
from zoneflow.operators import schema
from zoneflow.operators.cleaning import CATEGORY_SOURCES, KEY_FIELDS, TEXT_FIELDS, add_category

# The fields compared per family.
LOCATION_FIELDS = ["zone_id", "beat", "sector", "precinct", "latitude", "longitude"]
CATEGORY_FIELDS = [
    "call_type", "initial_call_type", "final_call_type", "service_category", "normalized_service_category",
]
CORE_FIELDS = ["event_id", "queued_datetime", *LOCATION_FIELDS, *CATEGORY_FIELDS, "disposition"]
FAMILIES: dict[str, list[str]] = {
    "core": CORE_FIELDS,
    "timestamp": ["queued_datetime"],
    "location": LOCATION_FIELDS,
    "category": CATEGORY_FIELDS,
    "disposition": ["disposition"],
}
CONFLICTS = ["timestamp", "location", "category", "disposition"]

# The reasons in the order of their letters.
EXACT = "A. exact_duplicate_all_fields"
SAME_CORE = "B. same_event_id_identical_core_fields"
SINGLE_CONFLICT = {
    "timestamp": "C. same_event_id_conflicting_timestamp",
    "location": "D. same_event_id_conflicting_location",
    "category": "E. same_event_id_conflicting_category",
    "disposition": "F. same_event_id_conflicting_disposition",
}
HISTORY = "G. possible_event_update_or_history"
FLAGS = [
    "exact_duplicate_all_fields",
    "same_event_id_identical_core_fields",
    *[f"same_event_id_conflicting_{c}" for c in CONFLICTS],
    "possible_event_update_or_history",
]
FAIL = "FAIL - current event_id-only collapse is too aggressive"
PASS = "PASS - removed duplicates are overwhelmingly exact"
TOLERATED_SHARE = 0.01
LARGEST_GROUPS, GROUPS_PER_REASON = 20, 10


def canonical_copies(raw: DataFrame, mapping: Mapping[str, str | None] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Raw records as comparable fields, with one hash over every raw column."""
    mapping = schema.resolve(raw.columns) if mapping is None else mapping
    hashed = raw.withColumn("raw_row_hash", tx.fingerprint(*[F.col(f"`{c}`") for c in raw.columns if c not in keep]))
    fields = schema.canonicalize(hashed, mapping, ("raw_row_hash", *keep))
    fields = fields.withColumns(
        {
            **{c: tx.clean_text(c) for c in TEXT_FIELDS if c != "event_id"},
            **{c: F.upper(tx.clean_text(c)) for c in KEY_FIELDS},
            "event_id": F.trim("event_id"),
            "queued_datetime": iso_text(parse_timestamp("event_datetime")),
            "latitude": F.bround(tx.to_number("latitude"), 6),
            "longitude": F.bround(tx.to_number("longitude"), 6),
        }
    )
    fields = fields.withColumn("zone_id", F.coalesce("beat", F.lit(tx.UNKNOWN_ZONE)))
    return add_category(fields, *CATEGORY_SOURCES).select(*CORE_FIELDS, "raw_row_hash", *keep)


def _reason() -> Column:
    conflicts = F.col("conflict_type_count")
    out = F.when(F.col(FLAGS[0]), EXACT).when(F.col(FLAGS[1]), SAME_CORE).when(conflicts > 1, HISTORY)
    for family, label in SINGLE_CONFLICT.items():
        out = out.when(F.col(f"same_event_id_conflicting_{family}"), label)
    return out.otherwise(HISTORY)


def groups(copies: DataFrame) -> DataFrame:
    """One row per event id seen more than once: size, what differs, and the reason class."""
    hashes = {"raw": F.col("raw_row_hash"), **{f: tx.fingerprint(*cols) for f, cols in FAMILIES.items()}}
    hashed = copies.select("event_id", *[h.alias(f) for f, h in hashes.items()])
    sized = (
        hashed.groupBy("event_id")
        .agg(
            F.count(F.lit(1)).alias("duplicate_group_size"),
            *[(F.min(f) != F.max(f)).alias(f"_{f}") for f in hashes],
        )
        .filter("duplicate_group_size > 1")
    )
    count = sum((F.col(f"_{c}").cast("int") for c in CONFLICTS), F.lit(0))
    exact, same_core = ~F.col("_raw"), F.col("_raw") & ~F.col("_core")
    return (
        sized.withColumns(
            {
                "observed_rows_in_audit_pass": F.col("duplicate_group_size"),
                "rows_beyond_first": F.col("duplicate_group_size") - 1,
                FLAGS[0]: exact,
                FLAGS[1]: same_core,
                **{f"same_event_id_conflicting_{c}": F.col(f"_{c}") for c in CONFLICTS},
                "conflict_type_count": count,
                FLAGS[-1]: ~exact & ~same_core & ((count > 1) | F.col("_core")),
            }
        )
        .withColumn("duplicate_reason", _reason())
        .select(
            "event_id", "duplicate_group_size", "observed_rows_in_audit_pass", "rows_beyond_first", *FLAGS,
            "conflict_type_count", "duplicate_reason",
        )
    )


def reason_counts(audited: DataFrame) -> DataFrame:
    """Groups and surplus rows per reason."""
    return audited.groupBy("duplicate_reason").agg(
        F.count(F.lit(1)).alias("event_ids"), F.sum("rows_beyond_first").alias("rows_beyond_first")
    )


def flag_counts(audited: DataFrame) -> DataFrame:
    """Groups and surplus rows per flag; flags overlap.  One pass, one row per flag."""
    totals = audited.agg(
        *[F.count(F.when(F.col(f), 1)).alias(f"n_{f}") for f in FLAGS],
        *[F.coalesce(F.sum(F.when(F.col(f), F.col("rows_beyond_first"))), F.lit(0)).alias(f"r_{f}") for f in FLAGS],
    )
    entries = F.array(
        *[
            F.struct(F.lit(f).alias("category"), F.col(f"n_{f}").alias("event_ids"), F.col(f"r_{f}").alias("rows_beyond_first"))
            for f in FLAGS
        ]
    )
    return totals.select(F.inline(entries))


def verdict(audited: DataFrame) -> DataFrame:
    """One row of totals with the pass or fail status of collapsing on the event id alone."""
    beyond = F.col("rows_beyond_first")
    conflicting = F.lit(False)
    for flag in FLAGS[2:]:
        conflicting = conflicting | F.col(flag)

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0))

    out = audited.agg(
        F.count(F.lit(1)).alias("duplicated_event_ids"),
        total("duplicate_group_size").alias("rows_in_groups"),
        total(beyond).alias("rows_beyond_first"),
        F.coalesce(F.max("duplicate_group_size"), F.lit(0)).alias("largest_group"),
        total(F.when(~F.col(FLAGS[0]), beyond)).alias("non_exact_rows"),
        total(F.when(conflicting, beyond)).alias("conflicting_rows"),
    ).withColumn("non_exact_share", safe_divide("non_exact_rows", "rows_beyond_first"))
    failed = (F.col("non_exact_share") > TOLERATED_SHARE) | (F.col("conflicting_rows") > 0)
    return out.withColumn("status", F.when(failed, FAIL).otherwise(PASS))


def largest_groups(audited: DataFrame, n: int = LARGEST_GROUPS) -> DataFrame:
    return audited.orderBy(F.desc("duplicate_group_size"), "event_id").limit(n)


def sample_groups(audited: DataFrame) -> DataFrame:
    """The 20 largest groups and the 10 largest of each reason.

    The rank filter lets Spark keep ten rows per reason in every task before
    the shuffle.
    """
    by_reason = W.partitionBy("duplicate_reason").orderBy(F.desc("duplicate_group_size"), "event_id")
    per_reason = audited.withColumn("_rank", F.row_number().over(by_reason)).filter(
        F.col("_rank") <= GROUPS_PER_REASON
    )
    return largest_groups(audited).unionByName(per_reason.drop("_rank")).distinct()


def samples(copies: DataFrame, audited: DataFrame) -> DataFrame:
    """Every copy in the sampled groups, with the labels of its group.

    The sampled groups number at most 20 + 10 per reason, 90 in all, so they are
    broadcast; the copies themselves stay where they are.
    """
    labels = sample_groups(audited).select("event_id", "duplicate_group_size", "duplicate_reason", *FLAGS)
    return copies.join(F.broadcast(labels), "event_id").orderBy(
        F.desc("duplicate_group_size"), "event_id", "source_row_number"
    )
