"""URL filters with dated lists: entries become validity intervals, captures meet those active when they were fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def host_of(url: str) -> Column:
    """Lower-case host of a URL, without user and port; null where there is none."""
    found = F.regexp_extract(F.lower(F.trim(url)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.when(found != "", F.regexp_replace(found, r"\.$", ""))


def path_of(url: str) -> Column:
    """Path of a URL up to its first empty step, without query, fragment and last slash; empty where there is none."""
    path = F.regexp_extract(F.trim(url), r"^[^:]+://[^/?#]*(/[^?#]*)", 1)
    return F.coalesce(F.rtrim(F.substring_index(path, "//", 1), F.lit("/")), F.lit(""))


def page_of(url: str) -> Column:
    """Host, path and query of a URL that has a query; empty otherwise."""
    tail = F.regexp_extract(F.trim(url), r"^[^:]+://[^/?#]*([^?#]*[?][^#]*)", 1)
    return F.coalesce(F.when(tail != "", F.concat(host_of(url), tail)), F.lit(""))


def keys_of(host: Column, path: Column, page: Column) -> Column:
    """List keys that a URL answers to: its host, each parent domain, host with each prefix of the path, the whole page."""
    labels, steps = F.split(host, r"\."), F.split(F.substring(path, 2, 1 << 30), "/")
    tails = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    below = F.transform(
        F.sequence(F.lit(1), F.size(steps)), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, F.lit(1), i), "/"))
    )
    none = F.array().cast("array<string>")
    own = F.when(path != "", below).otherwise(none), F.when(page != "", F.array(page)).otherwise(none)
    return F.array_distinct(F.concat(tails, *own))


def intervals(entries: DataFrame) -> DataFrame:
    """``list, key, valid_from, valid_to`` from dated entries ``list, key, listed, at``.

    An entry holds from its time until the next one of its list and key; ``valid_to`` is null for the last.  Of entries
    at the same time a removal counts after an addition.  Entries without a list, key or time are ignored; slashes at
    the end of a key are dropped.
    """
    named = entries.where("list is not null and key is not null and at is not null").withColumn("key", F.rtrim("key", F.lit("/")))
    dated = named.groupBy("list", "key", "at").agg(F.min("listed").alias("listed"))
    own = W.partitionBy("list", "key").orderBy("at")
    return dated.withColumn("valid_to", F.lead("at").over(own)).where("listed").select(
        "list", "key", F.col("at").alias("valid_from"), "valid_to"
    )


def evaluate(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """``captures`` with ``host, blocked, lists, n_active, listed_since``.

    A key is a host, a domain with all hosts below it, a host with the start of a path (``h.org/a/b`` holds
    ``http://h.org/a/b/c``), or a whole page with its query (``h.org/a?b=1``, a host in front of path and query).

    Each distinct host, path and fetch time is judged once, so a host with a third of all captures is judged once
    per path and time; paths are compared as deep as the deepest entry goes.  Intervals and fetch times meet by key and
    month: a long history of one key is searched by month, not as a whole.

    Defined cases: a URL without a host, or a null URL or time, is in no list; repeated captures are judged alike; an
    interval's end is exclusive; empty lists block nothing.  Columns of ``captures`` named like the new ones are replaced.
    """
    new = ["host", "blocked", "lists", "n_active", "listed_since"]
    plain = F.substring_index(F.rtrim("key", F.lit("/")), "?", 1)
    depth, queries = entries.agg(F.max(F.size(F.split(plain, "/")) - 1), F.bool_or(F.contains("key", F.lit("?")))).first()
    rows = captures.drop(*new).withColumns(
        {
            "host": host_of(url), "_path": F.substring_index(path_of(url), "/", (depth or 0) + 1),
            "_page": page_of(url) if queries else F.lit(""), "_at": F.col(fetched),
        }
    )
    place = ["host", "_path", "_page", "_at"]
    asked = rows.where("host is not null and _at is not null").select(*place).distinct()
    month = F.date_trunc("month", "_at").cast("date")
    low, high = (F.lit(x).cast("date") for x in asked.agg(F.min(month), F.max(month)).first())
    first = F.greatest(F.date_trunc("month", "valid_from").cast("date"), low)
    last = F.least(F.coalesce(F.date_trunc("month", "valid_to").cast("date"), high), high)
    monthly = intervals(entries).where(low.isNotNull() & (first <= last)).select(
        "list", "key", "valid_from", "valid_to", F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("month")
    )
    keyed = asked.withColumn("key", F.explode(keys_of(F.col("host"), F.col("_path"), F.col("_page")))).withColumn("month", month)
    active = (
        keyed.join(monthly, ["key", "month"])
        .where("valid_from <= _at and (valid_to is null or _at < valid_to)")
        .groupBy(*place)
        .agg(
            F.array_sort(F.collect_set("list")).alias("lists"),
            F.count("*").alias("n_active"),
            F.min("valid_from").alias("listed_since"),
        )
    )
    judged = rows.join(active, place, "left")
    return judged.select(
        *[c for c in captures.columns if c not in new], "host", F.col("n_active").isNotNull().alias("blocked"),
        F.coalesce("lists", F.array().cast("array<string>")).alias("lists"),
        F.coalesce("n_active", F.lit(0).cast("long")).alias("n_active"), "listed_since",
    )
