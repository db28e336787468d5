"""Ranks and running totals over a whole column without a single-task sort.

Rows are dealt by ranges of the value and its ties, so that a value which most rows
share is dealt to several tasks too.  Running totals are taken inside each range in
parallel; range totals, one row per range, then shift them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zoneflow.operators.sizing import cut_lineage


def running_total(
    df: DataFrame, value: str, amounts: Sequence[str], blocks: int | None = None, ties: Sequence[str] = ()
) -> DataFrame:
    """Add ``<amount>_before``: the total of the amount over all rows with a lower value.

    Rows must be unique on the value and the ``ties`` columns, which break the
    order among equal values.  A null value comes first.  ``blocks`` is the number
    of ranges, the session's shuffle partitions by default, and changes the speed
    only.  The ranges are written as a table: their borders come from a sample, so
    a repeated evaluation could cut elsewhere.
    """
    count = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocked = cut_lineage(
        df.repartitionByRange(count, value, *ties).withColumn("_block", F.spark_partition_id())
    )
    inside = W.partitionBy("_block").orderBy(value, *ties).rowsBetween(W.unboundedPreceding, -1)
    totals = blocked.groupBy("_block").agg(*[F.sum(a).alias(f"_total_{a}") for a in amounts])
    earlier = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    offsets = totals.select(
        "_block", *[F.coalesce(F.sum(f"_total_{a}").over(earlier), F.lit(0)).alias(f"_offset_{a}") for a in amounts]
    )
    out = blocked.withColumns({f"_inside_{a}": F.coalesce(F.sum(a).over(inside), F.lit(0)) for a in amounts})
    out = out.join(F.broadcast(offsets), "_block")
    out = out.withColumns({f"{a}_before": F.col(f"_inside_{a}") + F.col(f"_offset_{a}") for a in amounts})
    helpers = [f"{p}_{a}" for a in amounts for p in ("_inside", "_offset")]
    return out.drop("_block", *helpers)


def row_numbers(df: DataFrame, value: str, ties: Sequence[str], out: str, blocks: int | None = None) -> DataFrame:
    """Number all rows from 1 by rising value, ties broken by the given columns."""
    counted = running_total(df.withColumn("_one", F.lit(1)), value, ["_one"], blocks, ties)
    return counted.withColumn(out, (F.col("_one_before") + 1).cast("int")).drop("_one", "_one_before")


def quantile_groups(df: DataFrame, value: str, ties: Sequence[str], groups: int, out: str, blocks: int | None = None) -> DataFrame:
    """Split rows into ``groups`` equal parts by rising value, numbered from 1 like ``ntile``."""
    numbered = row_numbers(df, value, ties, "_row", blocks)
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    small = F.floor(F.col("_n") / groups)
    larger = F.col("_n") % groups
    edge = larger * (small + 1)
    row = F.col("_row") - 1
    tile = F.when(row < edge, F.floor(row / (small + 1))).otherwise(larger + F.floor((row - edge) / F.greatest(small, F.lit(1))))
    return numbered.withColumn("_n", rows).withColumn(out, (tile + 1).cast("int")).drop("_row", "_n")


def mid_ranks(frequencies: DataFrame, value: str, count: str, blocks: int | None = None) -> DataFrame:
    """Add the mean rank each value would have among all ``count`` copies of all values."""
    ranked = running_total(frequencies, value, [count], blocks)
    return ranked.withColumn("mid_rank", F.col(f"{count}_before") + (F.col(count) + 1) / F.lit(2.0)).drop(
        f"{count}_before"
    )
