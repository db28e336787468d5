"""Contiguous shards of equal bytes, cut from a global prefix sum over totals of partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zoneflow.llm.scratch import Scratch

WHOLE_GROUP_PERCENT = 2  # equal texts stay together where they are at most this share of a shard


def assign(docs: DataFrame, shards: int = 16, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, size, text_crc32, shard, slot`` of every row.

    Rows stand in the order of a hash of their text, then of their id, so the result depends on the rows alone and
    equal texts follow each other.  The order is dealt by ranges; totals of the ranges give each range's first byte and
    row, sums within a range the rest.  A row goes to the shard in which its middle byte falls.  Equal texts that a cut
    would part go together, by the middle of all of them, unless they are over 2 % of a shard.

    Defined cases: a null text counts as an empty one (size 1); repeated rows each have a slot of their own; rows
    without an id come first among equal texts; an empty table gives no rows; a table smaller than the number of shards
    leaves shards empty.  Other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias(id_column),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_key"),
    )
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["_key", id_column, "size", "text_crc32"]
    ranged = scratch.keep(rows.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()))

    totals = ranged.groupBy("_range").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)  # one row for each range
    firsts = totals.select(
        "_range",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_first_byte"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first_row"),
    )
    total = totals.agg(F.sum("_bytes")).first()[0] or 1
    within = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    placed = (
        ranged.withColumn("_end", F.sum("size").over(within))
        .withColumn("_n", F.count("*").over(within))
        .join(F.broadcast(firsts), "_range")
        .withColumn("_start", F.col("_first_byte") + F.col("_end") - F.col("size"))
        .withColumn("_row", F.col("_first_row") + F.col("_n") - 1)
        .withColumn("_own", _shard(F.col("_start") * 2 + F.col("size"), total, shards))
        .select(id_column, "size", "text_crc32", "_key", "_start", "_row", "_own")
    )
    placed = scratch.keep(placed)

    cuts = placed.groupBy("_own").agg(F.min_by("_key", "_row").alias("_key")).select("_key").distinct()
    groups = (
        placed.join(F.broadcast(cuts), "_key", "left_semi")
        .groupBy("_key")
        .agg(F.min("_start").alias("a"), F.max(F.col("_start") + F.col("size")).alias("b"))
        .where((F.col("b") - F.col("a")) * shards * 100 <= F.lit(WHOLE_GROUP_PERCENT) * total)
        .select("_key", _shard(F.col("a") + F.col("b"), total, shards).alias("_group"))
    )
    # ``cuts`` and ``groups`` hold at most one row for each shard.
    dealt = placed.join(F.broadcast(groups), "_key", "left").withColumn("shard", F.coalesce("_group", "_own"))
    begins = dealt.groupBy("shard").agg(F.min("_row").alias("_begin"))
    return dealt.join(F.broadcast(begins), "shard").select(
        id_column, "size", "text_crc32", "shard", (F.col("_row") - F.col("_begin")).alias("slot")
    )


def _shard(twice_middle: F.Column, total: int, shards: int) -> F.Column:
    at = F.floor(twice_middle.cast("decimal(38,0)") * shards / F.lit(2 * total)).cast("int")
    return F.least(at, F.lit(shards - 1))


def write(docs: DataFrame, path: str, shards: int = 16, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Write ``docs`` as Parquet folders ``shard=0`` and so on; rows are known by id and text."""
    own = assign(docs, shards, id_column, text_column).select(
        F.col(id_column).alias("_id"), F.col("text_crc32").alias("_c"), F.col("size").alias("_s"), F.col("shard").alias("_shard")
    )
    # Repeated rows are written as often as they occur: all of them to the shard of the first.
    own = own.groupBy("_id", "_c", "_s").agg(F.min("_shard").alias("_shard"))
    text = F.coalesce(F.col(text_column), F.lit(""))
    keyed = docs.withColumn("_crc", F.crc32(text.cast("binary"))).withColumn("_size", (F.octet_length(text) + 1).cast("long"))
    same = F.col(id_column).eqNullSafe(F.col("_id")) & (F.col("_crc") == F.col("_c")) & (F.col("_size") == F.col("_s"))
    joined = keyed.join(own, same).select(*docs.columns, F.col("_shard").alias("shard"))
    joined.write.partitionBy("shard").parquet(path)
