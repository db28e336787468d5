"""Incremental forms of the rollup, the de-duplication and the keyed upsert.

Watermarks need a zoned timestamp, so wall-clock times are read as UTC on the
way in and turned back on the way out; the session time zone plays no part.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zoneflow.functions.time import floor_hour, instant_to_ntz, ntz_to_instant
from zoneflow.operators.sizing import shared_folder
from zoneflow.sources.changelog import LAST, ChangeLog

INSTANT = "_instant"


def with_watermark(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    return stream.withColumn(INSTANT, ntz_to_instant(ts)).withWatermark(INSTANT, delay)


def zone_hour_counts(stream: DataFrame, ts: str = "event_datetime", zone: str = "zone_id", delay: str = "2 hours") -> DataFrame:
    """Events per zone and hour; events of hours that lie behind the watermark are dropped.

    In append mode an hour is emitted once it is closed, in update mode whenever it changes.
    """
    hours = with_watermark(stream, ts, delay).groupBy(F.window(INSTANT, "1 hour"), zone)
    return hours.agg(F.count(F.lit(1)).alias("demand_count")).select(
        zone, instant_to_ntz("window.start").alias("date_hour"), "demand_count"
    )


def first_seen(stream: DataFrame, key: Sequence[str] = ("event_id",), ts: str = "event_datetime", delay: str = "2 hours") -> DataFrame:
    """First record per key; copies that arrive within the delay are dropped."""
    return with_watermark(stream, ts, delay).dropDuplicatesWithinWatermark(list(key)).drop(INSTANT)


def upsert_to(log: ChangeLog, order: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Sink function for ``foreachBatch`` that applies each micro-batch to a log; a repeated one changes nothing."""
    def write(batch: DataFrame, number: int) -> None:
        log.append(batch, number, order)

    return write


def run_folder(spark: SparkSession, name: str) -> str:
    """New folder for one run below the shared checkpoint folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drain_to_parquet(stream: DataFrame, folder: str) -> DataFrame:
    """Process all available input in append mode into Parquet and return the written rows."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    _finish(query)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


def drain_upserts(
    stream: DataFrame, folder: str, key: Sequence[str], order: Sequence[str], mode: str = "append", keep: str = LAST
) -> ChangeLog:
    """Process all available input as keyed upserts and return their log.

    In update mode an aggregated stream writes every group it has changed, closed
    or still open, and a later batch replaces it: nothing waits for a watermark.
    """
    log = ChangeLog(stream.sparkSession, f"{folder}/changes", key, keep=keep)
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(upsert_to(log, order))
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    _finish(query)
    return log


@dataclass(frozen=True)
class ClosedHours:
    """Where :func:`drain_closed_hours` keeps its tables, each with a folder for every batch.

    ``counts``: of the hours that a batch closed, and of those it left open; ``late``: events that came after their hour
    was closed; ``marks``: the first hour that a batch left open, written last.
    """

    spark: SparkSession
    path: str
    ts: str = "event_datetime"
    zone: str = "zone_id"
    delay_hours: int = 2

    def apply(self, batch: DataFrame, number: int) -> None:
        """One batch: late events aside, the rest added to the open hours, and hours closed that are over.

        An hour is over when an event came that is ``delay_hours`` later than its end.  Only the open hours of the batch
        before are read, so the state is bounded by the hours within the delay, whatever came earlier.  A repeated batch
        starts from the same state and replaces its own folders.
        """
        before = self._mark_before(number)
        rows = batch.withColumn("date_hour", floor_hour(self.ts))
        over = F.col("date_hour") < F.lit(before) if before is not None else F.lit(False)
        undated = F.col("date_hour").isNull()
        # The batch is read for its late events, its counts and its last event.
        late = rows.where(over | undated).drop("date_hour")
        late.write.mode("overwrite").parquet(self._folder("late", number))
        counts = rows.where(~over & ~undated).groupBy(self.zone, "date_hour").agg(F.count(F.lit(1)).alias("demand_count"))
        if (earlier := self._open_before(number)) is not None:
            counts = counts.unionByName(earlier).groupBy(self.zone, "date_hour").agg(
                F.sum("demand_count").alias("demand_count")
            )
        last = rows.agg(F.max(self.ts)).first()[0]
        reached = None if last is None else (last - timedelta(hours=self.delay_hours)).replace(minute=0, second=0, microsecond=0)
        mark = max((m for m in (before, reached) if m is not None), default=None)
        done = F.col("date_hour") < F.lit(mark) if mark is not None else F.lit(False)
        counts.withColumn("closed", done).write.mode("overwrite").partitionBy("closed").parquet(self._folder("counts", number))
        marks = self.spark.createDataFrame([(number, mark)], "batch long, mark timestamp_ntz")
        marks.coalesce(1).write.mode("overwrite").parquet(self._folder("marks", number))

    def _folder(self, name: str, number: int) -> str:
        return f"{self.path}/{name}/batch_={number}"

    def _counts(self, closed: bool, *folders: str) -> DataFrame:
        root = f"{self.path}/counts"
        reader = self.spark.read.schema(f"{self.zone} string, date_hour timestamp_ntz, demand_count long, batch_ long, closed boolean")
        counts = reader.option("basePath", root).parquet(*(folders or [root]))
        return counts.where(F.col("closed") == closed).drop("batch_", "closed")

    def _last_before(self, number: int):
        try:
            marks = self.spark.read.schema("batch long, mark timestamp_ntz").parquet(f"{self.path}/marks")
        except AnalysisException:
            return None
        return marks.where(F.col("batch") < number).orderBy(F.desc("batch")).first()

    def _mark_before(self, number: int):
        row = self._last_before(number)
        return row.mark if row else None

    def _open_before(self, number: int) -> DataFrame | None:
        row = self._last_before(number)
        return self._counts(False, self._folder("counts", row.batch)) if row else None

    def closed(self) -> DataFrame:
        """Finished counts; an hour of a zone is there once."""
        return self._counts(True)

    def still_open(self) -> DataFrame:
        """Counts of the hours that the last batch left open."""
        return self._open_before(2**62)

    def late(self) -> DataFrame:
        """Events whose hour was closed when they came, and those without a time."""
        return self.spark.read.parquet(f"{self.path}/late").drop("batch_")


def drain_closed_hours(
    stream: DataFrame, folder: str, ts: str = "event_datetime", zone: str = "zone_id", delay_hours: int = 2
) -> ClosedHours:
    """Process all available input to counts of closed hours, and late events apart: together they are all events."""
    hours = ClosedHours(stream.sparkSession, f"{folder}/hours", ts, zone, delay_hours)
    query = (
        stream.writeStream.foreachBatch(hours.apply)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    _finish(query)
    return hours


def _finish(query: StreamingQuery) -> None:
    try:
        query.awaitTermination()
    finally:
        query.stop()
