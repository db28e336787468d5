"""Marts kept as partial results that add up: totals by cell and sketches, written for each slice of the input.

A slice that arrives, or is replaced, costs its own rows; views merge the cells of the periods they ask for and never go
back to the zone-hours.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.operators import marts

SLICE = "_slice"
GROUP = [*marts.PERIOD, "zone_id", "is_weekend"]
TOTALS = ["total", "records", "after_hours", "high"]
# Rank error of a quantile at 99 %: about 0.9 % for a sketch of this size.  Relative error of a distinct count: 1.6 %.
QUANTILE_SIZE = 400
DISTINCT_LOG_SIZE = 12


def hour_cells(rows: DataFrame) -> DataFrame:
    """Totals of mart rows by period, zone, day type and hour."""
    demand = F.col("demand_count")
    return rows.groupBy(*GROUP, "hour").agg(
        F.sum(demand).alias("total"),
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.sum(F.when(F.col("is_after_hours"), demand)), F.lit(0)).alias("after_hours"),
        F.sum("high_demand_flag").alias("high"),
        F.max(demand).alias("peak"),
    )


def merge_hours(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cells added up to hours of a zone, in the form that :func:`zoneflow.operators.marts.summary_of_hours` takes."""
    weekend = F.coalesce(F.sum(F.when(F.col("is_weekend"), F.col("total"))), F.lit(0))
    return cells.groupBy(*by, "zone_id", "hour").agg(
        *[F.sum(c).alias(c) for c in TOTALS], weekend.alias("weekend"), F.max("peak").alias("peak")
    )


def sketch_cells(rows: DataFrame) -> DataFrame:
    """A quantile sketch of the hourly demand and a distinct-count sketch of the days, by period, zone and day type."""
    return rows.groupBy(*GROUP).agg(
        F.kll_sketch_agg_bigint("demand_count", QUANTILE_SIZE).alias("demand"),
        F.hll_sketch_agg(F.datediff("date", F.lit("1970-01-01").cast("date")), DISTINCT_LOG_SIZE).alias("days"),
    )


def merge_sketches(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    return cells.groupBy(*by).agg(
        F.kll_merge_agg_bigint("demand", QUANTILE_SIZE).alias("demand"), F.hll_union_agg("days").alias("days")
    )


def quantile(sketch: str, q: float) -> Column:
    """Value that about a share ``q`` of the sketched values do not exceed."""
    return F.kll_sketch_get_quantile_bigint(sketch, F.lit(q))


class CellMart:
    """Cells below ``path``, a folder for each slice.

    A slice is any part of the mart rows that holds its zone-hours whole, such as a day, a month or a group of zones; the
    periods of slices may overlap.  Writing a slice again replaces it.  A job that dies while it replaces a slice leaves
    that slice out until it is written again; the others are untouched.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write_slice(self, rows: DataFrame, name: str) -> None:
        """Add or replace one slice of mart rows (see :func:`zoneflow.operators.marts.mart_input`); it may be empty."""
        folder = f"{SLICE}={quote(name, safe='')}"
        for part, cells in (("hours", hour_cells(rows)), ("sketches", sketch_cells(rows))):
            # As many files as a slice needs for its cells, not as the shuffle has partitions.
            cells.hint("rebalance").write.mode("overwrite").parquet(f"{self.path}/{part}/{folder}")

    def _cells(self, part: str, start: str | None, end: str | None, day_type: str) -> DataFrame:
        cells = self.spark.read.parquet(f"{self.path}/{part}").drop(SLICE)
        if start is not None and end is not None:
            cells = marts.in_periods(cells, start, end)
        return marts.of_day_type(cells, day_type)

    def summary(
        self, by: Sequence[str] = (), start: str | None = None, end: str | None = None, day_type: str = marts.ALL
    ) -> DataFrame:
        """What :func:`zoneflow.operators.marts.zone_summary` gives for the rows of all slices, or of some periods."""
        return marts.summary_of_hours(merge_hours(self._cells("hours", start, end, day_type), by), by)

    def distribution(
        self, by: Sequence[str] = ("zone_id",), start: str | None = None, end: str | None = None, day_type: str = marts.ALL
    ) -> DataFrame:
        """``zone_hours, p50, p75, p95, active_days`` by some of the cells' columns, estimated from the sketches.

        Quantiles have the stated error in rank, days in number; ``zone_hours`` is exact.
        """
        merged = merge_sketches(self._cells("sketches", start, end, day_type), by)
        return merged.select(
            *by, F.kll_sketch_get_n_bigint("demand").alias("zone_hours"),
            *[quantile("demand", q / 100).alias(f"p{q}") for q in (50, 75, 95)],
            F.hll_sketch_estimate("days").alias("active_days"),
        )
