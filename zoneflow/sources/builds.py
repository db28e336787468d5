"""Derived tables that know what they were built from."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PART = "_part"
BUILT, SKIPPED, EXTENDED, REBUILT = "built", "skipped", "extended", "rebuilt"
INPUTS = "path string, length long, modified timestamp, parameters string"


@dataclass(frozen=True)
class Build:
    """What was done, why, the input files that were read for it, and the rows of the whole table."""

    decision: str
    reason: str
    files_read: int
    rows: int
    table: DataFrame


def input_files(spark: SparkSession, inputs: Sequence[str]) -> DataFrame:
    """``path, length, modified`` of all files below the inputs; the files are listed, not opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(inputs))
    return listed.select("path", "length", F.col("modificationTime").alias("modified"))


def _recorded(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(f"{INPUTS}, {PART} int").parquet(f"{path}/inputs")
    except AnalysisException:
        return None


def read_build(spark: SparkSession, path: str) -> DataFrame:
    """The table as its last whole build left it."""
    parts = [r[0] for r in _recorded(spark, path).select(PART).distinct().collect()]  # one for each build since the last full one
    return spark.read.option("basePath", f"{path}/data").parquet(*[f"{path}/data/{PART}={p}" for p in sorted(parts)]).drop(PART)


def build_tracked(
    spark: SparkSession,
    path: str,
    inputs: Sequence[str],
    build: Callable[[Sequence[str]], DataFrame],
    parameters: Mapping[str, object] | None = None,
    additive: bool = False,
) -> Build:
    """Build the table at ``path`` from files, or skip or extend it when that is enough.

    Beside the rows stands a record of the input files, with length and time, and of the parameters.  Nothing changed:
    the table is left as it is.  Only new files came and the table is ``additive``, the union of what its files give:
    ``build`` is called with the new files and its rows are added.  Else it is called with all files.

    The record is written after the rows it speaks of.  A build that dies before leaves rows that no record names; the
    next one takes their place.
    """
    wanted = json.dumps({k: str(v) for k, v in (parameters or {}).items()}, sort_keys=True)
    files = input_files(spark, inputs)
    known = _recorded(spark, path)
    if known is None:
        return _write(spark, path, files, build, wanted, 0, BUILT, "no earlier build")
    old = known.select("path", F.col("length").alias("_l"), F.col("modified").alias("_m"), "parameters", PART)
    compared = files.join(old, "path", "full_outer").select(
        "path",
        F.col("length").isNull().alias("gone"),
        F.col("_l").isNull().alias("new"),
        ((F.col("length") != F.col("_l")) | (F.col("modified") != F.col("_m"))).alias("changed"),
        (F.col("parameters") != wanted).alias("other"),
        PART,
    )
    flags = ["gone", "new", "changed", "other"]
    gone, new, changed, other, last = compared.agg(
        *[F.coalesce(F.sum(F.col(c).cast("int")), F.lit(0)) for c in flags], F.coalesce(F.max(PART), F.lit(0))
    ).first()
    if other:
        return _write(spark, path, files, build, wanted, last + 1, REBUILT, "other parameters")
    if gone or changed:
        return _write(spark, path, files, build, wanted, last + 1, REBUILT, f"{changed} files changed, {gone} gone")
    if not new:
        table = read_build(spark, path)
        return Build(SKIPPED, "nothing changed", 0, table.count(), table)
    if not additive:
        return _write(spark, path, files, build, wanted, last + 1, REBUILT, f"{new} new files")
    added = files.join(old.select("path"), "path", "left_anti")
    return _write(spark, path, added, build, wanted, last + 1, EXTENDED, f"{new} new files")


def _write(
    spark: SparkSession, path: str, files: DataFrame, build: Callable, parameters: str, part: int, decision: str, reason: str
) -> Build:
    # Listed once, before the build: a file that comes meanwhile is new next time.  Readers take names as a list.
    listed = files.collect()
    names = sorted(r.path for r in listed)
    record = spark.createDataFrame(listed, files.schema).withColumn("parameters", F.lit(parameters)).coalesce(1)
    build(names).write.mode("overwrite").parquet(f"{path}/data/{PART}={part}")
    if decision == EXTENDED:
        record.write.mode("overwrite").parquet(f"{path}/inputs/{PART}={part}")
    else:
        record.withColumn(PART, F.lit(part)).write.mode("overwrite").partitionBy(PART).parquet(f"{path}/inputs")
    table = read_build(spark, path)
    return Build(decision, reason, len(names), table.count(), table)
