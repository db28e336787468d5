"""Tables that cut lineage, kept in the shared folder of the session."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from zoneflow.operators.sizing import shared_folder

BATCH_ROWS = 2_000  # rows that Spark hands to Python at a time: long texts make large batches


class Scratch:
    """A folder of written tables; ``drop`` removes those that no later step reads.

    Every table is a plain Parquet folder that all executors reach, so a lost executor costs a file read.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/llm/{uuid.uuid4().hex}"
        self._count = 0
        self._paths: dict[int, str] = {}

    def path(self) -> str:
        self._count += 1
        return f"{self.root}/{self._count:03d}"

    def keep(self, df: DataFrame, batch_rows: int = BATCH_ROWS) -> DataFrame:
        """Write ``df`` and return a frame that reads the written table.

        What the write has shuffled is deleted as soon as the table is there: nothing reads it again.
        """
        path = self.path()
        with settings(
            self.spark,
            spark__sql__execution__arrow__maxRecordsPerBatch=str(batch_rows),
            spark__sql__classic__shuffleDependency__fileCleanup__enabled="true",
        ):
            df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(back)] = path
        return back

    def drop(self, *frames: DataFrame) -> None:
        """Delete written tables that are not read any more."""
        for df in frames:
            path = self._paths.pop(id(df), None)
            if path:
                delete(self.spark, path)


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Set session options (dots written as two underscores) for the jobs run inside."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
