"""Size checks and lineage cuts shared by the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def shared_folder(spark: SparkSession) -> str:
    """Checkpoint folder of the session; one of its own only where none is set in local mode, as in tests."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="zoneflow-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a frame that several steps read as a table in the shared folder and read it back.

    Later steps then prune its columns, push filters into its scan and know its
    size, and a lost executor costs a file read instead of the whole history.
    """
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
