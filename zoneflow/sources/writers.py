"""Writers: tables, single files, previews, views and run records."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions.time import iso_text

PREVIEW_ROWS = 5_000
# Published alias -> mart.
ALIASES = {
    "tableau_hourly_demand": "hourly_demand",
    "tableau_zone_summary": "zone_summary",
    "tableau_category_summary": "category_summary",
    "tableau_cluster_profiles": "cluster_profiles",
    "tableau_model_predictions": "model_predictions",
    "tableau_product_recommendations": "recommendations",
    "tableau_executive_kpis": "executive_kpis",
    "tableau_workload_risk_scores": "workload_risk_scores",
}
BATCH = "_batch"
RUN = "_run"


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> DataFrame:
    """Overwrite a Parquet table and return it read back, so later steps start from files."""
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header; ``single_file`` gathers the finished rows in one task, for tables known to be small."""
    (df.repartition(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def write_preview(df: DataFrame, path: str, key: Sequence[str], rows: int = PREVIEW_ROWS) -> None:
    """First rows in key order as one CSV file."""
    df.orderBy(*key).limit(rows).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_record(df: DataFrame, path: str) -> None:
    """A one-row table as one JSON file; more rows are an error, and an earlier record then stays."""
    rows = df.take(2)
    if len(rows) > 1:
        raise ValueError("a record has one row")
    df.sparkSession.createDataFrame(rows, df.schema).coalesce(1).write.mode("overwrite").json(path)


def sql_types(df: DataFrame) -> DataFrame:
    """Booleans as 0 and 1, timestamps and dates as text, for tools without these types."""
    casts = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.BooleanType):
            casts[f.name] = F.col(f.name).cast("int")
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            casts[f.name] = iso_text(f.name)
        elif isinstance(f.dataType, T.DateType):
            casts[f.name] = F.col(f.name).cast("string")
    return df.withColumns(casts) if casts else df


def register(tables: Mapping[str, DataFrame]) -> list[str]:
    """Make tables known to SQL by name."""
    for name, df in tables.items():
        sql_types(df).createOrReplaceTempView(name)
    return list(tables)


def publish(marts: Mapping[str, DataFrame], aliases: Mapping[str, str] = ALIASES) -> list[str]:
    """Views of the present marts under their published names; nothing is copied."""
    present = {alias: mart for alias, mart in aliases.items() if mart in marts}
    for alias, mart in present.items():
        marts[mart].createOrReplaceTempView(alias)
    return list(present)


def load_table(df: DataFrame, table: str, batch: int, path: str | None = None) -> None:
    """Load one batch of rows into a catalog table, partitioned by batch, with columns in SQL types.

    The first batch creates the table (``path`` gives its place; the warehouse by default), later ones add their rows,
    and a batch that is loaded again replaces its own rows only, so a retry adds nothing.  Columns are matched by name;
    one that the table has not is an error, one that the batch has not is null.  An empty batch changes nothing.
    """
    spark = df.sparkSession
    stamped = sql_types(df).withColumn(BATCH, F.lit(batch).cast("int"))
    if not spark.catalog.tableExists(table):
        writer = stamped.write.partitionBy(BATCH).format("parquet")
        (writer.option("path", path) if path else writer).saveAsTable(table)
        return
    known = spark.table(table).schema
    unknown = set(stamped.columns) - set(known.names)
    if unknown:
        raise ValueError(f"columns that {table} has not: {sorted(unknown)}")
    aligned = [(F.col(f.name) if f.name in stamped.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in known]
    mode, before = "spark.sql.sources.partitionOverwriteMode", spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set(mode, "dynamic")
    try:
        stamped.select(*aligned).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def build_once(spark: SparkSession, path: str, build: Callable[[], DataFrame], if_exists: str = "skip") -> DataFrame:
    """The table at the path; built and written only when absent or ``if_exists`` is ``overwrite``."""
    if if_exists == "skip":
        try:
            return spark.read.parquet(path)
        except AnalysisException:
            pass
    return write_table(build(), path)


def record_run(spark: SparkSession, path: str, run_tag: str, facts: Mapping[str, object]) -> None:
    """Store one run's figures in the folder of its tag; a later record of the same tag replaces it, others stay."""
    details = {k: None if v is None else str(v) for k, v in facts.items()}
    row = spark.createDataFrame([(run_tag, details)], "run_tag string, details map<string, string>")
    loaded = F.lit(datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"))
    row.withColumn("_loaded_at", loaded).write.mode("overwrite").parquet(f"{path}/{RUN}={quote(run_tag, safe='')}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """One row per recorded run tag."""
    return spark.read.parquet(path).drop(RUN)
