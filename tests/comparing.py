"""Compare a Spark result with a DuckDB result column by column and row by row."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def _cell(v) -> str:
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return "[" + ",".join(_cell(x) for x in v) + "]"
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def rows(df: pd.DataFrame) -> list[tuple[str, ...]]:
    names = sorted(df.columns)
    return sorted(tuple(map(_cell, r)) for r in zip(*[df[c].tolist() for c in names]))


def kinds(df: pd.DataFrame) -> dict[str, str]:
    return {c: df[c].dtype.kind for c in sorted(df.columns)}


def differences(spark_df, con, sql: str) -> list[str]:
    """Readable differences between both results; empty when they agree."""
    mine = spark_df.toPandas()
    theirs = con.sql(sql).df()
    if sorted(mine.columns) != sorted(theirs.columns):
        return [f"columns {sorted(set(mine.columns) ^ set(theirs.columns))}"]
    for c in mine.columns:  # pandas holds integers with nulls as floats, DuckDB does not
        if mine[c].dtype.kind == "f" and theirs[c].dtype.kind == "i":
            mine[c] = mine[c].astype("Int64")
    out = []
    if kinds(mine) != kinds(theirs):
        out.append(f"kinds {[(c, k, kinds(theirs)[c]) for c, k in kinds(mine).items() if k != kinds(theirs)[c]]}")
    if len(mine) != len(theirs):
        out.append(f"rows {len(mine)} != {len(theirs)}")
    a, b = rows(mine), rows(theirs)
    if a != b:
        left, right = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        out.append(f"columns {sorted(mine.columns)}")
        out.append(f"{len(left)} rows only in Spark, {len(right)} only in DuckDB")
        out += [f"  spark  {r}" for r in left[:3]] + [f"  duckdb {r}" for r in right[:3]]
    return out
