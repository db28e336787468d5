"""Run catalogue queries against their SQL checks: ``run_checks.py [folder] [name ...]``."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from comparing import differences, duck  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
wanted = sys.argv[2:]
spark = (
    SparkSession.builder.master("local[8]")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.driver.memory", "8g")
    .config("spark.sql.session.timeZone", "UTC")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
con = duck(folder)
sql = entry.oracle_sql()
bad = 0
for name, fn in entry.queries().items():
    if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
        continue
    start = time.time()
    try:
        if name in sql:
            diff = differences(fn(spark, folder), con, sql[name])
            state = "ok" if not diff else "DIFF"
        else:
            n = len(fn(spark, folder).toPandas())
            diff, state = [], f"rows-only {n}"
    except Exception:
        diff, state = traceback.format_exc().splitlines()[-25:], "ERROR"
    bad += bool(diff)
    print(f"{name:32s} {state:14s} {time.time() - start:6.2f}s", flush=True)
    for line in diff:
        print("    " + line[:1500])
print("bad:", bad)
