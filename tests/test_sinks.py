"""Catalog tables, capped samples and tracked builds."""

import os
import random

import pytest
from pyspark.sql import functions as F

from zoneflow.operators import sampling
from zoneflow.sources import builds, writers


def test_load_table(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, "k long, ok boolean, t timestamp_ntz")
    name, place = f"loaded_{random.randrange(10**9)}", str(tmp_path / "table")
    state = lambda: sorted((r.k, r.ok, r._batch) for r in spark.table(name).collect())
    writers.load_table(frame([(1, True, None), (2, False, None)]), name, 0, place)
    writers.load_table(frame([(3, None, None)]), name, 1, place)
    writers.load_table(spark.createDataFrame([(4,)], "k int"), name, 2, place)
    want = [(1, 1, 0), (2, 0, 0), (3, None, 1), (4, None, 2)]
    assert state() == want and spark.table(name).schema["t"].dataType.simpleString() == "string"
    for _ in range(2):
        writers.load_table(frame([(3, None, None)]), name, 1, place)
    writers.load_table(frame([]), name, 7, place)
    assert state() == want
    writers.load_table(frame([(9, True, None)]), name, 0, place)
    assert state() == [(3, None, 1), (4, None, 2), (9, 1, 0)]
    with pytest.raises(ValueError, match="has not"):
        writers.load_table(spark.createDataFrame([(4,)], "other int"), name, 3, place)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    spark.sql(f"drop table {name}")


def test_capped_sample(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice(["a", "a", "a", "b", None])) for i in range(2000)] + [(5000, "rare")]
    df = spark.createDataFrame(rows, "k long, c string")
    one = lambda d, **o: sorted(map(tuple, sampling.capped_sample(d, 40, ["k"], **o).collect()), key=str)
    for by in ((), ("c",)):
        assert one(df, by=by) == one(df.repartition(17, "c"), by=by) == one(df.coalesce(1), by=by)
    by_class = one(df, by=("c",))
    assert {c: sum(x == c for _, x in by_class) for c in ("a", "b", None, "rare")} == {"a": 40, "b": 40, None: 40, "rare": 1}
    assert one(df) != one(df, seed=1) and len(one(df)) == 40
    plan = sampling.capped_sample(df, 40, ["k"], by=["c"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    with pytest.raises(ValueError):
        sampling.capped_sample(df, 5, [])


def test_tracked_build(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    calls = []

    def add(name, rows):
        spark.createDataFrame(rows, "v long").coalesce(1).write.mode("overwrite").parquet(str(source / name))

    def build(files):
        calls.append(len(files))
        return spark.read.parquet(*files).select((F.col("v") * 2).alias("v"))

    def run(**options):
        made = builds.build_tracked(spark, out, [str(source)], build, additive=True, **options)
        return made.decision, made.files_read, made.rows, sorted(r.v for r in made.table.collect())

    add("a", [(1,), (2,)])
    first = len([f for f in os.listdir(source / "a") if f.endswith(".parquet")])
    assert first == 1 and run() == ("built", 1, 2, [2, 4])
    assert run() == ("skipped", 0, 2, [2, 4]) and calls == [1]
    add("b", [(5,)])
    assert run() == ("extended", 1, 3, [2, 4, 10])
    add("c", [(6,)])
    assert run() == ("extended", 1, 4, [2, 4, 10, 12]) and run()[0] == "skipped"
    [file] = [source / "a" / f for f in os.listdir(source / "a") if f.endswith(".parquet")]
    os.utime(file, (1, 1))
    assert run() == ("rebuilt", 3, 4, [2, 4, 10, 12])
    assert run(parameters={"x": 1})[0] == "rebuilt" and run(parameters={"x": 1})[0] == "skipped"

    # A build that dies before its record leaves rows that do not count.
    add("d", [(7,)])
    def die(files):
        build(files).write.parquet(f"{out}/data/_part=99")
        raise OSError("lost")

    with pytest.raises(OSError):
        builds.build_tracked(spark, out, [str(source)], die, {"x": 1}, additive=True)
    assert sorted(r.v for r in builds.read_build(spark, out).collect()) == [2, 4, 10, 12]
    assert run(parameters={"x": 1}) == ("extended", 1, 5, [2, 4, 10, 12, 14])
    assert builds.build_tracked(spark, out, [str(source)], build, {"x": 1}, additive=False).decision == "skipped"
