"""The levelled log of keyed changes against a dictionary."""

import random
from pathlib import Path

import pytest

from zoneflow.sources import changelog as cl

SCHEMA = "k string, n long, v long"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def state(log):
    return {(r.k, r.n): r.v for r in log.read().collect()}


def files_read(log):
    return len(log.read().inputFiles())


def test_many_batches(spark, tmp_path):
    """The state follows the batches, and a read opens no more files after 50 batches than levels allow."""
    rng = random.Random(4)
    log = cl.ChangeLog(spark, str(tmp_path / "log"), ["k", "n"], buckets=2, fan=3)
    expected, most = {}, 0
    for batch in range(50):
        rows = [(rng.choice(["a", "b", None]), rng.randrange(6), rng.randrange(1000)) for _ in range(5)]
        assert log.append(frame(spark, rows), batch, ["v"])
        best = {}
        for k, n, v in rows:
            best[k, n] = max(v, best.get((k, n), -1))
        expected |= best
        most = max(most, len(log.manifest()[1].runs))
        if batch % 10 == 9:
            assert state(log) == expected
    # 50 batches in base 3 are four digits of at most 2.
    assert most <= 2 * 4 and files_read(log) <= most * 2
    assert len(list(Path(tmp_path / "log/runs").iterdir())) > 50


def test_retries_and_tags(spark, tmp_path):
    log = cl.ChangeLog(spark, str(tmp_path / "log"), ["k"], fan=2)
    with pytest.raises(ValueError, match="holds no batch"):
        log.read()
    assert log.append(frame(spark, [("a", 1, 1), ("b", 1, 1)]), 0, ["v"])
    assert log.append(frame(spark, [("b", 1, 2), ("b", 2, 3), ("c", 1, 4)]), 1, ["v"], tag="run-1")
    for batch in (0, 1):
        assert not log.append(frame(spark, [("a", 9, 9)]), batch, ["v"])
    assert {r.k: (r.n, r.v, r[cl.TAG]) for r in log.read().collect()} == {
        "a": (1, 1, None), "b": (2, 3, "run-1"), "c": (1, 4, "run-1")
    }
    with pytest.raises(ValueError, match="order"):
        log.append(frame(spark, []), 2, [])
    with pytest.raises(ValueError, match="has not"):
        log.append(spark.createDataFrame([("a", 1)], "k string, other int"), 2, ["other"])
    with pytest.raises(ValueError, match="keeps the last"):
        cl.ChangeLog(spark, log.path, ["k"], keep=cl.FIRST).read()
    assert log.append(spark.createDataFrame([("a", 7)], "k string, v int"), 5, ["v"]) and log.append(frame(spark, []), 6, ["v"])
    assert {r.k: (r.n, r.v) for r in log.read().collect()} == {"a": (None, 7), "b": (2, 3), "c": (1, 4)}


def test_first_batch_keeps_the_key(spark, tmp_path):
    log = cl.ChangeLog(spark, str(tmp_path / "log"), ["k"], fan=2, keep=cl.FIRST)
    for batch in range(6):
        log.append(frame(spark, [("a", batch, batch), (f"b{batch % 3}", batch, batch)]), batch, ["v"])
    assert {r.k: r.v for r in log.read().collect()} == {"a": 0, "b0": 0, "b1": 1, "b2": 2}


def test_crash_before_the_manifest(spark, tmp_path, monkeypatch):
    """A batch that dies after its merge was written, or while its manifest is, leaves the log as it was."""
    log = cl.ChangeLog(spark, str(tmp_path / "log"), ["k"], fan=2)
    log.append(frame(spark, [("a", 1, 1), ("b", 1, 1)]), 0, ["v"])
    before = state(log)

    def die(_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(log, "_commit", die)
        with pytest.raises(OSError):
            log.append(frame(spark, [("a", 1, 2)]), 1, ["v"])
    (tmp_path / "log/manifest/000000000002").write_text('{"key": ["k"], "buck')
    again = cl.ChangeLog(spark, log.path, ["k"], fan=2)
    assert state(again) == before
    assert again.append(frame(spark, [("a", 1, 2)]), 1, ["v"])
    assert state(again) == {("a", 1): 2, ("b", 1): 1}
    assert len(again.vacuum(keep_versions=1)) == 4 and state(again) == {("a", 1): 2, ("b", 1): 1}


def test_two_writers(spark, tmp_path, monkeypatch):
    log = cl.ChangeLog(spark, str(tmp_path / "log"), ["k"])
    log.append(frame(spark, [("a", 1, 1)]), 0, ["v"])
    monkeypatch.setattr(log, "versions", lambda: [])
    with pytest.raises(cl.Conflict):
        log._commit(log._start)


def test_lookup_reads_only_its_buckets(spark, tmp_path):
    log = cl.ChangeLog(spark, str(tmp_path / "log"), ["k"], buckets=16, fan=3)
    for batch in range(4):
        log.append(frame(spark, [(f"k{i}", batch, i) for i in range(100)]), batch, ["v"])
    found = log.lookup(spark.createDataFrame([("k7",), ("k7",), ("none",), (None,)], "k string"))
    assert [(r.k, r.n, r.v) for r in found.collect()] == [("k7", 3, 7)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_bucket" in plan.split("PartitionFilters")[1].split("]")[0]


def test_tasks_that_write_a_large_bucket_are_bounded(spark, tmp_path):
    """A bucket larger than a task should hold is written by several."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "64k")
    try:
        log = cl.ChangeLog(spark, str(tmp_path / "log"), ["k"], buckets=1)
        rows = spark.range(60_000).selectExpr("id as k", "uuid() as v")
        log.append(rows, 0, ["v"])
    finally:
        spark.conf.set(name, before)
    assert len(list((tmp_path / "log").rglob("*.parquet"))) > 1
    assert log.read().count() == 60_000
