"""Cells of a mart by slice against the mart over all rows."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from zoneflow.operators import marts, partials

SCHEMA = (
    "period string, year int, month int, zone_id string, date date, hour int, is_weekend boolean, "
    "is_after_hours boolean, high_demand_flag long, demand_count long"
)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    data = []
    for day in range(1, 29):
        for month in (1, 2, 3):
            for zone in ("A", "B", None, "C"):
                for hour in rng.sample(range(24), 6):
                    n = rng.choice([1, 2, 3, 7, 40]) * (5 if zone == "C" else 1)
                    data.append((f"2024-0{month}", 2024, month, zone, f"2024-0{month}-{day:02d}", hour, day % 7 < 2, hour > 17, n > 9, n))
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    df = spark.createDataFrame(data, ", ".join(f"{c} {'long' if c in ('year', 'month', 'hour', 'demand_count') else 'boolean' if c.startswith(('is_', 'high')) else 'string'}" for c in columns))
    return df.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in SCHEMA.split(", ")])


def table(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def slices(rows, mart):
    for n in range(3):
        mart.write_slice(rows.where(F.dayofmonth("date") % 3 == n), f"d/{n}")


def test_replaced_slice(spark, rows, tmp_path):
    """Slices whose periods overlap add up; a replaced one changes its own files only."""
    mart = partials.CellMart(spark, str(tmp_path))
    slices(rows, mart)
    mart.write_slice(rows.where("false"), "empty")
    assert table(mart.summary()) == table(marts.zone_summary(rows))
    assert table(mart.summary(marts.PERIOD)) == table(marts.zone_summary(rows, marts.PERIOD))
    view = ("2024-03", "2024-02", marts.WEEKEND)
    assert table(mart.summary((), *view)) == table(marts.view(rows, *view))

    files = lambda: {p: p.stat().st_mtime_ns for p in Path(tmp_path).rglob("*.parquet")}
    before = files()
    changed = rows.where((F.dayofmonth("date") % 3 == 1) & (F.col("hour") < 12)).withColumn("demand_count", F.lit(3).cast("long"))
    mart.write_slice(changed, "d/1")
    after = files()
    stayed = {p for p in before if "1" not in str(p).split("_slice=")[1].split("/")[0]}
    assert all(after[p] == before[p] for p in stayed) and len(stayed) >= 4
    want = rows.where(F.dayofmonth("date") % 3 != 1).unionByName(changed)
    assert table(mart.summary(marts.PERIOD)) == table(marts.zone_summary(want, marts.PERIOD))


def test_views_read_cells_only(spark, rows, tmp_path):
    mart = partials.CellMart(spark, str(tmp_path))
    slices(rows, mart)
    for df in (mart.summary(start="2024-02", end="2024-02"), mart.distribution()):
        assert all("/hours/" in f or "/sketches/" in f for f in df.inputFiles())
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan
    assert "PushedFilters: [IsNotNull(period)" in mart.summary(start="2024-02", end="2024-02")._jdf.queryExecution().executedPlan().toString()


def test_distribution(spark, rows, tmp_path):
    mart = partials.CellMart(spark, str(tmp_path))
    slices(rows, mart)
    found = {r.zone_id: r for r in mart.distribution(start="2024-01", end="2024-02").collect()}
    chosen = marts.in_periods(rows, "2024-01", "2024-02").collect()
    assert set(found) == {"A", "B", "C", None}
    for zone, r in found.items():
        mine = sorted(x.demand_count for x in chosen if x.zone_id == zone)
        assert r.zone_hours == len(mine)
        for name, q in (("p50", 0.5), ("p75", 0.75), ("p95", 0.95)):
            below, upto = (sum(test(v) for v in mine) / len(mine) for test in (lambda v: v < r[name], lambda v: v <= r[name]))
            assert below <= q + 0.02 and upto >= q - 0.02
        assert abs(r.active_days - len({x.date for x in chosen if x.zone_id == zone})) <= 2
    overall = mart.distribution(by=["is_weekend"]).collect()
    assert sum(r.zone_hours for r in overall) == rows.count()
