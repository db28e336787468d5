"""Shards by bytes: laws and groups."""

import zlib

import pytest

from zoneflow.llm import sharding


def check(rows, docs, shards):
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=str) == sorted(
        ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs), key=str
    )
    total = sum(r.size for r in rows)
    largest = max((r.size for r in rows), default=0)
    for s in range(shards):
        mine = [r for r in rows if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        assert abs(sum(r.size for r in mine) - total / shards) <= largest + 0.04 * total / shards + 1


@pytest.mark.parametrize("hot", [0, 400])
def test_laws(spark, hot):
    docs = [(i, "é" * (i % 97) + str(i)) for i in range(800)] + [(1000 + i, "copy of one text") for i in range(hot)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = sharding.assign(df, 8).collect()
    check(rows, docs, 8)
    again = sharding.assign(df.repartition(5), 8).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_equal_texts_stay_together(spark):
    docs = [(i, f"text {i // 3}") for i in range(3000)]
    rows = sharding.assign(spark.createDataFrame(docs, "doc_id long, text string"), 4).collect()
    by_text = {}
    for r in rows:
        by_text.setdefault(r.doc_id // 3, set()).add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())


def test_defined_cases(spark):
    docs = [(1, None), (1, None), (None, "a"), (2, ""), (3, "x" * 100_000)]
    df = spark.createDataFrame([(*d, 9) for d in docs], "doc_id long, text string, shard int")
    rows = sharding.assign(df, 3).collect()
    assert len(rows) == 5 and {r.shard for r in rows} <= {0, 1, 2}
    for s in range(3):
        mine = sorted(r.slot for r in rows if r.shard == s)
        assert mine == list(range(len(mine)))
    assert sharding.assign(df.limit(0)).count() == 0


def test_write(spark, tmp_path):
    docs = [(i % 90, f"text {i}") for i in range(100)] + [(None, None), (5, "text 5")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    sharding.write(df, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, [(r.doc_id, r.text) for r in back.collect()])) == sorted(map(str, docs))
