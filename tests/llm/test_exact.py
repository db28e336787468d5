"""Exact duplicates against a plain grouping, also with keys that collide."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from zoneflow.llm import exact as ex


def plain(docs):
    groups = defaultdict(list)
    norm = lambda t: (t or "").encode().lower()
    for number, text in docs:
        groups[norm(text)].append(number)
    out = Counter()
    for number, text in docs:
        ids = [i for i in groups[norm(text)] if i is not None]
        keep = max(ids, default=None)
        kept = keep is None if number is None or keep is None else number == keep
        out[number, keep, len(groups[norm(text)]), kept, hashlib.sha256(norm(text)).hexdigest()] += 1
    return out


def material():
    rng = random.Random(2)
    make = lambda: " ".join(rng.choice("xyzXYZ") for _ in range(rng.randrange(1, 8)))
    docs = [(i, rng.choice(["a hot Text", "a HOT text", make(), make()])) for i in range(2500)]
    return docs + [(3000, None), (3001, ""), (None, "a hot text"), (None, "alone"), (3002, "Ä"), (3003, "ä"), (7, docs[7][1])]


CASES = [ex.Params(), ex.Params(2000, 8), ex.Params(2000, 8, 3), ex.Params(500, 4, 1), ex.Params(100, 0, 2)]


@pytest.mark.parametrize("p", CASES)
def test_groups(spark, p):
    docs = material()
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, bucket int")
    assert Counter(map(tuple, ex.find_duplicates(df, p).collect())) == plain(docs)


def test_directory(spark):
    """Buckets cover all keys once; those over the limit overflow only where one cell alone is over it."""
    p = ex.Params(2000, 8)
    docs = material()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    index = ex.build_index(df, p)
    buckets = sorted(map(tuple, index.directory.collect()))
    assert len(buckets) > 10
    covered = [cell for b, depth, _ in buckets for cell in range(b, b + 2 ** (p.max_depth - depth))]
    assert len(covered) == len(set(covered))
    slots = ex.slots(index.directory, p).collect()
    assert len(slots) == len({r.slot for r in slots}) <= 2 ** max(d for _, d, _ in buckets)
    size = Counter()
    for r in index.rows.select("id", "bucket", "part", "key").collect():
        size[r.bucket, r.part] += 1
    parts = {b: n for b, _, n in buckets}
    assert max(parts.values()) > 10 and all(part < parts[b] for b, part in size)
    assert max(size.values()) < 2 * 2000 / ex.ROW_BYTES


def test_long_and_empty(spark):
    long = "Ab" * 2_000_000
    docs = [(1, long), (2, long.lower()), (3, long + "c")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert Counter(map(tuple, ex.find_duplicates(df).collect())) == plain(docs)
    assert ex.find_duplicates(df.limit(0)).count() == 0
