"""Manifests and proofs against a plain build of all levels."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from zoneflow.llm import manifest as mf


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def plain(rows):
    """{(source, leaf): (subroot, root, digest of the siblings)} for rows of (source, number, leaf)."""
    key = lambda s: (s is not None, (s or "").encode())
    sources = sorted({r[0] for r in rows}, key=key)
    number = lambda r: (r[1] is not None, r[1] or 0, r[2])
    trees = {s: levels([r[2] for r in sorted((r for r in rows if r[0] == s), key=number)]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    out = {}
    for n, s in enumerate(sources):
        for place, leaf in enumerate(trees[s][0]):
            siblings = []
            for tree, at in ((trees[s], place), (top, n)):
                for level in tree[:-1]:
                    siblings += [x for i, x in enumerate(level) if i // 3 == at // 3 and i != at]
                    at //= 3
            out[s, leaf] = (trees[s][-1][0], top[-1][0], sha("".join(siblings)))
    return out


def leaves(spark, rows):
    df = spark.createDataFrame(rows, "source string, doc_id long, tree int").withColumn("root", F.lit("?"))
    return df.withColumn("leaf", mf.leaf_digest(["doc_id", "source"])).withColumn("seen", F.col("leaf"))


@pytest.mark.parametrize("sizes", [[400, 1, 2, 3, 4, 9, 10, 28, 81, 82], [1], [1] * 30, [100], [3, 1], []])
def test_proofs(spark, sizes):
    rng = random.Random(3)
    rows = [(None if s == 2 else f"s{s}é", i, 7) for s, n in enumerate(sizes) for i in rng.sample(range(9999), n)]
    made = mf.build(leaves(spark, rows), "source", ["doc_id", "leaf"])
    found = mf.check(made, "seen").collect()
    want = plain([(s, i, leaf_of(s, i)) for s, i, _ in rows])
    assert {(r.source, r.leaf): (r.subroot, r.root, r.proof_sha256) for r in found} == want
    assert len(found) == len(rows) and all(r.verified and r.folded_root == r.root for r in found)


def leaf_of(source, number):
    value = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(value(number) + value(source))


def test_defined_cases(spark):
    """Rows without a number, repeated rows, null sources, tampered rows; a column that is named like an own one stays."""
    rows = [("a", None, 1), ("a", 5, 2), ("a", 5, 2), (None, 1, 3), (None, None, 3), ("", 1, 4), *(("b", i, i) for i in range(40))]
    df = leaves(spark, rows).withColumn("seen", F.when(F.col("doc_id") == 7, F.lit("0" * 64)).otherwise(F.col("leaf")))
    found = mf.check(mf.build(df, "source", ["doc_id", "leaf"]), "seen").collect()
    want = plain([(s, i, leaf_of(s, i)) for s, i, _ in rows])
    assert len(found) == len(rows)
    for r in found:
        assert r.verified == (r.doc_id != 7) and r.root == next(iter(want.values()))[1]
        assert r.subroot == want[r.source, r.leaf][0]
        if (r.source, r.doc_id) != ("a", 5):
            assert r.proof_sha256 == want[r.source, r.leaf][2]
    assert sorted(r.tree for r in found) == sorted(t for _, _, t in rows)


def test_leaf_digest(spark):
    long = "é" * 300_000
    df = spark.createDataFrame([(1, None, ""), (None, long, "x")], "a long, b string, c string")
    got = [r[0] for r in df.select(mf.leaf_digest(["a", "b", "c"])).collect()]
    assert got == [sha("1:1-0:"), sha(f"-600000:{long}1:x")]
