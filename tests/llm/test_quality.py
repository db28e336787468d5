"""Quality classifier: held-out accuracy, and scores against a plain computation."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa

from zoneflow.llm import quality
from zoneflow.llm import words as wd


def texts(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        good = rng.random() < 0.7
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 120))]
        text = " ".join(words) + "." if good else " | ".join(words)
        if not good and rng.random() < 0.3:
            text = " ".join(w for w in words for _ in range(3))
        out.append((i, text, int(good)))
    return out


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t, "label", 1.0) for i, t, _ in rows], "doc_id long, text string, quality string, score double")
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")


def test_held_out_accuracy(spark):
    rows = texts(800)
    docs, labels = frames(spark, rows)
    model = quality.fit(docs.select("doc_id", "text"), labels.where(~quality.held_out()))
    scored = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    held = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 100 and np.mean([(scored[i] >= 0.3) == y for i, y in held]) > 0.97
    again = quality.fit(docs.select("doc_id", "text").repartition(5), labels.where(~quality.held_out()).repartition(3))
    assert np.array_equal(model.weights, again.weights) and model.bias == again.bias


def test_score_is_the_mean_weight(spark):
    p = quality.Params(buckets=64)
    model = quality.Model(np.append(np.random.default_rng(0).normal(size=64), 0.0), 0.2, 3.0)
    for text in ["a b a b c", "x", "a a a", "one, two"]:
        w = next(wd.words_of(pa.array([text]), wd.SPACED_WORDS, kinds=wd.TOKEN_KINDS))
        grams = [g for g in quality.ngrams(w, p.buckets).reshape(-1) if g < 64]
        want = 1 / (1 + math.exp(-(0.2 + 3.0 * np.mean([model.weights[g] for g in grams]))))
        assert abs(quality.scores(pa.array([text]), model)[0] - want) < 1e-12


def test_ngrams_of_one_text_do_not_see_its_neighbours():
    together = next(wd.words_of(pa.array(["a b", "b a a"]), wd.SPACED_WORDS, kinds=wd.TOKEN_KINDS))
    alone = next(wd.words_of(pa.array(["b a a"]), wd.SPACED_WORDS, kinds=wd.TOKEN_KINDS))
    assert np.array_equal(quality.ngrams(together, 1024)[:, 2:], quality.ngrams(alone, 1024))


def test_defined_cases(spark):
    docs, labels = frames(spark, texts(100))
    model = quality.fit(docs.select("doc_id", "text"), labels)
    odd = spark.createDataFrame(
        [(1, None), (2, ""), (3, " "), (None, "a b"), (4, "a b"), (4, "a b"), (5, "w1 " * 50_000)], "doc_id long, text string"
    )
    rows = [(r.doc_id, r.score) for r in quality.score(odd, model).collect()]
    bias = 1 / (1 + math.exp(-model.bias))
    assert [s for i, s in rows if i in (1, 2, 3)] == [bias] * 3
    assert len({s for i, s in rows if i in (None, 4)}) == 1 and len(rows) == 7
    kept = quality.accepted(odd, model, 0.0)
    assert kept.count() == 7 and kept.columns == odd.columns
    assert quality.accepted(odd, model, 1.1).count() == 0
    assert quality.score(odd.limit(0), model).count() == 0


def test_no_labels(spark):
    docs, labels = frames(spark, texts(5))
    model = quality.fit(docs.select("doc_id", "text"), labels.where("false"))
    assert {r.score for r in quality.score(docs, model).collect()} == {0.5}
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 7)], "doc_id long, quality int")
    assert quality.fit(docs.select("doc_id", "text"), odd).bias == 0.0
