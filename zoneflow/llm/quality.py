"""Quality classifier: logistic regression on hashed word n-grams, fitted by follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm import words as wd

REPEAT_LAGS = (1, 2, 3, 4)
SLICE = 1_000_000


@dataclass(frozen=True)
class Params:
    """``buckets`` hash buckets; ``sample`` bounds the labelled rows that are learned from, dealt to ``shards`` tasks.

    The sample holds the rows with the least hash of their id, so it does not depend on the layout of the tables.
    """

    buckets: int = 2**18
    sample: int = 20_000
    shards: int = 4
    epochs: int = 2
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 1e-6
    scale: float = 30.0


@dataclass(frozen=True)
class Model:
    """Weight of each bucket, then a zero for absent n-grams; at most ``buckets + 1`` numbers."""

    weights: np.ndarray
    bias: float
    scale: float


def ngrams(w: wd.Words, buckets: int) -> np.ndarray:
    """Bucket of the n-grams that start or end at each word, ``buckets`` where there is none.

    Words are runs of letters and digits or runs of other signs.  Rows: the word, the pair it starts, and for each lag
    the pattern "equal to the word so far before", which stands for all such n-grams whatever their words.
    """
    n = len(w.hashes)
    out = np.full((2 + len(REPEAT_LAGS), n), buckets, dtype=np.int64)
    if n == 0:
        return out
    mask = np.uint64(buckets - 1)
    text = w.text_of_word()
    out[0] = (w.hashes & mask).astype(np.int64)
    same = text[1:] == text[:-1]
    pair = (wd.shingle_hashes(w.hashes, 2) & mask).astype(np.int64)
    out[1, :-1] = np.where(same, pair, buckets)
    marks = wd.mix(np.arange(1, 1 + len(REPEAT_LAGS), dtype=np.uint64)) & mask
    for row, lag in enumerate(REPEAT_LAGS):
        again = (w.hashes[lag:] == w.hashes[:-lag]) & (text[lag:] == text[:-lag])
        out[2 + row, lag:][again] = int(marks[row])
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def ftrl(examples: list[np.ndarray], labels: np.ndarray, p: Params) -> np.ndarray:
    """Weights after ``epochs`` passes; the last is the bias.  An example is the array of its n-grams' buckets."""
    z, n = np.zeros(p.buckets + 1), np.zeros(p.buckets + 1)

    def weights(i):
        size = -(z[i] - np.sign(z[i]) * p.l1) / ((p.beta + np.sqrt(n[i])) / p.alpha + p.l2)
        return np.where(np.abs(z[i]) <= p.l1, 0.0, size)

    sparse = []
    for x in examples:
        i, c = np.unique(x, return_counts=True)
        sparse.append((np.append(i, p.buckets), np.append(p.scale * c / max(1, len(x)), 1.0)))
    order = np.random.default_rng(7)
    for _ in range(p.epochs):
        for k in order.permutation(len(sparse)):
            i, x = sparse[k]
            w = weights(i)
            g = (_sigmoid(w @ x) - labels[k]) * x
            s = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / p.alpha
            z[i] += g - s * w
            n[i] += g * g
    return weights(np.arange(p.buckets + 1))


def _learner(p: Params):
    def learn(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("place", "ascending"), ("id", "ascending"), ("label", "ascending")]).combine_chunks()
        examples = []
        for w in wd.words_of(rows["text"], wd.SPACED_WORDS, SLICE, wd.TOKEN_KINDS):
            grams = ngrams(w, p.buckets)
            for a, b in zip(w.bounds, w.bounds[1:]):
                own = grams[:, a:b].reshape(-1)
                examples.append(own[own < p.buckets])
        w = ftrl(examples, rows["label"].to_numpy(), p)
        used = np.flatnonzero(w)
        return pa.table(
            [pa.array(np.full(len(used), rows["shard"][0].as_py())), pa.array(used), pa.array(w[used])],
            names=["shard", "bucket", "weight"],
        )

    return learn


def fit(
    docs: DataFrame,
    labels: DataFrame,
    p: Params = Params(),
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> Model:
    """Learn from rows of ``labels`` that have a document and a label of 0 or 1.

    Each shard of the sample is learned by one task; the shards' weights are averaged.  Without usable labels all
    weights are zero and every score is 0.5.
    """
    bounded = (
        labels.where(F.col(id_column).isNotNull() & F.col(label_column).isin(0, 1))
        .select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label"))
        .withColumn("place", F.xxhash64("id"))
        .orderBy("place", "id", "label")
        .limit(p.sample)
    )
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    # At most ``sample`` ids and labels: a few hundred kilobytes.
    rows = texts.join(F.broadcast(bounded), "id").withColumn("shard", F.pmod("place", F.lit(p.shards)).cast("long"))
    learned = rows.groupBy("shard").applyInArrow(_learner(p), "shard long, bucket long, weight double").toArrow()
    learned = learned.sort_by([("shard", "ascending"), ("bucket", "ascending")])
    shards = max(1, len(learned["shard"].unique()))
    total = np.zeros(p.buckets + 1)
    np.add.at(total, learned["bucket"].to_numpy(), learned["weight"].to_numpy())
    total /= shards
    return Model(np.append(total[:-1], 0.0), float(total[-1]), p.scale)


def scores(column: pa.Array, model: Model) -> np.ndarray:
    """Score of each text: the logistic of the bias and the mean weight of its n-grams."""
    buckets = len(model.weights) - 1
    out = np.empty(len(column))
    for w in wd.words_of(column, wd.SPACED_WORDS, SLICE, wd.TOKEN_KINDS):
        grams = ngrams(w, buckets)
        full = np.flatnonzero(np.diff(w.bounds))
        total, count = np.zeros(w.n), np.ones(w.n)
        if len(full):
            starts = w.bounds[full]
            total[full] = np.add.reduceat(model.weights[grams].sum(axis=0), starts)
            count[full] = np.add.reduceat((grams < buckets).sum(axis=0), starts)
        out[w.first_row : w.first_row + w.n] = _sigmoid(model.bias + model.scale * total / count)
    return out


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, score`` of every row.

    Defined cases: a null or wordless text has the score of the bias alone; repeated rows have equal scores; a null id
    stays null; an empty table gives no rows.  Other columns are ignored.
    """
    picked = docs.select(F.col(id_column).alias(id_column), F.col(text_column).alias("_text"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in wd.parts(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores(batch.column(1), held.value))], names=[id_column, "score"]
            )

    return picked.mapInArrow(run, f"`{id_column}` {picked.schema[id_column].dataType.simpleString()}, score double")


def accepted(docs: DataFrame, model: Model, threshold: float, text_column: str = "text") -> DataFrame:
    """Rows of ``docs`` that score at least ``threshold``, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in wd.parts(batches):
            yield batch.filter(pa.array(scores(batch.column(place), held.value) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def held_out(id_column: str = "doc_id") -> F.Column:
    """Whether a row is kept from learning: its id's crc32 is a multiple of five.  A null id is not."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(False))
