"""MinHash near-duplicate detection: universal hash minima, banding, verification on full sets, star components."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm import words as wd
from zoneflow.llm.components import connected_components
from zoneflow.llm.scratch import Scratch

CHUNK = 1024  # members of a bucket that one task compares with as many others
CHUNK_SHINGLES = 500_000  # and about the shingles that they have
SIGMAS = 5  # a pair is dropped on its signature only this many standard deviations below the threshold


@dataclass(frozen=True)
class Params:
    """Shingle length in words, similarity in hundredths, and the shape of the signature.

    A pair exactly at the threshold is missed with probability ``(1 - s**rows) ** bands``: 4e-7 for 0.85 with 4 x 20,
    4e-7 for 0.8 with 4 x 28.
    """

    shingle: int = 5
    percent: int = 80
    rows: int = 4
    bands: int = 28

    @property
    def hashes(self) -> int:
        return self.rows * self.bands

    @property
    def least_agreement(self) -> int:
        s, m = self.percent / 100, self.hashes
        return max(0, math.floor(m * s - SIGMAS * math.sqrt(m * s * (1 - s))))

    def multipliers(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(20240229)
        a = rng.integers(0, 2**32, self.hashes, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
        return a, rng.integers(0, 2**32, self.hashes, dtype=np.uint64).astype(np.uint32)


SKETCH = "n_shingles long, k1 long, k2 long, bands array<long>, signature array<int>"


def set_keys(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums over each set; with the set's size they identify it."""
    return np.add.reduceat(values, starts), np.add.reduceat(wd.mix(values ^ np.uint64(0xA5A5A5A55A5A5A5A)), starts)


def band_keys(signature: np.ndarray, p: Params) -> np.ndarray:
    """(sets x bands) keys: each folds the band's minima and its number."""
    minima = signature.reshape(len(signature), p.bands, p.rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, p.bands + 1, dtype=np.uint64), minima.shape[:2]).copy()
    for j in range(p.rows):
        key = wd.mix(key * np.uint64(0x9E3779B97F4A7C15) + minima[:, :, j])
    return key


def signatures(values: np.ndarray, starts: np.ndarray, p: Params) -> np.ndarray:
    """(sets x hashes) minima of ``a * x + b`` modulo 2**32 over each set."""
    x = (values >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), p.hashes), dtype=np.uint32)
    buffer = np.empty_like(x)
    for j, (a, b) in enumerate(zip(*p.multipliers(), strict=True)):
        np.multiply(x, a, out=buffer)
        np.add(buffer, b, out=buffer)
        out[:, j] = np.minimum.reduceat(buffer, starts)
    return out


def lists(matrix: np.ndarray, present: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows of ``matrix`` as lists for the rows marked present, empty lists for the others."""
    offsets = np.concatenate([[0], np.cumsum(np.where(present, matrix.shape[1], 0))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).reshape(-1), type=kind))


def sketch(docs: DataFrame, p: Params, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, n_shingles, k1, k2, bands, signature`` of every row; a text without words has empty lists."""
    picked = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in wd.parts(batches):
            for w in wd.words_of(batch.column(1), wd.SPACED_WORDS, 250_000):
                sets = [wd.shingle_set(w.hashes[a:b], p.shingle) for a, b in zip(w.bounds, w.bounds[1:])]
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                present = sizes > 0
                values = np.concatenate(sets)
                starts = (np.cumsum(sizes) - sizes)[present]
                k1, k2 = np.zeros(w.n, np.int64), np.zeros(w.n, np.int64)
                signature = np.zeros((0, p.hashes), dtype=np.uint32)
                if len(values):
                    one, two = set_keys(values, starts)
                    k1[present], k2[present] = one.view(np.int64), two.view(np.int64)
                    signature = signatures(values, starts, p)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(w.first_row, w.n),
                        pa.array(sizes),
                        pa.array(k1),
                        pa.array(k2),
                        lists(band_keys(signature, p).view(np.int64), present, pa.int64()),
                        lists(signature.view(np.int32), present, pa.int32()),
                    ],
                    names=["id", "n_shingles", "k1", "k2", "bands", "signature"],
                )

    return picked.mapInArrow(run, f"id {picked.schema['id'].dataType.simpleString()}, {SKETCH}")


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """``id, k1, k2, shingles`` of ``docs(id, text)`` rows that have words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in wd.parts(batches):
            for w in wd.words_of(batch.column(1), wd.SPACED_WORDS, 1_000_000):
                rows = np.flatnonzero(np.diff(w.bounds))
                if not len(rows):
                    continue
                sets = [wd.shingle_set(w.hashes[w.bounds[i] : w.bounds[i + 1]], k) for i in rows]
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                values = np.concatenate(sets)
                k1, k2 = set_keys(values, offsets[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(w.first_row, w.n).take(pa.array(rows)),
                        pa.array(k1.view(np.int64)),
                        pa.array(k2.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64))),
                    ],
                    names=["id", "k1", "k2", "shingles"],
                )

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, k1 long, k2 long, shingles array<long>")


def buckets(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Band rows ``(key, id)`` and, for buckets of two or more items, ``(key, pivot, members)``.

    The pivot is the least ``id xor key``, so each bucket has a pivot of its own and no id is every bucket's pivot.
    """
    rows = items.select("id", F.explode("bands").alias("key"))
    mixed = F.col("id").bitwiseXOR(F.col("key"))
    found = (
        rows.groupBy("key")
        .agg(F.min(mixed).alias("low"), F.max(mixed).alias("high"), F.count("*").alias("members"))
        .where("low <> high")
        .select("key", F.col("low").bitwiseXOR(F.col("key")).alias("pivot"), "members")
    )
    return rows, found


def ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def similar_signatures(pairs: DataFrame, items: DataFrame, p: Params) -> DataFrame:
    """Pairs whose sizes and signatures allow the threshold."""
    side = items.select("id", "n_shingles", "signature")
    both = pairs.join(side.toDF("a", "na", "sa"), "a").join(side.toDF("b", "nb", "sb"), "b")
    sizes = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * p.percent
    agree = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return both.where(sizes).where(agree >= p.least_agreement).select("a", "b")


def similar_sets(pairs: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """Pairs ``(a, b)`` whose full shingle sets reach the similarity."""
    side = sets.select("id", "shingles")
    both = pairs.join(side.toDF("a", "x"), "a").join(side.toDF("b", "y"), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.withColumn("shared", shared).where(
        F.col("shared") * 100 >= (F.size("x") + F.size("y") - F.col("shared")) * p.percent
    ).select("a", "b")


def deal(members: DataFrame, chunks: str, columns: list[str]) -> DataFrame:
    """One row for each pair of chunks of a bucket, with its members' columns as lists; ``own`` is a member's chunk.

    ``chunks`` is the bucket's number of chunks, so a row is bounded however large the bucket is.
    """
    placed = members.withColumn("own", F.pmod(F.xxhash64("id"), F.col(chunks).cast("long")).cast("int"))
    return (
        placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(chunks) - 1)))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .groupBy("key", "i", "j")
        .agg(F.collect_list(F.struct("own", *columns)).alias("m"))
        .select("key", "i", "j", F.col("m.own").alias("own"), *[F.col(f"m.{c}").alias(c) for c in columns])
    )


def list_column(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    values = batch.column(name)[row].values
    if pa.types.is_list(values.type):
        return values.flatten().to_numpy(zero_copy_only=False)
    return values.to_numpy(zero_copy_only=False)


class _Bucket:
    """Members of one pair of chunks of a bucket, and which of them may be linked although they are not yet."""

    def __init__(self, batch: pa.RecordBatch, row: int, p: Params):
        self.p = p
        self.ids, self.component = list_column(batch, "id", row), list_column(batch, "component", row).copy()
        self.n, own = list_column(batch, "n_shingles", row), list_column(batch, "own", row)
        self.signature = list_column(batch, "signature", row).reshape(len(self.ids), -1)
        bands = list_column(batch, "bands", row).reshape(len(self.ids), -1)
        self.earlier = bands[:, : int(np.argmax(bands[0] == batch.column("key")[row].as_py()))]
        i, j = batch.column("i")[row].as_py(), batch.column("j")[row].as_py()
        self.left = np.flatnonzero(own == i)
        self.right = np.flatnonzero(own == j)
        self.inner = i == j

    def open_partners(self, x: int) -> np.ndarray:
        """Members of other components that this bucket is the first to bring to ``x`` and that may be similar."""
        p = self.p
        y = self.right[self.right > x] if self.inner else self.right
        y = y[self.component[y] != self.component[x]]
        y = y[np.minimum(self.n[y], self.n[x]) * 100 >= np.maximum(self.n[y], self.n[x]) * p.percent]
        y = y[~(self.earlier[y] == self.earlier[x]).any(axis=1)]
        return y[(self.signature[y] == self.signature[x]).sum(axis=1) >= p.least_agreement]


def open_members(members: DataFrame, p: Params) -> DataFrame:
    """``key, id`` of members that may be similar to a member of another component of their bucket."""
    dealt = deal(members, "chunks", ["id", "component", "n_shingles", "signature", "bands"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                bucket = _Bucket(batch, row, p)
                seen = np.zeros(len(bucket.ids), dtype=bool)
                for x in bucket.left:
                    y = bucket.open_partners(x)
                    seen[y] = True
                    seen[x] |= len(y) > 0
                ids = bucket.ids[seen]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), batch.column("key")[row].as_py())), pa.array(ids)], names=["key", "id"]
                )

    return dealt.mapInArrow(run, "key long, id long").distinct()


def open_links(members: DataFrame, p: Params) -> DataFrame:
    """``a, b``: links between components within buckets, confirmed on the full ``shingles`` of the members.

    Pairs are compared in the task that holds them.  Of the links found, those that join what the task has not joined
    yet are emitted, at most one less than the members, so a group of n copies never makes n * n rows.
    """
    dealt = deal(members, "chunks", ["id", "component", "n_shingles", "signature", "bands", "shingles"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield _links_of(_Bucket(batch, row, p), list_column(batch, "shingles", row))

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _links_of(bucket: _Bucket, shingles: np.ndarray) -> pa.RecordBatch:
    ends = np.cumsum(bucket.n)
    _, shingle = np.unique(shingles, return_inverse=True)
    order = np.argsort(shingle, kind="stable")
    holder = np.repeat(np.arange(len(ends)), bucket.n)[order]
    sizes = np.bincount(shingle)
    begins = np.cumsum(sizes) - sizes
    found = []
    for x in bucket.left:
        y = bucket.open_partners(x)
        if not len(y):
            continue
        own = shingle[ends[x] - bucket.n[x] : ends[x]]
        counts = sizes[own]
        at = np.repeat(begins[own] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        shared = np.bincount(holder[at], minlength=len(ends))[y]
        y = y[shared * 100 >= (bucket.n[x] + bucket.n[y] - shared) * bucket.p.percent]
        for other in y:
            if bucket.component[other] != bucket.component[x]:
                bucket.component[bucket.component == bucket.component[other]] = bucket.component[x]
                found.append((min(bucket.ids[x], bucket.ids[other]), max(bucket.ids[x], bucket.ids[other])))
    pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def link_classes(classes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], p: Params, scratch: Scratch) -> DataFrame:
    """``node, component`` of the linked ``classes(id, n_shingles, bands, signature)``; ids are distinct.

    ``sets_of`` gives ``id, shingles`` for a frame of ids; it is asked only for classes that share a band.
    """
    rows, full = buckets(classes)
    full = scratch.keep(full)
    members = scratch.keep(rows.join(full, "key"))
    stars = members.where("id <> pivot").select(*ordered("id", "pivot")).distinct()
    pairs = scratch.keep(similar_signatures(stars, classes, p))
    sets = scratch.keep(
        sets_of(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct())
    )
    links = scratch.keep(similar_sets(pairs, sets, p))
    scratch.drop(pairs, sets)
    first = scratch.keep(connected_components(links, scratch))

    joined = (
        members.where("members > 2")
        .join(classes.select("id", "n_shingles"), "id")
        .join(first.withColumnRenamed("node", "id"), "id", "left")
        .select("key", "id", F.coalesce("component", "id").alias("component"), "n_shingles")
    )
    joined = scratch.keep(joined)
    mixed = joined.groupBy("key").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("m"), F.sum("n_shingles").alias("s")
    )
    chunks = F.ceil(F.greatest(F.col("m") / CHUNK, F.col("s") / CHUNK_SHINGLES)).cast("int")
    placed = joined.join(mixed.where("x <> y").select("key", chunks.alias("chunks")), "key")
    side = classes.select("id", "signature", "bands")
    waiting = scratch.keep(open_members(placed.join(side, "id"), p))
    rest = placed.join(waiting, ["key", "id"], "left_semi").join(side, "id")
    sets = scratch.keep(sets_of(waiting.select("id").distinct()))
    more = scratch.keep(open_links(rest.join(sets.select("id", "shingles"), "id"), p))
    known = first.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    last = scratch.keep(connected_components(known.union(more), scratch))
    scratch.drop(joined, members, full, sets, waiting)
    return last


def near_duplicates(docs: DataFrame, p: Params, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``.

    1. Rows are sketched; rows with equal shingle sets become one class, named by its smallest id.
    2. Classes that share a band are linked to the bucket's pivot and verified, first on the signatures, then on
       the full sets.  A bucket of m classes gives m - 1 pairs.
    3. Buckets whose classes are then still in several components are searched for the remaining links.
    4. Links become components by large-star and small-star.

    Defined cases: a null, empty or blank text has no shingles and links with nothing; a text of fewer words than a
    shingle has one shingle, its whole sequence; repeated rows get the same component; a row without an id links with
    nothing, has a null component and is kept; rows that share an id are one document, linked with whatever one of them
    is like; an empty table gives no rows.  Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    sketches = scratch.keep(sketch(docs, p, id_column, text_column))
    found = sketches.where("id is not null and n_shingles > 0")
    classes = scratch.keep(
        found.groupBy("k1", "k2", "n_shingles").agg(
            F.min("id").alias("id"), F.first("bands").alias("bands"), F.first("signature").alias("signature")
        )
    )
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def sets_of(ids: DataFrame) -> DataFrame:
        wanted = classes.select("id", "k1", "k2").join(ids, "id", "left_semi")
        return (
            shingle_sets(texts.join(wanted.select("id").distinct(), "id", "left_semi"), p.shingle)
            .join(wanted, ["id", "k1", "k2"], "left_semi")
            .dropDuplicates(["id", "k1", "k2"])
        )

    last = link_classes(classes, sets_of, p, scratch)
    named = classes.select("k1", "k2", "n_shingles", "id").join(last, F.col("id") == F.col("node"), "left").select(
        "k1", "k2", "n_shingles", F.coalesce("component", "id").alias("component_id")
    )
    result = sketches.select(F.col("id").alias(id_column), "n_shingles", "k1", "k2").join(
        named, ["k1", "k2", "n_shingles"], "left"
    )
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col(id_column))
    component = F.when(F.col(id_column).isNotNull(), component)
    return result.select(id_column, "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(id_column) == F.col("component_id"), F.lit(True))
    )


def keep_one(docs: DataFrame, p: Params, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows of ``docs`` with one document for each group of near duplicates: that of the smallest id.

    Defined cases: rows that share an id are one document, so they stay or go together, and of those that share their
    text too one stays; rows without an id and texts without words are all kept; an empty table gives no rows.  Columns
    of any name are returned as they are.
    """
    marked = near_duplicates(docs, p, id_column, text_column)
    kept = marked.where(F.col("kept") & F.col(id_column).isNotNull()).select(id_column).distinct()
    named = docs.where(F.col(id_column).isNotNull()).join(kept, id_column, "left_semi")
    named = named.dropDuplicates([id_column, text_column])
    return named.unionByName(docs.where(F.col(id_column).isNull())).select(*docs.columns)
