"""Embedding near-duplicates with randomised-rotation binary codes.

A unit vector is rotated at random and kept as its signs and a correction factor.  The signs of one vector and the
rotated coordinates of another give an unbiased estimate of their inner product with a known error, so only pairs
whose upper bound reaches the threshold are computed exactly.  Runs of sign bits are band keys that bring pairs
together; the number of bands follows from the recall asked for at the threshold.

A vector has a row in every band, so these rows hold 16 bytes of signs and no more.  The number of signs in which two
vectors differ bounds their angle, which closes nearly all buckets; coordinates and vectors go to the members left.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.components import connected_components
from zoneflow.llm.minhash import CHUNK, deal, list_column
from zoneflow.llm.scratch import Scratch


CODE_BITS = 128  # signs that every band row carries, whatever the dimension and the number of bands
SMALL = 64  # members of a bucket whose pairs are laid out together with those of other buckets


@dataclass(frozen=True)
class Params:
    """``miss`` bounds the chance that a pair just at the threshold shares no band; closer pairs are missed less.

    ``sigmas`` is the width of the confidence bound of an estimate, in its standard deviations.
    """

    threshold: float = 0.9
    miss: float = 1e-3
    sigmas: float = 5.0
    per_bucket: int = 8  # vectors that chance brings into a bucket


@dataclass(frozen=True)
class Shape:
    """Bits of a band and number of bands."""

    bits: int
    bands: int

    @classmethod
    def of(cls, vectors: int, p: Params) -> Shape:
        bits = max(4, min(60, math.ceil(math.log2(max(2, vectors / p.per_bucket)))))
        agree = (1 - math.acos(p.threshold) / math.pi) ** bits
        return cls(bits, math.ceil(math.log(p.miss) / math.log(1 - agree)))


@functools.lru_cache(maxsize=8)
def rotations(dim: int, bits: int) -> np.ndarray:
    """Random orthogonal matrices side by side, enough columns for ``bits`` signs."""
    rng = np.random.default_rng(dim)
    parts = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-max(bits, dim) // dim))]
    return np.concatenate(parts, axis=1)


def encode(classes: DataFrame, s: Shape) -> DataFrame:
    """``id, copies, dim, vector, signs, coordinates, scale, factor, bands`` and codes of ``classes(id, copies, vector)``.

    ``signs`` holds the bits of all bands, the first ``dim`` of them those of the first rotation, and ``code_1`` and
    ``code_2`` the first ``CODE_BITS``, with those of further rotations if need be.  ``coordinates`` are
    the first rotation's, in 127ths of ``scale``.  ``factor`` is the inner product of the vector with its own code.
    """
    names = ["id", "copies", "dim", "vector", "signs", "coordinates", "scale", "factor", "bands", "code_1", "code_2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column("vector").value_lengths())
            for dim in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dim))
                x = part.column("vector").flatten().to_numpy().astype(np.float64).reshape(-1, dim)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                y = x @ rotations(int(dim), max(s.bits * s.bands, CODE_BITS))
                own = y[:, :dim]
                factor = np.abs(own).sum(axis=1) / math.sqrt(dim)
                scale = np.abs(own).max(axis=1)
                small = np.rint(own / scale[:, None] * 127).astype(np.int8)
                positive = (y[:, : max(s.bits * s.bands, int(dim))] > 0).astype(np.uint8)
                packed = np.packbits(positive, axis=1)
                codes = np.packbits(y[:, :CODE_BITS] > 0, axis=1).view(np.int64)
                weights = 1 << np.arange(s.bits, dtype=np.int64)
                bits = positive[:, : s.bits * s.bands].reshape(len(x), s.bands, s.bits).astype(np.int64)
                bands = ((bits @ weights) * s.bands + np.arange(s.bands)) * 4096 + dim % 4096
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), part.column("copies"), pa.array(np.full(len(x), dim, dtype=np.int32)),
                        part.column("vector"), _rows(packed), _rows(small.view(np.uint8)),
                        pa.array(scale), pa.array(factor),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(x) + 1, dtype=np.int32) * s.bands), pa.array(bands.reshape(-1))
                        ),
                        pa.array(codes[:, 0].copy()), pa.array(codes[:, 1].copy()),
                    ],
                    names=names,
                )

    kind = classes.schema["vector"].dataType.simpleString()
    return classes.mapInArrow(
        run,
        f"id long, copies long, dim int, vector {kind}, signs binary, coordinates binary, scale double, factor double, "
        "bands array<long>, code_1 long, code_2 long",
    )


def _rows(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    offsets = pa.py_buffer((np.arange(n + 1) * width).astype(np.int32).tobytes())
    return pa.BinaryArray.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(np.ascontiguousarray(matrix).tobytes())])


def _matrix(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    values = batch.column(name)[row].values
    return np.frombuffer(b"".join(values.to_pylist()), dtype=np.uint8).reshape(len(values), -1)


class _Bucket:
    """Codes of one pair of chunks of a bucket."""

    def __init__(self, batch: pa.RecordBatch, row: int, s: Shape, p: Params):
        self.ids, own = list_column(batch, "id", row), list_column(batch, "own", row)
        dim = int(list_column(batch, "dim", row)[0])
        bits = np.unpackbits(_matrix(batch, "signs", row), axis=1)
        self.signs = bits[:, :dim].astype(np.float32) * 2 - 1
        small = _matrix(batch, "coordinates", row).view(np.int8).astype(np.float32)
        self.coordinates = small * (list_column(batch, "scale", row)[:, None] / 127).astype(np.float32)
        factor = list_column(batch, "factor", row)
        self.unit = (1 / (math.sqrt(dim) * factor)).astype(np.float32)
        spread = np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(max(dim - 1, 1))
        self.error = (p.sigmas * spread * math.sqrt(1 - p.threshold**2) + 0.01).astype(np.float32)
        self.least = p.threshold
        band = (batch.column("key")[row].as_py() // 4096) % s.bands
        weights = 1 << np.arange(s.bits, dtype=np.int64)
        earlier = bits[:, : band * s.bits].reshape(len(bits), band, s.bits).astype(np.int64)
        self.earlier = earlier @ weights
        i, j = batch.column("i")[row].as_py(), batch.column("j")[row].as_py()
        self.left, self.right, self.inner = np.flatnonzero(own == i), np.flatnonzero(own == j), i == j

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs, in parts, that this band is the first to bring together and whose upper bound is high enough."""
        for at in range(0, len(self.left), 256):
            x = self.left[at : at + 256]
            one = (self.coordinates[x] @ self.signs[self.right].T) * self.unit[self.right]
            two = (self.signs[x] @ self.coordinates[self.right].T) * self.unit[x][:, None]
            near = (one + self.error[self.right] >= self.least) & (two + self.error[x][:, None] >= self.least)
            if self.inner:
                near &= self.right[None, :] > x[:, None]
            a, b = np.nonzero(near)
            a, b = x[a], self.right[b]
            for k in range(self.earlier.shape[1]):
                if not len(a):
                    break
                new = self.earlier[a, k] != self.earlier[b, k]
                a, b = a[new], b[new]
            yield a, b


def most_apart(p: Params) -> int:
    """Signs of a code in which two vectors at the threshold differ at most, but for a hundredth of ``miss``."""
    chance = min(max(math.acos(min(max(p.threshold, -1.0), 1.0)) / math.pi, 1e-12), 1 - 1e-12)
    above = 0.0
    for k in range(CODE_BITS, 0, -1):
        above += math.comb(CODE_BITS, k) * chance**k * (1 - chance) ** (CODE_BITS - k)
        if above > p.miss / 100:
            return k
    return 0


def _brought_together(lengths: np.ndarray, own: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator[tuple]:
    """Positions of the pairs of members that rows of dealt buckets hold, in bounded parts."""
    ends = np.cumsum(lengths)
    small = (lengths <= SMALL) & (i == j)
    row = np.repeat(np.arange(len(lengths)), lengths)
    one = np.flatnonzero(small[row])
    partners = ends[row[one]] - 1 - one
    until = np.cumsum(partners)
    for part in np.split(np.arange(len(one)), np.flatnonzero(np.diff(until // 500_000)) + 1):
        n = partners[part]
        a = np.repeat(one[part], n)
        yield a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
    for r in np.flatnonzero(~small):
        members = np.arange(ends[r] - lengths[r], ends[r])
        left, right = members[own[members] == i[r]], members[own[members] == j[r]]
        for at in range(0, len(left), 256):
            some = left[at : at + 256]
            a, b = np.repeat(some, len(right)), np.tile(right, len(some))
            keep = (a < b) if i[r] == j[r] else np.ones(len(a), dtype=bool)
            yield a[keep], b[keep]


def open_members(members: DataFrame, s: Shape, p: Params) -> DataFrame:
    """``key, id`` of vectors with a partner in their bucket whose code is near enough.

    A pair that a band within the code has brought together before is left to that band.  ``members`` are
    ``key, id, code_1, code_2, chunks``.
    """
    dealt = deal(members, "chunks", ["id", "code_1", "code_2"]).where(F.size("id") > 1)
    most, within = most_apart(p), min(s.bands, CODE_BITS // s.bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(s.bits, dtype=np.int64)
        for batch in batches:
            flat = {n: batch.column(n).flatten().to_numpy() for n in ("id", "own", "code_1", "code_2")}
            lengths = batch.column("id").value_lengths().to_numpy().astype(np.int64)
            keys = np.repeat(batch.column("key").to_numpy(), lengths)
            codes = np.stack([flat["code_1"], flat["code_2"]], axis=1).view(np.uint64)  # counts of bits need no sign
            bits = np.unpackbits(codes.view(np.uint8), axis=1)[:, : within * s.bits]
            bands = bits.reshape(len(codes), within, s.bits).astype(np.int64) @ weights
            band = (keys // 4096) % s.bands
            seen = np.zeros(len(keys), dtype=bool)
            for a, b in _brought_together(lengths, flat["own"], batch.column("i").to_numpy(), batch.column("j").to_numpy()):
                near = np.bitwise_count(codes[a] ^ codes[b]).sum(axis=1, dtype=np.int64) <= most
                a, b = a[near], b[near]
                for k in range(within):
                    new = (k >= band[a]) | (bands[a, k] != bands[b, k])
                    a, b = a[new], b[new]
                seen[a] = seen[b] = True
            yield pa.RecordBatch.from_arrays([pa.array(keys[seen]), pa.array(flat["id"][seen])], names=["key", "id"])

    return dealt.mapInArrow(run, "key long, id long").distinct()


CODES = ["id", "dim", "signs", "coordinates", "scale", "factor"]


def exact_links(members: DataFrame, s: Shape, p: Params) -> DataFrame:
    """Links by exact cosines: rows ``a, n`` add to the number of vectors linked to a, rows ``a, b`` join components.

    A pair is computed by the first band that holds it, so numbers of links are added up where they are found and a
    group of n vectors makes no n * n rows.
    """
    dealt = deal(members, "chunks", [*CODES, "copies", "vector"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                bucket = _Bucket(batch, row, s, p)
                n = len(bucket.ids)
                x = list_column(batch, "vector", row).astype(np.float64).reshape(n, -1)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                norm = np.sqrt((x * x).sum(axis=1))
                copies = list_column(batch, "copies", row)
                linked = np.zeros(n, dtype=np.int64)
                group, joins = np.arange(n), []
                for a, b in bucket.pairs():
                    for at in range(0, len(a), 65536):
                        c, d = a[at : at + 65536], b[at : at + 65536]
                        good = (x[c] * x[d]).sum(axis=1) / (norm[c] * norm[d]) >= p.threshold
                        c, d = c[good], d[good]
                        np.add.at(linked, c, copies[d])
                        np.add.at(linked, d, copies[c])
                        while len(c):
                            apart = group[c] != group[d]
                            c, d = c[apart], d[apart]
                            if len(c):
                                joins.append((bucket.ids[c[0]], bucket.ids[d[0]]))
                                group[group == group[d[0]]] = group[c[0]]
                has = np.flatnonzero(linked)
                pairs = np.array(joins, dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([bucket.ids[has], pairs[:, 0]])),
                        pa.array(np.concatenate([np.zeros(len(has), np.int64), pairs[:, 1]]),
                                 mask=np.arange(len(has) + len(pairs)) < len(has)),
                        pa.array(np.concatenate([linked[has], np.zeros(len(pairs), np.int64)])),
                    ],
                    names=["a", "b", "n"],
                )

    return dealt.mapInArrow(run, "a long, b long, n long")


def near_duplicates(
    rows: DataFrame, p: Params = Params(), id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Equal vectors form one class and are compared once.  Defined cases: a vector that is null, empty, zero or holds
    null or non-finite components has no links; vectors of different lengths are not linked; each repeated row counts
    as a vector of its own; a row without an id links with nothing, has a null component and is kept; an empty table
    gives no rows.  Other columns are ignored.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark)
    vector = F.col(vector_column)
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    usable = (
        vector.isNotNull() & (F.size(vector) > 0) & F.col(id_column).isNotNull()
        & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda v: v != 0)
    )
    source = rows.select(F.col(id_column).alias("id"), F.when(usable, vector).alias("vector"))
    classes = scratch.keep(
        source.where("vector is not null").groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    )
    s = Shape.of(classes.count(), p)
    codes = scratch.keep(encode(classes.select("id", "copies", "vector"), s))
    keyed = codes.select("id", "code_1", "code_2", F.explode("bands").alias("key"))
    # Only buckets of several chunks are listed: at most one for every CHUNK rows, in practice those of large groups.
    large = scratch.keep(
        keyed.groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > CHUNK)
        .select("key", F.ceil(F.col("m") / CHUNK).cast("int").alias("listed"))
    )
    chunks = F.coalesce("listed", F.lit(1)).alias("chunks")
    members = keyed.join(large, "key", "left").select("key", "id", "code_1", "code_2", chunks)
    waiting = scratch.keep(open_members(members, s, p))
    rest = waiting.join(large, "key", "left").select("key", "id", chunks)
    found = scratch.keep(exact_links(rest.join(codes.select(*CODES, "copies", "vector"), "id"), s, p))
    groups = scratch.keep(connected_components(found.where("b is not null").select("a", "b"), scratch))
    counted = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("other"))
    named = (
        classes.select(F.col("id").alias("rep"), "vector", "copies")
        .join(counted, "rep", "left")
        .join(groups.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "vector", (F.col("copies") - 1 + F.coalesce("other", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    component = F.coalesce("component_id", "id")
    return source.join(named, "vector", "left").select(
        F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
