"""Exact duplicates by an extendible-hash index kept in shared files."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm import words as wd
from zoneflow.llm.scratch import Scratch

ROW_BYTES = 64  # what an entry weighs besides its text
FINER = 5  # bits of the keys beyond those that as many full buckets need, by which bytes are counted


@dataclass(frozen=True)
class Params:
    """Bytes that a bucket holds before it is split, the deepest directory, and the bits of a key that are used.

    The directory has at most ``2 ** max_depth`` slots, a row of a few numbers each: that bounds what is broadcast.  So
    that it suffices, a bucket may hold ``4 * total / 2 ** max_depth`` bytes if that is more: 400 MB for 100 TB.  Fewer ``hash_bits`` only make more texts share a key; comparing bytes tells them apart.
    """

    bucket_bytes: int = 8_000_000
    max_depth: int = 20
    hash_bits: int = 64


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """Ids and texts, lower-cased in A-Z, of few rows at a time; a null text is empty."""
    for batch in wd.parts(batches, 200):
        yield batch.column(0), [(b or b"").lower() for b in batch.column(1).cast(pa.binary()).to_pylist()]


def _keys(texts: list[bytes], bits: int) -> np.ndarray:
    keys = np.fromiter(map(xxhash.xxh64_intdigest, texts), np.uint64, len(texts))
    return keys if bits == 64 else keys >> np.uint64(64 - bits) << np.uint64(64 - bits)


def cells(docs: DataFrame, p: Params, scratch: Scratch) -> DataFrame:
    """``cell, bytes``: bytes of all entries by the first ``max_depth`` bits of their key, at most one row for each value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _slices(batches):
            cell = (_keys(texts, p.hash_bits) >> np.uint64(64 - p.max_depth)).astype(np.int64)
            size = np.fromiter(map(len, texts), np.int64, len(texts)) + ROW_BYTES
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(size)], names=["cell", "bytes"])

    counted = docs.mapInArrow(run, "cell long, bytes long").groupBy("cell").agg(F.sum("bytes").alias("bytes"))
    return scratch.keep(counted)


def grow_directory(counted: DataFrame, p: Params, scratch: Scratch) -> DataFrame:
    """``bucket, depth, parts``: buckets of the directory after all splits; a bucket is named by its first cell.

    The directory begins with one bucket of depth 0.  A bucket over ``bucket_bytes`` is split by one more bit of the
    keys; where its depth is the directory's, the directory doubles.  Where one cell alone is over the limit, as with
    many copies of one text, splits go on only until the rest of the bucket is below it: the bucket then overflows, and
    its rows are dealt to ``parts`` owners by their id.
    """
    total = counted.agg(F.sum("bytes")).first()[0] or 0
    limit = F.lit(max(p.bucket_bytes, 4 * total >> p.max_depth))
    deepest = min(p.max_depth, (total // p.bucket_bytes).bit_length() + FINER)
    # Counts only as fine as the splits need them, so that a round costs a few rows for each bucket.
    rest = p.max_depth - deepest
    counted = counted.groupBy(F.expr(f"(cell >> {rest}) << {rest}").alias("cell")).agg(F.sum("bytes").alias("bytes"))
    placed = counted.select("cell", "bytes", F.lit(0).cast("long").alias("bucket"), F.lit(0).alias("depth"))
    settled = None
    for depth in range(deepest + 1):
        placed = scratch.keep(placed)
        sized = placed.groupBy("bucket", "depth").agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("most"))
        others = F.when(F.col("most") > limit, F.col("bytes") - F.col("most")).otherwise(F.col("bytes"))
        splits = (others > limit) & (F.col("depth") < deepest)
        parts = F.ceil(F.col("bytes") / limit).cast("int")
        directory = scratch.keep(sized.select("bucket", "depth", splits.alias("splits"), parts.alias("parts")))
        done = directory.where(~F.col("splits")).drop("splits")
        settled = done if settled is None else settled.union(done)
        overfull = directory.where("splits").select("bucket")
        if overfull.isEmpty():
            break
        # At most 2 ** depth buckets, so the broadcast is bounded by the directory.
        low = p.max_depth - depth - 1
        placed = placed.join(F.broadcast(overfull), "bucket", "left_semi").select(
            "cell", "bytes", F.expr(f"(cell >> {low}) << {low}").alias("bucket"), F.lit(depth + 1).alias("depth")
        )
    return settled


def slots(directory: DataFrame, p: Params) -> DataFrame:
    """``slot, bucket, parts``: the directory as it is looked up, a slot for each value of its first ``global`` bits.

    A bucket of a lower depth than the directory's stands in several slots.
    """
    deepest = directory.agg(F.max("depth")).scalar()
    spread = F.expr("sequence(0L, shiftleft(1L, g - depth) - 1L)")
    return directory.withColumn("g", deepest).select(
        F.explode(spread).alias("x"), "bucket", "parts", "g",
    ).select((F.expr(f"bucket >> ({p.max_depth} - g)") + F.col("x")).alias("slot"), "bucket", "parts", "g")


def keyed(docs: DataFrame, p: Params) -> DataFrame:
    """``id, key, cell, body`` of ``docs(id, text)``."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _slices(batches):
            keys = _keys(texts, p.hash_bits)
            cell = (keys >> np.uint64(64 - p.max_depth)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(keys.view(np.int64)), pa.array(cell), pa.array(texts, pa.binary())],
                names=["id", "key", "cell", "body"],
            )

    return docs.mapInArrow(run, f"id {kind}, key long, cell long, body binary")


def routed(rows: DataFrame, directory: DataFrame, p: Params) -> DataFrame:
    """Rows with the ``bucket`` and ``part`` that own them, found in the directory by the first bits of the key."""
    table = slots(directory, p)
    depth = directory.agg(F.max("depth")).scalar()
    slot = F.expr(f"cell >> ({p.max_depth} - g)")
    return (
        rows.withColumn("g", depth)
        .withColumn("slot", slot)
        .drop("g")
        .join(F.broadcast(table.drop("g")), "slot")
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts").cast("long")).cast("int"))
        .drop("slot", "cell")
    )


def chained(rows: DataFrame, columns: str) -> DataFrame:
    """``id, bucket, key, part, link, sha, body`` of rows that stand together by bucket, part and key.

    Texts that share a key form a chain: a text is compared, byte for byte, with the links before it, and becomes a new
    link if it is none of them.  ``sha`` and ``body`` stand only in the first row of a link.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain: list[bytes] = []
        last = None
        for batch in batches:
            places = zip(*(batch.column(c).to_pylist() for c in ("bucket", "part", "key")))
            links, shas, heads = [], [], []
            for place, body in zip(places, batch.column("body")):
                body = body.as_py()
                if place != last:
                    chain, last = [], place
                link = next((i for i, text in enumerate(chain) if text == body), len(chain))
                first = link == len(chain)
                if first:
                    chain.append(body)
                links.append(link)
                shas.append(hashlib.sha256(body).hexdigest() if first else None)
                heads.append(body if first else None)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("id", "bucket", "key", "part")), pa.array(links, pa.int32()),
                    pa.array(shas, pa.string()), pa.array(heads, pa.binary()),
                ],
                names=["id", "bucket", "key", "part", "link", "sha", "body"],
            )

    return rows.mapInArrow(run, columns)


@dataclass
class Index:
    """Tables in shared files: ``directory(bucket, depth, parts)``; ``links(bucket, key, link, part, local, keep_id, n,
    sha)``, the distinct texts of a key as their owners found them, ``link`` being the number over all owners; and
    ``rows(id, bucket, key, part, link, sha, body)``, where every row stands, with the text in the first of a link."""

    directory: DataFrame
    links: DataFrame
    rows: DataFrame


def build_index(docs: DataFrame, p: Params = Params(), id_column: str = "doc_id", text_column: str = "text") -> Index:
    """Index the texts of all rows; see :func:`find_duplicates` for the defined cases.

    1. The bytes by the first bits of the keys are counted, and the directory grows until no bucket is overfull.
    2. Rows go to the owner of their bucket, a range of keys, sorted by key; owners chain the texts of a key.
    3. Owners hand on one row for each link.  Where an overfull bucket has several owners, their links of a key are
       compared once more, one row for each owner and link.
    """
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    columns = "bucket long, key long, part int, link int, sha string, body binary"
    directory = scratch.keep(grow_directory(cells(texts, p, scratch), p, scratch))
    owned = routed(keyed(texts, p), directory, p).select("id", "bucket", "part", "key", "body")
    owned = owned.repartition("bucket", "part").sortWithinPartitions("bucket", "part", "key")
    rows = scratch.keep(chained(owned, f"id {kind}, {columns}"), 200)

    place = ["bucket", "key", "part", "link"]
    found = rows.groupBy(*place).agg(F.max("id").alias("keep_id"), F.count("*").alias("n"), F.max("sha").alias("sha"))
    # At most one bucket for each ``bucket_bytes``, and no more than the directory has slots.
    shared = F.broadcast(directory.where("parts > 1").select("bucket"))
    heads = rows.where("body is not null").join(shared, "bucket", "left_semi").select(
        F.struct("part", "link").alias("id"), "bucket", F.lit(0).alias("part"), "key", "body"
    )
    heads = heads.repartition("bucket", "key").sortWithinPartitions("bucket", "part", "key")
    merged = chained(heads, f"id struct<part:int,link:int>, {columns}").select(
        "bucket", "key", "id.part", F.col("id.link").alias("link"), F.col("link").alias("over_all")
    )
    links = found.join(merged, place, "left").select(
        "bucket", "key", F.coalesce("over_all", "link").alias("link"), "part", F.col("link").alias("local"), "keep_id", "n", "sha"
    )
    return Index(directory, scratch.keep(links, 200), rows)


def find_duplicates(
    docs: DataFrame, p: Params = Params(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256`` of every row of ``docs``.

    Texts are equal that are identical once A-Z are lower-cased.  Of equal texts the row with the largest id stays.

    Defined cases: a null text is an empty one; texts of any length are compared whole; of repeated rows, all that
    carry the largest id count as kept; a row without an id is kept only if none of its group has one; an empty table
    gives no rows.  Other columns are ignored.
    """
    index = build_index(docs, p, id_column, text_column)
    link = ["bucket", "key", "link"]
    groups = index.links.groupBy(*link).agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    # One row for each owner and link, so a key with many copies meets its rows by owner.
    groups = index.links.select(*link, "part", "local", "sha").join(groups, link).drop("link")
    stays = F.coalesce(F.col("id") == F.col("keep_id"), F.col("keep_id").isNull())
    rows = index.rows.select("id", "bucket", "key", "part", F.col("link").alias("local"))
    return rows.join(groups, ["bucket", "key", "part", "local"]).select(
        F.col("id").alias(id_column), "keep_id", "group_size", stays.alias("kept"), F.col("sha").alias("text_sha256")
    )
