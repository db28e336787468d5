"""Benchmark decontamination with a positional inverted index of the training documents.

The index is partitioned by blocks of documents: one row for each term of a block with the positions at which it
stands, and one row for each document.  A search starts from the postings of a window's rarest term, moves every list
by the term's offset in the window and intersects them, so it finds exact phrases or, with a slop, near ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm import words as wd
from zoneflow.llm.scratch import Scratch

WINDOW = 13
BLOCK_BYTES = 2_000_000
BLOCK_ROWS = 2_000
MAX_SLOP = 500
GAP = 1024  # free positions between documents: no window, slop included, reaches over one
PACK = 50_000  # windows of a group; bounds what a task holds of the query set


def build_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Postings and documents of blocks of about 2 MB of text.

    ``term`` is the 64-bit hash of a lower-cased word and ``positions`` where it stands in the block, ascending.  Rows
    without a term are documents: ``positions`` holds the first position and the number of words.  ``text_sha256``
    identifies a document's text.  A null text is one without words.
    """
    picked = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    picked = picked.withColumn("sha", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    names = ["block", "term", "n", "positions", "ordinal", "id", "text_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in wd.parts(batches, BLOCK_ROWS):
            for w in wd.words_of(batch.column(1), wd.ALNUM_WORDS, BLOCK_BYTES):
                counts = np.diff(w.bounds)
                first = GAP + w.bounds[:-1] + GAP * np.arange(w.n)
                positions = np.arange(len(w.hashes)) + np.repeat(first - w.bounds[:-1], counts)
                order = np.argsort(w.hashes, kind="stable")
                sorted_terms = w.hashes[order]
                starts = np.flatnonzero(np.concatenate([[True], sorted_terms[1:] != sorted_terms[:-1]])[: len(order)])
                sizes = np.diff(np.concatenate([starts, [len(order)]]))
                for at in range(0, len(starts), 10_000):
                    s, n = starts[at : at + 10_000], sizes[at : at + 10_000]
                    offsets = np.concatenate([s - s[0], [s[-1] - s[0] + n[-1]]]).astype(np.int32)
                    lists = positions[order[s[0] : s[-1] + n[-1]]].astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(s), block)), pa.array(sorted_terms[s].view(np.int64)),
                            pa.array(n.astype(np.int32)),
                            pa.ListArray.from_arrays(pa.array(offsets), pa.array(lists)),
                            pa.nulls(len(s), pa.int32()), pa.nulls(len(s), batch.column(0).type),
                            pa.nulls(len(s), pa.binary()),
                        ],
                        names=names,
                    )
                lists = np.stack([first, counts], axis=1).astype(np.int32).reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(w.n, block)), pa.nulls(w.n, pa.int64()), pa.nulls(w.n, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(np.arange(w.n + 1, dtype=np.int32) * 2), pa.array(lists)),
                        pa.array(np.arange(w.n, dtype=np.int32)),
                        batch.column(0).slice(w.first_row, w.n), batch.column(2).slice(w.first_row, w.n),
                    ],
                    names=names,
                )
                block += 1

    return picked.mapInArrow(
        run,
        f"block long, term long, n int, positions array<int>, ordinal int, id {kind}, text_sha256 binary",
    )


def windows_of(items: DataFrame, size: int = WINDOW, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """``item, window_id, terms`` of every run of ``size`` words; a shorter item with words is one window."""
    picked = items.select(F.col(id_column).alias("item"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in wd.parts(batches):
            for w in wd.words_of(batch.column(1), wd.ALNUM_WORDS, 200_000):
                rows, parts = [], []
                for i, (a, b) in enumerate(zip(w.bounds, w.bounds[1:])):
                    spans = [w.hashes[s : s + size] for s in range(a, max(a + 1, b - size + 1))] if b > a else []
                    spans = [x[: b - a] for x in spans]
                    rows += [w.first_row + i] * len(spans)
                    parts += spans
                if rows:
                    offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
                    terms = pa.array(np.concatenate(parts).view(np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(rows)), pa.ListArray.from_arrays(pa.array(offsets), terms)],
                        names=["item", "terms"],
                    )

    out = picked.mapInArrow(run, f"item {picked.schema['item'].dataType.simpleString()}, terms array<long>")
    return out.withColumn("window_id", F.xxhash64("terms")).distinct()


def _pack(rows: pa.Table, size: int) -> dict[str, np.ndarray]:
    """Windows as arrays, their terms ordered from the rarest."""
    rows = rows.combine_chunks()
    lengths = pc.list_value_length(rows["terms"]).to_numpy().astype(np.int64)
    terms, offsets = np.zeros((len(rows), size), np.int64), np.zeros((len(rows), size), np.int64)
    used = np.arange(size)[None, :] < lengths[:, None]
    terms[used] = pc.list_flatten(rows["terms"]).to_numpy()
    offsets[used] = pc.list_flatten(rows["offsets"]).to_numpy()
    return {"id": rows["window_id"].to_numpy(), "terms": terms, "offsets": offsets, "lengths": lengths}


def _matches(pack: dict, terms: np.ndarray, lists: np.ndarray, sizes: np.ndarray, slop: int) -> tuple:
    """(window rows, first positions) of the pack's windows within one block."""
    order = np.argsort(terms, kind="stable")
    ends = np.cumsum(sizes)
    gather = np.concatenate([np.arange(ends[i] - sizes[i], ends[i]) for i in order]) if len(order) else np.zeros(0, int)
    terms, sizes, lists = terms[order], sizes[order], lists[gather].astype(np.int64)
    keys = lists + (np.repeat(np.arange(len(terms), dtype=np.int64), sizes) << 32)
    local = np.searchsorted(terms, pack["terms"])
    known = (local < len(terms)) & (terms[np.minimum(local, max(0, len(terms) - 1))] == pack["terms"]) if len(
        terms
    ) else np.zeros(pack["terms"].shape, bool)
    used = np.arange(pack["terms"].shape[1])[None, :] < pack["lengths"][:, None]
    rows = np.flatnonzero((known | ~used).all(axis=1) & (pack["lengths"] > 0))
    begins = np.cumsum(sizes) - sizes
    counts = sizes[local[rows, 0]] if len(rows) else np.zeros(0, int)
    window = np.repeat(rows, counts)
    inner = np.arange(len(window)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = lists[begins[local[window, 0]] + inner] - pack["offsets"][window, 0]
    for j in range(1, pack["terms"].shape[1]):
        target = (local[window, j] << 32) + start + pack["offsets"][window, j]
        at = np.searchsorted(keys, target - slop)
        good = (at < len(keys)) & (keys[np.minimum(at, max(0, len(keys) - 1))] <= target + slop) if len(keys) else at < 0
        good |= pack["lengths"][window] <= j
        window, start = window[good], start[good]
    return window, start


def _searcher(size: int, slop: int):
    """The search of one block for the windows of a pack that may stand in it."""

    def run(table: pa.Table, asked: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        names = ["block", "ordinal", "window_ids", "spans"]
        is_doc = np.asarray(table["term"].is_null())
        docs, rows = table.filter(pa.array(is_doc)), table.filter(pa.array(~is_doc))
        lists = rows["positions"].combine_chunks()
        pack = _pack(asked, size)
        window, start = _matches(
            pack, rows["term"].to_numpy(), lists.flatten().to_numpy(), lists.value_lengths().to_numpy(), slop
        )
        places = docs["positions"].combine_chunks().flatten().to_numpy().reshape(-1, 2).astype(np.int64)
        order = np.argsort(places[:, 0], kind="stable")
        firsts, counts = places[order, 0], places[order, 1]
        ordinals = docs["ordinal"].to_numpy()[order]
        doc = np.searchsorted(firsts, start + slop, side="right") - 1
        out = {n: [] for n in names}
        for d in np.unique(doc):
            mine = doc == d
            begin = np.maximum(start[mine] - slop - firsts[d], 0)
            end = np.minimum(start[mine] + pack["lengths"][window[mine]] + slop - firsts[d], counts[d])
            marks = np.zeros(counts[d] + 1, dtype=np.int64)
            np.add.at(marks, begin, 1)
            np.add.at(marks, end, -1)
            hit = np.concatenate([[0], np.cumsum(marks)[:-1] > 0, [0]]).astype(np.int8)
            edges = np.flatnonzero(np.diff(hit))
            out["block"].append(table["block"][0].as_py())
            out["ordinal"].append(int(ordinals[d]))
            out["window_ids"].append(pack["id"][np.unique(window[mine])].tolist())
            out["spans"].append([{"first": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
        return pa.table(
            [
                pa.array(out["block"], pa.int64()), pa.array(out["ordinal"], pa.int32()),
                pa.array(out["window_ids"], pa.list_(pa.int64())),
                pa.array(out["spans"], pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
            ],
            names=names,
        )

    return run


def search(
    index: DataFrame, windows: DataFrame, size: int = WINDOW, slop: int = 0, scratch: Scratch | None = None
) -> DataFrame:
    """``block, ordinal, window_ids, spans`` of documents that hold a window.

    Without slop a window matches where its terms follow each other.  With slop each term may stand up to that many
    words from its place relative to the rarest one.  ``spans`` are word ranges of the document, merged.

    Windows meet blocks by their rarest term: only a block that has it is asked.  A group holds one block and those
    of at most about 50,000 windows that may stand in it, so it is bounded however many windows there are.

    Defined cases: windows without terms are not found; repeated windows count once; no windows or an empty index give
    no rows.  ``windows`` may have other columns.
    """
    if not 0 <= slop <= MAX_SLOP:
        raise ValueError(f"slop must be between 0 and {MAX_SLOP}")
    scratch = scratch or Scratch(index.sparkSession)
    distinct = windows.select("window_id", "terms").where(F.size("terms") > 0).distinct()
    packs = max(1, math.ceil(distinct.count() / PACK))
    postings = index.where("term is not null")
    placed = distinct.select(
        F.pmod("window_id", F.lit(packs)).cast("int").alias("pack"), "window_id", F.posexplode("terms").alias("offset", "term")
    )
    # What the joins with postings take from the windows is written first, so Spark knows its size when it plans them.
    terms = scratch.keep(placed.select("pack", "term").distinct())
    frequency = postings.join(terms.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    ordered = F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "offset", "term")))
    ranked = scratch.keep(
        placed.join(frequency, "term", "left").groupBy("pack", "window_id").agg(ordered.alias("ordered"))
        .select(
            "pack", "window_id", F.col("ordered")[0]["term"].alias("term"),
            F.col("ordered.term").alias("terms"), F.col("ordered.offset").alias("offsets"),
        )
    )
    asked = scratch.keep(
        postings.select("block", "term").join(ranked.select("pack", "window_id", "term"), "term")
        .select("block", "pack", "window_id")
    )
    groups = asked.select("block", "pack").distinct()
    needed = (
        postings.join(terms, "term").join(groups, ["block", "pack"], "left_semi")
        .select("block", "pack", "term", "positions", "ordinal")
        .union(
            index.where("term is null").join(groups, "block").select("block", "pack", "term", "positions", "ordinal")
        )
    )
    wanted = asked.join(ranked.select("window_id", "terms", "offsets"), "window_id")
    return (
        needed.groupBy("block", "pack")
        .cogroup(wanted.select("block", "pack", "window_id", "terms", "offsets").groupBy("block", "pack"))
        .applyInArrow(
            _searcher(size, slop),
            "block long, ordinal int, window_ids array<long>, spans array<struct<first:int,end:int>>",
        )
    )


def hit_words(spans: str) -> F.Column:
    """Number of words in the union of ``array<struct<first,end>>`` ranges."""
    step = F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(0).alias("e"), F.lit(0).cast("long").alias("n")),
        lambda s, x: F.struct(
            F.greatest(s["e"], x["end"]).alias("e"),
            (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["e"], x["first"]))).cast("long").alias("n"),
        ),
    )
    return step["n"]


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    size: int = WINDOW,
    slop: int = 0,
) -> DataFrame:
    """Per document: ``n_words``, ``n_hit``, ``n_items``, ``items``, ``contaminated`` and ``text_sha256``.

    A document is contaminated if at least a twentieth of its words lie in windows of the items, and at least one.

    Defined cases: a null, empty or wordless text has no words and no hits; repeated rows each get their own result; a
    row without an id keeps its null id; an item without an id still marks words but is not listed; equal items are
    each listed; empty tables give no rows or no hits.  Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    index = scratch.keep(build_index(docs, id_column, text_column))
    windows = scratch.keep(windows_of(items, size, item_column))
    found = scratch.keep(search(index, windows, size, slop, scratch))
    merged = (
        found.groupBy("block", "ordinal")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
        .select("block", "ordinal", hit_words("spans").alias("n_hit"))
    )
    listed = (
        found.select("block", "ordinal", F.explode("window_ids").alias("window_id"))
        .join(windows.select("window_id", "item").where("item is not null"), "window_id")
        .groupBy("block", "ordinal")
        .agg(F.collect_set("item").alias("items"))
    )
    documents = index.where("term is null").select(
        "block", "ordinal", F.col("id").alias(id_column), F.col("positions")[1].cast("long").alias("n_words"), "text_sha256"
    )
    kind = windows.schema["item"].dataType.simpleString()
    joined = documents.join(merged.join(listed, ["block", "ordinal"], "left"), ["block", "ordinal"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items_of = F.coalesce("items", F.array().cast(f"array<{kind}>"))
    return joined.select(
        id_column, "n_words", n_hit.alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
        items_of.alias("items"), ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"), "text_sha256",
    )


def clean(docs: DataFrame, items: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, with the columns they have.  Rows are judged by their text alone."""
    judged = contamination(docs, items, text_column=text_column, **options)
    bad = judged.where("contaminated").select(F.hex("text_sha256").alias("_sha")).distinct()
    sha = F.upper(F.sha2(F.coalesce(text_column, F.lit("")), 256))
    return docs.withColumn("_sha", sha).join(bad, "_sha", "left_anti").select(*docs.columns)
