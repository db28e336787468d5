"""Substring dedup by paragraphs: MinHash banding, exact Jaccard, and components of what is removed."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm import minhash
from zoneflow.llm import words as wd
from zoneflow.llm.components import connected_components
from zoneflow.llm.scratch import Scratch

_ENDS = np.zeros(256, dtype=bool)
_ENDS[[ord(c) for c in ".!?"]] = True


class _Bands(minhash.Params):
    """Bands stand for the signature: any pair that shares one goes to the exact comparison."""

    @property
    def least_agreement(self) -> int:
        return 1


@dataclass(frozen=True)
class Params:
    """Shingles of five words and a similarity of 0.8; two rows by six bands find a pair at 0.8 with 99.8 %, at 0.9 with
    99.995 %.

    A set of fewer than ``banded`` shingles reaches 0.8 only with one that holds it and one or two shingles more; such
    pairs are found by the key of the larger set without those, all of them.
    Repeated paragraphs and runs at most ``gap`` words apart make one passage; passages under ``least_words`` stay, as
    short lines recur by chance.  Equal runs of ``least_words`` are found wherever they begin: each holds an anchor, a
    run of ``anchor`` words.
    """

    shingle: int = 5
    percent: int = 80
    rows: int = 2
    bands: int = 6
    banded: int = 9
    gap: int = 8
    least_words: int = 30
    anchor: int = 8

    @property
    def minhash(self) -> minhash.Params:
        return _Bands(self.shingle, self.percent, self.rows, self.bands)


@dataclass
class Units:
    """Paragraphs of a slice that have a shingle: text row, first word in it, words, and their shingle sets."""

    row: np.ndarray
    first: np.ndarray
    words: np.ndarray
    values: np.ndarray
    sizes: np.ndarray
    key: np.ndarray


def units(w: wd.Words, k: int) -> Units:
    """Paragraphs end with a line, a sentence, or a word whose hash says so, which cuts long text without signs.

    Of such ends less than ``k`` words apart the one whose word has the least hash stays, and none stays so near to an
    end of the text: every word of a text of ``k`` words lies in a paragraph.  All of it depends on the words nearby
    alone, so a passage has the same inner paragraphs wherever it stands.
    """
    n = len(w.hashes)
    cut = _ENDS[w.data[w.ends - 1]] | (w.hashes % np.uint64(64) == 0)
    lines = np.concatenate([[0], np.cumsum(w.data == 10)])
    cut[:-1] |= lines[w.starts[1:]] > lines[w.ends[:-1]]
    last = w.bounds[1:][np.diff(w.bounds) > 0] - 1
    cut[last] = True
    ends = np.flatnonzero(cut) + 1
    closes = np.isin(ends - 1, last)
    rank = np.where(closes, np.uint64(0), w.hashes[ends - 1] | np.uint64(1))
    stays = np.ones(len(ends), dtype=bool)
    if len(ends):
        stays[: np.searchsorted(ends, k)] = False
    for j in range(1, k):
        near = ends[j:] - ends[:-j] < k
        stays[j:] &= ~near | (rank[j:] < rank[:-j])
        stays[:-j] &= ~near | (rank[:-j] <= rank[j:])
    ends = ends[stays | closes]
    starts = np.concatenate([[0], ends[:-1]])[: len(ends)]
    long = ends - starts >= k
    starts, ends = starts[long], ends[long]
    text = w.text_of_word()[starts] if n else starts
    counts = ends - starts - k + 1
    at = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    values, owner = wd.shingle_hashes(w.hashes, k)[at], np.repeat(np.arange(len(starts)), counts)
    # Few paragraphs repeat a shingle: those with equal shortened values are looked at in full.
    bits = np.uint64(len(starts).bit_length())
    short = np.sort((owner.astype(np.uint64) << (np.uint64(64) - bits)) | (values >> bits))
    again = np.zeros(len(starts), dtype=bool)
    again[(short[1:][short[1:] == short[:-1]] >> (np.uint64(64) - bits)).astype(np.int64)] = True
    doubtful = np.flatnonzero(again[owner])
    doubtful = doubtful[np.lexsort((values[doubtful], owner[doubtful]))]
    equal = (values[doubtful][1:] == values[doubtful][:-1]) & (owner[doubtful][1:] == owner[doubtful][:-1])
    new = np.ones(len(values), dtype=bool)
    new[doubtful[1:][equal]] = False
    values, sizes = values[new], np.bincount(owner[new], minlength=len(starts))
    key = np.zeros(0, dtype=np.uint64)
    if len(starts):
        key = wd.mix(np.add.reduceat(wd.mix(values), np.cumsum(sizes) - sizes) + sizes.astype(np.uint64))
    return Units(text, starts - w.bounds[text], ends - starts, values, sizes, key)


def held_keys(w: wd.Words, u: Units, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """(paragraphs, keys): the keys of all smaller sets, under ``banded``, that a paragraph's set is similar to.

    Where no four words recur, only shingles at the ends can be absent, as the rest must be a run of words.
    """
    k = p.shingle
    count = u.words - k + 1
    small = np.flatnonzero((u.sizes > 1) & ((p.banded - 1) * 100 >= u.sizes * p.percent))
    low = (u.first + w.bounds[u.row])[small]
    inner = count[small] + 1
    owner = np.repeat(np.arange(len(small)), inner)
    at = np.repeat(low - (np.cumsum(inner) - inner), inner) + np.arange(inner.sum())
    short = wd.shingle_hashes(w.hashes, k - 1)[at]
    order = np.lexsort((short, owner))
    equal = (short[order][1:] == short[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    plain = np.ones(len(small), dtype=bool)
    plain[owner[order][1:][equal]] = False
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(wd.mix(wd.shingle_hashes(w.hashes, k)))])
    ends = np.cumsum(u.sizes)
    owners, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for less in range(1, p.banded):
        left = u.sizes[small] - less
        fits = (left > 0) & (left < p.banded) & (left * 100 >= u.sizes[small] * p.percent)
        run, n = low[fits & plain], left[fits & plain]
        for j in range(less + 1):
            owners.append(small[fits & plain])
            keys.append(wd.mix(sums[run + j + n] - sums[run + j] + n.astype(np.uint64)))
        for i in small[fits & ~plain]:
            values = wd.mix(u.values[ends[i] - u.sizes[i] : ends[i]])
            rest = [np.sum(np.delete(values, x)) for x in combinations(range(len(values)), less)]
            owners.append(np.full(len(rest), i))
            keys.append(wd.mix(np.array(rest, dtype=np.uint64) + np.uint64(len(values) - less)))
    return np.concatenate(owners), np.concatenate(keys)


def occurrences(docs: DataFrame, p: Params) -> DataFrame:
    """``id, first, words, key, n_shingles, bands, held`` of every paragraph of ``docs(id, text)``.

    ``key`` is a 64-bit hash of the shingle set; short paragraphs have empty bands, ``held`` are the keys of the short
    sets that the set is similar to.
    """
    m = p.minhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in wd.parts(batches):
            for w in wd.words_of(batch.column(1), wd.SPACED_WORDS, 500_000):
                u = units(w, p.shingle)
                if not len(u.key):
                    continue
                banded = u.sizes >= p.banded
                starts = np.cumsum(u.sizes) - u.sizes
                signature = minhash.signatures(u.values, starts, m)[banded]
                owner, smaller = held_keys(w, u, p)
                order = np.argsort(owner, kind="stable")
                offsets = np.searchsorted(owner[order], np.arange(len(u.key) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(w.first_row + u.row)),
                        pa.array(u.first.astype(np.int32)), pa.array(u.words.astype(np.int32)),
                        pa.array(u.key.view(np.int64)), pa.array(u.sizes.astype(np.int64)),
                        minhash.lists(minhash.band_keys(signature, m).view(np.int64), banded, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(smaller[order].view(np.int64))),
                    ],
                    names=["id", "first", "words", "key", "n_shingles", "bands", "held"],
                )

    return docs.mapInArrow(
        run, "id long, first int, words int, key long, n_shingles long, bands array<long>, held array<long>"
    )


def unit_sets(docs: DataFrame, p: Params) -> DataFrame:
    """``id, shingles``: banded paragraphs of ``docs(id, text)`` by their key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in wd.parts(batches):
            for w in wd.words_of(batch.column(1), wd.SPACED_WORDS, 500_000):
                u = units(w, p.shingle)
                banded = u.sizes >= p.banded
                values = u.values[np.repeat(banded, u.sizes)]
                offsets = np.concatenate([[0], np.cumsum(u.sizes[banded])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(u.key[banded].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64))),
                    ],
                    names=["id", "shingles"],
                )

    return docs.mapInArrow(run, "id long, shingles array<long>")


@dataclass
class Runs:
    """Neighbouring windows of ``least_words`` words that have one anchor: the first of them in the slice, how many, their
    text row, and in it the first word and the anchor's; the anchor's hash."""

    at: np.ndarray
    count: np.ndarray
    row: np.ndarray
    first: np.ndarray
    place: np.ndarray
    anchor: np.ndarray


def window_runs(w: wd.Words, p: Params) -> Runs:
    """Every window has the anchor of the least hash in it, the first of equal ones, so equal windows have equal anchors.

    The windows of an anchor follow one another, as no window between two of them can have another.
    """
    k, n = p.anchor, p.least_words
    grams = wd.shingle_hashes(w.hashes, k)
    if len(w.hashes) < n:
        none = np.zeros(0, dtype=np.int64)
        return Runs(none, none, none, none, none, grams[:0])
    # Running minima and their places over doubling spans; the last two spans together are the window.
    size, least, span = n - k + 1, grams, 1
    place = np.arange(len(grams), dtype=np.int32)

    def meet(shift: int) -> tuple[np.ndarray, np.ndarray]:
        right = least[shift:] < least[:-shift]
        return np.where(right, least[shift:], least[:-shift]), np.where(right, place[shift:], place[:-shift])

    while span * 2 <= size:
        least, place = meet(span)
        span *= 2
    if size > span:
        least, place = meet(size - span)
    text = w.text_of_word()
    at = np.flatnonzero(text[: len(least)] == text[n - 1 :])
    row, place = text[at], place[at].astype(np.int64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(at)))
    at, row, place = at[begin], row[begin], place[begin]
    return Runs(at, count, row, at - w.bounds[row], place - w.bounds[row], grams[place])


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words that start at each word, from those of doubling lengths."""
    base, size = 0xD6E8FEB86659FD93, len(hashes)
    out, covered, part, span = np.zeros(size + 1, dtype=np.uint64), 0, hashes, 1
    while covered < n <= size:
        if n & span:
            count = size - covered - span + 1
            out = part[:count] * np.uint64(pow(base, covered, 2**64)) + out[span : span + count]
            covered += span
        if span * 2 <= n:
            part = part[:-span] * np.uint64(pow(base, span, 2**64)) + part[span:]
        span *= 2
    return wd.mix(out[: max(0, size - n + 1)])


def anchors(texts: DataFrame, p: Params) -> DataFrame:
    """``id, text_hash, words, anchor`` of every distinct anchor of each of ``texts(id, text, text_hash)``; ``words``,
    the length of the text, is null but for one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in wd.parts(batches):
            for w in wd.words_of(batch.column(1), wd.SPACED_WORDS, 500_000):
                x = window_runs(w, p)
                order = np.lexsort((x.anchor, x.row))
                row, anchor = x.row[order], x.anchor[order]
                new = np.ones(len(row), dtype=bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
                row, anchor = row[new], anchor[new]
                later = np.concatenate([[False], row[1:] == row[:-1]])[: len(row)]
                rows = pa.array(w.first_row + row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows), batch.column(2).take(rows),
                        pa.array(np.diff(w.bounds)[row].astype(np.int32), mask=later),
                        pa.array(anchor.view(np.int64)),
                    ],
                    names=["id", "text_hash", "words", "anchor"],
                )

    return texts.mapInArrow(run, "id long, text_hash long, words int, anchor long")


def asked_runs(texts: DataFrame, p: Params) -> DataFrame:
    """``id, last, first, place, anchor, count, key, windows`` of the runs of windows of ``texts(id, text, last, anchors)``
    with such an anchor; ``windows`` are their hashes, ``key`` is one of all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in wd.parts(batches):
            for w in wd.words_of(batch.column(1), wd.SPACED_WORDS, 500_000):
                x = window_runs(w, p)
                asked = batch.column(3).slice(w.first_row, w.n)
                mark = wd.mix(np.arange(1, w.n + 1, dtype=np.uint64))  # parts the rows; a run too many does no harm
                wanted = asked.flatten().to_numpy().view(np.uint64) ^ np.repeat(mark, asked.value_lengths().to_numpy())
                keep = np.flatnonzero(np.isin(x.anchor ^ mark[x.row], wanted))
                if not len(keep):
                    continue
                count = x.count[keep]
                ends = np.cumsum(count)
                step = np.arange(ends[-1]) - np.repeat(ends - count, count)
                hashes = window_hashes(w.hashes, p.least_words)[np.repeat(x.at[keep], count) + step]
                key = np.add.reduceat(wd.mix(hashes + (step + 1).astype(np.uint64)), ends - count)
                rows = pa.array(w.first_row + x.row[keep])
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows), batch.column(2).take(rows),
                        pa.array(x.first[keep].astype(np.int32)), pa.array(x.place[keep].astype(np.int32)),
                        pa.array(x.anchor[keep].view(np.int64)), pa.array(count.astype(np.int32)),
                        pa.array(key.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes.view(np.int64))),
                    ],
                    names=["id", "last", "first", "place", "anchor", "count", "key", "windows"],
                )

    return texts.mapInArrow(
        run,
        "id long, last long, first int, place int, anchor long, count int, key long, windows array<long>",
    )


def _hashed(keys: DataFrame) -> DataFrame:
    """Distinct keys that a large table is joined with: they are hashed in each partition, and the table is not sorted."""
    return keys.hint("shuffle_hash")


def equal_runs(texts: DataFrame, p: Params, scratch: Scratch) -> DataFrame:
    """``id, first, words, component, a``: runs of at least ``least_words`` equal words that another id holds as well.

    Equal texts are one text, and only windows with an anchor that another text has are compared, so what is exchanged
    follows the anchors and the repeated words.  Runs of the same windows are one variant of their anchor: only where an
    anchor has several, as at the edges of a passage, are windows compared one by one, and those of each variant once.
    The runs name a window's anchor as component.
    """
    hashed = texts.withColumn("text_hash", F.xxhash64("text"))
    held = scratch.keep(anchors(hashed, p))
    both = held.groupBy("anchor").agg(F.min("text_hash").alias("x"), F.max("text_hash").alias("y")).where("x <> y")
    same = held.where("words is not null").groupBy("text_hash").agg(F.min("id").alias("a"), F.max("id").alias("last"))
    same = scratch.keep(same)
    copies = held.where("words is not null").join(same.where("a <> last"), "text_hash").select(
        "id", F.lit(0).alias("first"), "words", F.col("text_hash").alias("component"), "a"
    )
    asked = held.join(_hashed(both.select("anchor")), "anchor", "left_semi").groupBy("text_hash").agg(
        F.collect_set("anchor").alias("anchors")
    )
    asked = same.join(asked, "text_hash").select(F.col("a").alias("id"), "text_hash", "last", "anchors")
    picked = hashed.join(_hashed(asked), ["id", "text_hash"])
    found = scratch.keep(asked_runs(picked.select("id", "text", "last", "anchors"), p))
    variants = scratch.keep(
        found.groupBy("anchor", "key").agg(
            F.min("id").alias("a"), F.max("last").alias("b"), F.first("windows").alias("windows")
        )
    )
    kinds = scratch.keep(
        variants.groupBy("anchor")
        .agg(F.min("key").alias("key"), F.max("key").alias("other"), F.min("a").alias("a"), F.max("b").alias("b"))
        .where("a <> b")
    )
    several = _hashed(kinds.where("key <> other").select("anchor"))
    each = variants.join(several, "anchor", "left_semi").select(
        "anchor", "key", "a", "b", F.posexplode("windows").alias("step", "window")
    )
    shared = each.groupBy("window").agg(F.min("a").alias("a"), F.max("b").alias("b")).where("a <> b").select("window", "a")
    parts = (
        each.drop("a", "b").join(_hashed(shared), "window").groupBy("anchor", "key", "a")
        .agg(F.min("step").alias("low"), F.max("step").alias("high"))
    )
    whole = kinds.where("key = other").select("anchor", "key", "a", F.lit(0).alias("low"), F.lit(None).cast("int").alias("high"))
    parts = scratch.keep(parts.union(whole))
    runs = (
        found.join(_hashed(parts), ["anchor", "key"])
        .groupBy("id", "place", "anchor", "a")
        .agg(
            F.min(F.col("first") + F.col("low")).alias("first"),
            F.max(F.col("first") + F.coalesce("high", F.col("count") - 1)).alias("end"),
        )
        .select("id", "first", (F.col("end") - F.col("first") + p.least_words).alias("words"), F.col("anchor").alias("component"), "a")
    )
    runs = scratch.keep(runs.union(copies))
    scratch.drop(held, same, found, variants, kinds, parts)
    return runs


def find_repeats(docs: DataFrame, p: Params = Params(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Documents that hold a passage which also stands in another document.

    ``doc_id, n_passages, n_words, n_removed, passages, clusters, first_docs``: passages are ranges of words, parted where
    ``removed`` changes, which marks words that an earlier document holds; ``clusters`` are the components of the
    paragraphs and runs, ``first_docs`` the smallest documents that hold them.

    1. Documents are cut in paragraphs; equal shingle sets are one class.
    2. Longer classes that share a band are linked if their exact Jaccard similarity reaches 0.8, short ones with those
       that hold them and little more.
    3. Components that stand in two or more documents are repeated.
    4. So are equal runs of 30 words, whatever paragraphs they lie in; neighbouring repeated ranges make a passage.

    Defined cases: null, empty or short texts hold no passage; rows without an id are not searched; rows that share an
    id are one document; copies within one document alone are no repeat; an empty table gives no rows.  Other columns
    are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    texts = docs.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")
    )
    held = scratch.keep(occurrences(texts, p))
    banded = held.where(F.size("bands") > 0)

    # Classes that share a band with another class.
    rows = banded.select(F.col("key").alias("id"), F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x <> y").select("band")
    shared = scratch.keep(shared)  # band rows are exchanged twice, one exchange after the other
    ids = scratch.keep(rows.join(_hashed(shared), "band", "left_semi").select("id").distinct())
    mine = banded.drop("held").withColumnRenamed("id", "doc").withColumnRenamed("key", "id").join(_hashed(ids), "id", "left_semi")
    classes = scratch.keep(
        mine.groupBy("id").agg(
            F.min("doc").alias("doc"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")
        ).withColumn("signature", F.col("bands"))
    )

    own = classes.select("id", "doc")
    read = texts.join(_hashed(own.select(F.col("doc").alias("id")).distinct()), "id", "left_semi")
    sets = unit_sets(read, p).join(own.select("id"), "id", "left_semi").dropDuplicates(["id"])
    sets = scratch.keep(sets)  # asked for twice, and texts are read once
    near = minhash.link_classes(classes, lambda wanted: sets.join(wanted, "id", "left_semi"), p.minhash, scratch)
    scratch.drop(shared, ids, classes, sets)
    short = held.where(F.col("n_shingles") < p.banded).select("key").distinct()
    within = held.select(F.explode("held").alias("a"), F.col("key").alias("b")).join(_hashed(short.toDF("a")), "a", "left_semi").distinct()
    joined = near.select(F.col("node").alias("a"), F.col("component").alias("b")).union(within)
    linked = scratch.keep(connected_components(joined, scratch))
    spread = held.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b"))
    named = spread.join(_hashed(linked.select(F.col("node").alias("key"), "component")), "key", "left")
    named = scratch.keep(named.where("component is not null or a <> b"))
    # A class that no other is linked to needs no look at other classes.
    alone = named.where("component is null").select("key", F.col("key").alias("component"), "a")
    joined = named.where("component is not null")
    whole = joined.groupBy("component").agg(F.min("a").alias("a"), F.max("b").alias("b")).where("a <> b")
    members = joined.select("key", "component").join(whole.select("component", "a"), "component").select(
        "key", "component", "a"
    )
    repeated = scratch.keep(alone.union(members))
    marked = held.select("id", "first", "words", "key").join(_hashed(repeated), "key").select("id", "first", "words", "component", "a")
    marked = scratch.keep(marked)
    scratch.drop(held, near, linked, named, repeated)
    listed = marked.union(equal_runs(texts, p, scratch)).groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("first", "words", "component", "a"))).alias("u")
    )
    passages = listed.select(
        "id", F.col("u.first").alias("first"), F.col("u.words").alias("words"), F.col("u.component").alias("component"),
        F.col("u.a").alias("a"),
    ).mapInArrow(
        _passages(p),
        "id long, n_passages long, n_words long, n_removed long, passages array<struct<first:int,end:int,removed:boolean>>, "
        "clusters array<long>, first_docs array<long>",
    )
    return passages.withColumnRenamed("id", id_column)


def _spans(first: np.ndarray, ends: np.ndarray, later: np.ndarray, begin: int) -> list[dict]:
    """Ranges of a passage, parted where words begin or cease to stand in an earlier document.

    Words between two ranges go with the one before them.
    """
    marks = np.zeros((2, int(ends.max()) + 1), dtype=np.int64)
    np.add.at(marks, (later.astype(np.int64), first), 1)
    np.add.at(marks, (later.astype(np.int64), ends), -1)
    own, removed = np.cumsum(marks, axis=1)[:, :-1] > 0
    known = np.maximum.accumulate(np.where(own | removed, np.arange(len(own)), 0))
    removed = removed[known]
    edges = np.concatenate([[0], 1 + np.flatnonzero(removed[1:] != removed[:-1]), [len(removed)]])
    return [
        {"first": begin + int(x), "end": begin + int(y), "removed": bool(removed[x])} for x, y in zip(edges, edges[1:])
    ]


def _passages(p: Params):
    span = pa.struct([("first", pa.int32()), ("end", pa.int32()), ("removed", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("id", "runs", "spans", "clusters", "docs", "words", "removed")}
            for row in range(batch.num_rows):
                doc = batch.column("id")[row].as_py()
                first, words, component, a = (
                    minhash.list_column(batch, n, row) for n in ("first", "words", "component", "a")
                )
                ends = first + words
                breaks = np.flatnonzero(first[1:] - np.maximum.accumulate(ends)[:-1] > p.gap) + 1
                spans, clusters, docs, runs = [], set(), set(), 0
                for lo, hi in zip(np.concatenate([[0], breaks]), np.append(breaks, len(first))):
                    begin, end = int(first[lo]), int(ends[lo:hi].max())
                    if end - begin >= p.least_words:
                        spans += _spans(first[lo:hi] - begin, ends[lo:hi] - begin, a[lo:hi] != doc, begin)
                        runs += 1
                        clusters.update(component[lo:hi].tolist())
                        docs.update(a[lo:hi].tolist())
                if spans:
                    out["id"].append(doc)
                    out["runs"].append(runs)
                    out["spans"].append(spans)
                    out["clusters"].append(sorted(clusters))
                    out["docs"].append(sorted(docs))
                    out["words"].append(sum(s["end"] - s["first"] for s in spans))
                    out["removed"].append(sum(s["end"] - s["first"] for s in spans if s["removed"]))
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out["id"], pa.int64()), pa.array(out["runs"], pa.int64()),
                    pa.array(out["words"], pa.int64()), pa.array(out["removed"], pa.int64()),
                    pa.array(out["spans"], pa.list_(span)), pa.array(out["clusters"], lists), pa.array(out["docs"], lists),
                ],
                names=["id", "n_passages", "n_words", "n_removed", "passages", "clusters", "first_docs"],
            )

    return run


def remove_repeats(docs: DataFrame, p: Params = Params(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the words of removed passages; each passage stays in the first document that holds it."""
    found = find_repeats(docs, p, id_column, text_column).where("n_removed > 0").select(
        id_column, F.filter("passages", lambda x: x["removed"]).alias("_cut")
    )
    joined = docs.join(found, id_column, "left")
    joined = joined.select(*docs.columns, F.col("_cut.first").alias("_a"), F.col("_cut.end").alias("_b"))
    place = joined.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            for w in wd.words_of(batch.column(place), wd.SPACED_WORDS):
                for i in range(w.n):
                    firsts = batch.column(len(batch.columns) - 2)[w.first_row + i].as_py()
                    ends = batch.column(len(batch.columns) - 1)[w.first_row + i].as_py()
                    if firsts:
                        at, parts = int(w.offsets[i]), []
                        for a, b in zip(firsts, ends):
                            parts.append(w.data[at : w.starts[w.bounds[i] + a]].tobytes())
                            at = int(w.ends[w.bounds[i] + b - 1])
                        parts.append(w.data[at : w.offsets[i + 1]].tobytes())
                        texts[w.first_row + i] = b"".join(parts).decode()
            columns = list(batch.columns[:-2])
            columns[place] = pa.array(texts, batch.schema.types[place])
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-2])

    return joined.mapInArrow(run, docs.select(*docs.columns).schema)
