"""Spelling variants: words one edit apart, found by dynamic programming over sorted word lists."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm import words as wd
from zoneflow.llm.scratch import Scratch

CHUNK = 1024  # words of a list that meet as many others in one row
SCAN_WORDS = 40_000  # words scanned at a time
COUNTED = 200_000  # distinct words a task counts before it hands them on
FAR = 3  # any distance that no longer matters


@dataclass(frozen=True)
class Params:
    """Words of ``least_length`` code points that occur ``least_count`` times; a variant's form is ``factor`` times as
    frequent.  One run in ``noise`` loses a code point (0: none does)."""

    least_length: int = 7
    least_count: int = 2
    factor: int = 10
    noise: int = 31


_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end byte, code points and text of the runs ``[A-Za-z\\u00C0-\\u00FF]+``.

    In UTF-8 the letters from U+00C0 to U+00FF are the byte C3 and one more.
    """
    lead = data == 0xC3
    inside = _LETTER[data] | lead
    inside[1:] |= lead[:-1]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]])[: len(data)]
    after = np.concatenate([inside[1:], [False]])[: len(data)]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    pairs = np.concatenate([[0], np.cumsum(lead)])
    return starts, ends, ends - starts - (pairs[ends] - pairs[starts]), np.searchsorted(offsets, starts, side="right") - 1


def word_counts(docs: DataFrame, p: Params, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word, n``: words of ``least_length`` code points of all texts with their counts, lower-cased in A-Z.

    A run loses its code point ``h % length`` where ``noise`` divides ``h``, the crc32 of ``<id>:<run>``.  Null texts
    have no words; texts of a row without an id lose nothing.
    """
    picked = docs.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter[bytes] = Counter()
        for batch in wd.parts(batches):
            ids = batch.column(0).to_pylist()
            for row, data, offsets in wd.text_slices(batch.column(1)):
                _count(counted, data, offsets, ids[row : row + len(offsets) - 1], p)
                if len(counted) > COUNTED:
                    yield _counts(counted)
                    counted.clear()
        yield _counts(counted)

    counts = picked.mapInArrow(run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= p.least_count)


def _count(counted: Counter, data: np.ndarray, offsets: np.ndarray, ids: list, p: Params) -> None:
    starts, ends, points, rows = letter_runs(data, offsets)
    long = points >= p.least_length
    body = data.tobytes().lower()  # of bytes, only A-Z change
    seeds = [None if i is None else zlib.crc32(f"{i}:".encode()) for i in ids]
    for a, b, n, row in zip(starts[long].tolist(), ends[long].tolist(), points[long].tolist(), rows[long].tolist()):
        word, seed = body[a:b], seeds[row]
        if p.noise and seed is not None:
            h = zlib.crc32(word, seed)
            if h % p.noise == 0:
                if n == p.least_length:
                    continue
                text = word.decode()
                word = (text[: h % n] + text[h % n + 1 :]).encode()
        counted[word] += 1


def _counts(counted: Counter) -> pa.RecordBatch:
    words = pa.array(list(counted), pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(list(counted.values()), pa.int64())], names=["word", "n"])


def blocks(vocabulary: DataFrame) -> DataFrame:
    """``key, backwards, m, i, j, words``: lists in which every pair at one edit meets.

    Let m be the length of the shorter word and k its half.  Two words at one edit share their first k code points, or
    else the last m - k: those are the keys, and a word of length L gives them for m = L and m = L - 1.  ``words`` are
    the members' ``(own, tail, word, n)`` in order, ``tail`` being what follows the shared part, read from it.
    A list of many members is dealt in chunks, one row for each pair of chunks.
    """
    sized = vocabulary.withColumn("m", F.explode(F.array(F.length("word"), F.length("word") - 1)))
    sided = sized.withColumn("backwards", F.explode(F.array(F.lit(False), F.lit(True)))).withColumn(
        "shared", F.floor(F.col("m") / 2).cast("int")
    )
    shared = F.when(F.col("backwards"), F.col("m") - F.col("shared")).otherwise(F.col("shared"))
    read = F.when(F.col("backwards"), F.reverse("word")).otherwise(F.col("word"))
    rows = sided.select(
        "word", "n", "m", "backwards", F.substring(read, F.lit(1), shared).alias("key"),
        F.substring(read, shared + 1, F.length("word")).alias("tail"),
    )
    by = ["key", "backwards", "m"]
    # A list of words that are all longer than m holds no pair of this m.
    sizes = rows.groupBy(*by).agg(F.count("*").alias("members"), F.min(F.length("word")).alias("least"))
    sizes = sizes.where("members > 1 and least = m").select(*by, F.ceil(F.col("members") / CHUNK).cast("int").alias("chunks"))
    placed = rows.join(sizes, by).withColumn("own", F.pmod(F.xxhash64("word"), F.col("chunks").cast("long")).cast("int"))
    return (
        placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .groupBy(*by, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        .agg(F.array_sort(F.collect_list(F.struct("own", "tail", "word", "n"))).alias("words"))
    )


@dataclass
class Lists:
    """Sorted lists of strings, one after the other: code points of all strings, and where each string begins."""

    points: np.ndarray
    begins: np.ndarray
    lengths: np.ndarray
    list_of: np.ndarray

    @classmethod
    def of(cls, strings: list[str], list_of: np.ndarray) -> Lists:
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        points = np.frombuffer("".join(strings).encode("utf-32-le"), dtype=np.uint32)
        return cls(points, np.cumsum(lengths) - lengths, lengths, list_of)

    def at(self, row: np.ndarray, place: int | np.ndarray) -> np.ndarray:
        """Code points of strings at a place; a value that is no code point beyond their ends."""
        out = np.full(len(row), 0xFFFFFFFF, dtype=np.uint32)
        held = (self.lengths[row] > place) & (np.asarray(place) >= 0)
        out[held] = self.points[(self.begins[row] + place)[held]]
        return out


def one_edit(lists: Lists, queries: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(query, string)`` pairs at exactly one edit: string number ``queries[x]`` against all of list ``targets[x]``.

    A row of the edit matrix belongs to a prefix, not to a string: neighbours in a sorted list that share a prefix share
    its rows, so the row of a prefix is computed once for the range of strings that have it, from the row of the prefix
    one shorter.  Only the band of three cells around the diagonal is kept.  A range whose cells are all over one is
    skipped with all its strings.  All queries go down together, one code point a step.
    """
    held = np.arange(len(lists.lengths))
    node = lists.list_of
    q, at = queries, targets
    mq = lists.lengths[q]
    low = np.full(len(q), FAR, dtype=np.int8)
    mid = np.zeros(len(q), dtype=np.int8)
    high = np.where(mq > 0, 1, FAR).astype(np.int8)
    found_q, found_s = [], []
    depth, nodes = 0, int(node.max(initial=-1)) + 1
    while len(q):
        # Ranges that share one code point more: they begin where the range or the code point changes.
        deeper = lists.lengths[held] > depth
        held, above = held[deeper], node[deeper]
        char = lists.at(held, depth)
        new = np.ones(len(held), dtype=bool)
        new[1:] = (above[1:] != above[:-1]) | (char[1:] != char[:-1])
        node, first = np.cumsum(new) - 1, held[new]
        char, parent = char[new], above[new]
        count = np.bincount(parent, minlength=nodes)
        begin = np.cumsum(count) - count

        times = count[at]
        child = np.repeat(begin[at] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        q, low, mid, high = (np.repeat(x, times) for x in (q, low, mid, high))
        mq, c = lists.lengths[q], char[child]
        here = np.minimum(mid + 1, low + (c != lists.at(q, depth - 1)))
        here = np.where(mq >= depth, here, FAR)
        on = np.minimum(np.minimum(mid + (c != lists.at(q, depth)), high + 1), here + 1)
        on = np.where(mq >= depth + 1, on, FAR)
        over = np.minimum(high + (c != lists.at(q, depth + 1)), on + 1)
        over = np.where(mq >= depth + 2, over, FAR)
        depth, nodes = depth + 1, len(first)
        stays = np.minimum(np.minimum(here, on), over) <= 1
        q, at, mq = q[stays], child[stays], mq[stays]
        low, mid, high = (x[stays].astype(np.int8) for x in (here, on, over))
        # The first string of a range is the one that ends here, if one does.
        string = first[at]
        away = mq - depth
        distance = np.where(away == 0, mid, np.where(away == -1, low, np.where(away == 1, high, FAR)))
        hit = (lists.lengths[string] == depth) & (distance == 1)
        found_q.append(q[hit])
        found_s.append(string[hit])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *found_q]), np.concatenate([none, *found_s])


def near_words(dealt: DataFrame) -> DataFrame:
    """``word, n_near, form_n, form``: near words of each row of blocks, and the most frequent of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("words").value_lengths().to_numpy(zero_copy_only=False)
            share = np.cumsum(lengths) // SCAN_WORDS
            cuts = [0, *(np.flatnonzero(share[1:] != share[:-1]) + 1).tolist(), len(lengths)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    yield _scan(batch.slice(a, b - a))

    return dealt.mapInArrow(run, "word string, n_near long, form_n long, form string")


def _scan(batch: pa.RecordBatch) -> pa.RecordBatch:
    members = batch.column("words")
    row = np.repeat(np.arange(batch.num_rows), members.value_lengths().to_numpy(zero_copy_only=False))
    own, tail, word, n = members.flatten().flatten()
    own, n = own.to_numpy(zero_copy_only=False), n.to_numpy(zero_copy_only=False)
    i, j, m, backwards = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("i", "j", "m", "backwards"))
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (own[1:] != own[:-1])
    list_of = np.cumsum(new) - 1
    lists = Lists.of(tail.to_pylist(), list_of)
    # Of two chunks each is asked for in the other; a chunk paired with itself in its own list.
    crossed = (i != j)[row]
    firsts = np.searchsorted(row, np.arange(batch.num_rows))
    both = np.bincount(row[new], minlength=batch.num_rows) == 2
    asked = np.flatnonzero(~crossed | both[row])
    target = np.where(crossed, 2 * list_of[firsts][row] + 1 - list_of, list_of)[asked]
    query, near = one_edit(lists, asked, target)
    m, backwards = m[row], backwards[row]
    # Pairs of two longer words belong to another m; pairs that share their first half are found forwards.
    size = lists.lengths + np.where(backwards, m - m // 2, m // 2)
    keep = np.minimum(size[query], size[near]) == m[query]
    query, near = query[keep], near[keep]
    twice = backwards[query] & _forwards(lists, size, query, near)
    query, near = query[~twice], near[~twice]
    words = np.array(word.to_pylist(), dtype=object)
    order = np.lexsort((words[near].astype(str) if len(near) else near, -n[near], query))
    query, near = query[order], near[order]
    begin = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else query
    counts = np.diff(np.append(begin, len(query)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(words[query[begin]], pa.string()), pa.array(counts.astype(np.int64)),
            pa.array(n[near[begin]].astype(np.int64)), pa.array(words[near[begin]], pa.string()),
        ],
        names=["word", "n_near", "form_n", "form"],
    )


def _forwards(lists: Lists, size: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs of backward tails share their first half too: the longer tail without its first is the shorter."""
    out = size[x] != size[y]
    small, large = np.where(size[x] < size[y], x, y), np.where(size[x] < size[y], y, x)
    for k in range(int(lists.lengths[small][out].max(initial=0))):
        at = out & (lists.lengths[small] > k)
        out[at] &= lists.at(small[at], k) == lists.at(large[at], k + 1)
    return out


def group_variants(docs: DataFrame, p: Params = Params(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of ``docs`` that is long and frequent enough.

    1. Words are counted within tasks, then over all.
    2. Words at one edit meet in lists that share half of a word; each list is sorted, and the edit matrix goes over it
       once for every word (see :func:`one_edit`).
    3. A word's form is its most frequent near word, the smallest of equals, if ``factor`` times as frequent.
    4. Forms are followed to the last.  Every step multiplies the count by the factor, so chains are short; each round
       doubles how far they are followed.

    Defined cases: null and empty texts have no words, texts of any length are read whole, repeated rows count as often
    as they occur, an empty table gives no rows.  Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    vocabulary = scratch.keep(word_counts(docs, p, id_column, text_column), 500)
    found = near_words(blocks(vocabulary))
    best = F.min(F.struct((-F.col("form_n")).alias("minus"), "form")).alias("best")
    near = scratch.keep(found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best), 200)
    forms = vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("best.form").alias("form"),
        (-F.col("best.minus")).alias("form_n"),
    )
    is_form = F.col("form_n") >= F.col("n") * p.factor
    forms = scratch.keep(
        forms.withColumn("form", F.when(is_form, F.col("form"))).withColumn("form_n", F.when(is_form, F.col("form_n")))
    )
    roots = scratch.keep(forms.where("form is not null").select("word", F.col("form").alias("root")))
    # Words that are a form by themselves and have a form: where there is none, all chains are followed to the end.
    while not (step := roots.join(roots.toDF("root", "next"), "root")).isEmpty():
        longer = roots.join(step.select("word", "next"), "word", "left").select(
            "word", F.coalesce("next", "root").alias("root")
        )
        longer = scratch.keep(longer)
        scratch.drop(roots)
        roots = longer
    return forms.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
