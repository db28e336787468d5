"""SentencePiece encoding and decoding by suffix-array matching.

Texts are cut where no piece can reach over: before a space that starts a word and around control characters.  The
distinct words of a batch are concatenated and indexed by a suffix array, every piece is looked up by binary search,
and the occurrences are edges from their first to their last byte.  Sorted by position, the edges are relaxed.

For a byte-pair model an edge extends the encoding of the text before it if the two pieces would not have been merged
at their border; exactly one edge into each position does, so relaxing gives the model's own encoding.
"""

from __future__ import annotations

import functools
import heapq
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from zoneflow.llm import words as wd

SPACE = "▁".encode()
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # fixed values: kinds of pieces in a model file
SLICE = 1_000_000
CACHED_WORDS = 400_000  # distinct words that a worker remembers; beyond that it starts anew
MATCHED_BYTES = 400_000  # text that is indexed at a time
NEVER = np.int64(2**40)


# --- model file --------------------------------------------------------------


def _fields(data: bytes) -> Iterator[tuple[int, int, bytes | int]]:
    """(number, wire type, value) of a serialized message."""
    at = 0

    def varint() -> int:
        nonlocal at
        shift = value = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, kind, varint()
        else:
            size = {1: 8, 5: 4}.get(kind)
            size = varint() if size is None else size
            yield tag >> 3, kind, data[at : at + size]
            at += size


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[bytes]  # spaces as plain spaces
    kinds: list[int]
    scores: list[float]
    byte_fallback: bool
    dummy_prefix: bool


@functools.lru_cache(maxsize=2)
def read_vocabulary(model: bytes) -> Vocabulary:
    """Pieces of a byte-pair model without text normalisation."""
    pieces, kinds, scores = [], [], []
    trainer, normalizer = {}, {4: 1}
    for number, _, value in _fields(model):
        if number == 1:
            got = {n: v for n, _, v in _fields(value)}
            pieces.append(got.get(1, b"").replace(SPACE, b" "))
            scores.append(struct.unpack("<f", got[2])[0] if 2 in got else 0.0)
            kinds.append(got.get(3, NORMAL))
        elif number == 2:
            trainer = {n: v for n, _, v in _fields(value)}
        elif number == 3:
            normalizer |= {n: v for n, _, v in _fields(value)}
    if trainer.get(3, 1) != 2:
        raise ValueError("only byte-pair models are read")
    if normalizer.get(2, b"") or normalizer[4]:
        raise ValueError("the model normalises its text")
    return Vocabulary(pieces, kinds, scores, bool(trainer.get(35, 0)), bool(normalizer.get(3, 1)))


# --- tables ------------------------------------------------------------------


def merge(symbols: list[bytes], rank: dict[bytes, float]) -> list[bytes]:
    """Byte-pair merging by a queue: the best neighbours first, the leftmost of equals."""
    before, after = list(range(-1, len(symbols) - 1)), list(range(1, len(symbols) + 1))
    parts: list[bytes | None] = list(symbols)
    queue: list[tuple[float, int, bytes]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < len(parts):
            joined = parts[i] + parts[j]
            if joined in rank:
                heapq.heappush(queue, (rank[joined], i, joined))

    for i in range(len(parts)):
        offer(i)
    while queue:
        _, i, joined = heapq.heappop(queue)
        if parts[i] is None or after[i] >= len(parts) or parts[i] + parts[after[i]] != joined:
            continue
        j = after[i]
        parts[i], parts[j] = joined, None
        after[i] = after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [p for p in parts if p is not None]


def _last_split(piece: bytes, rank: dict[bytes, float]) -> tuple[bytes, bytes] | None:
    """The two parts whose merge makes the piece; None if merging its characters never gives it."""
    own = rank[piece]
    parts = merge([c.encode() for c in piece.decode()], {p: r for p, r in _inner(piece, rank) if p != piece})
    return (parts[0], parts[1]) if len(parts) == 2 and own is not None else None


def _inner(piece: bytes, rank: dict[bytes, float]) -> Iterator[tuple[bytes, float]]:
    chars = [c.encode() for c in piece.decode()]
    for a in range(len(chars)):
        for b in range(a + 2, len(chars) + 1):
            part = b"".join(chars[a:b])
            if part in rank:
                yield part, rank[part]


class Tables:
    """What matching and relaxing need, as arrays by piece id; about two megabytes for 32,000 pieces."""

    def __init__(self, model: bytes):
        v = read_vocabulary(model)
        self.size, self.dummy_prefix, self.byte_fallback = len(v.pieces), v.dummy_prefix, v.byte_fallback
        self.pieces = v.pieces
        usable = {p: i for i, (p, k) in enumerate(zip(v.pieces, v.kinds)) if k in (NORMAL, USER)}
        self.id_of = usable
        # Runs of spaces share one score, so they are merged by the queue; no other piece holds an inner space.
        self.space_runs = {p: -v.scores[i] for p, i in usable.items() if len(p) > 1 and not p.strip(b" ")}
        words = {p: i for p, i in usable.items() if p not in self.space_runs}
        if any(b" " in p[1:] for p in words):
            raise ValueError("a piece reaches over the start of a word")
        long = sorted((p for p in words if len(p.decode()) > 1), key=lambda p: -v.scores[words[p]])
        order = {p: float(n) for n, p in enumerate(long, 1)}
        self.rank = np.zeros(self.size + 1, dtype=np.int64)
        self.left, self.right = np.zeros(self.size + 1, np.int64), np.zeros(self.size + 1, np.int64)
        reachable, pairs = [i for p, i in words.items() if p not in order], {}
        for p in long:
            i = words[p]
            self.rank[i] = order[p]
            parts = _last_split(p, order)
            chars = p.decode()
            for c in range(1, len(chars)):
                a, b = chars[:c].encode(), chars[c:].encode()
                if a in words and b in words:
                    pairs[words[a], words[b]] = int(order[p])
            if parts and parts[0] in words and parts[1] in words:
                self.left[i], self.right[i] = words[parts[0]], words[parts[1]]
                reachable.append(i)
        self._hash_pairs(pairs)
        reachable.sort(key=lambda i: v.pieces[i])
        self.matched = np.array(reachable)
        self.lengths = np.array([len(v.pieces[i]) for i in reachable])
        width = -(-max(self.lengths) // 8) * 8
        self.low_keys = _keys(np.array([list(v.pieces[i].ljust(width, b"\0")) for i in reachable], dtype=np.uint8))
        self.high_keys = _keys(np.array([list(v.pieces[i].ljust(width, b"\xff")) for i in reachable], dtype=np.uint8))
        self.width = width
        self.byte_ids = np.full(256, usable.get(b"<unk>", 0), dtype=np.int64)
        for i, (p, k) in enumerate(zip(v.pieces, v.kinds)):
            if k == BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
        self.unknown = next((i for i, k in enumerate(v.kinds) if k == UNKNOWN), 0)
        self.lone_space = usable.get(b" ", -1)
        # Bytes that end a word: the space and control characters that no piece holds.
        held = set(b"".join(words))
        table = np.arange(256, dtype=np.uint8)
        table[[b for b in range(33) if b == 32 or b not in held]] = 0
        self.word_bytes = table
        text = [b"" if k in (CONTROL, UNKNOWN) else bytes([int(p[3:5], 16)]) if k == BYTE else p
                for p, k in zip(v.pieces, v.kinds)]
        self.out_bytes = np.frombuffer(b"".join(text), dtype=np.uint8)
        self.out_sizes = np.array([len(t) for t in text], dtype=np.int64)
        self.out_starts = np.cumsum(self.out_sizes) - self.out_sizes
        self.gaps: dict[bytes, tuple[int, ...]] = {}

    def _hash_pairs(self, pairs: dict[tuple[int, int], int]) -> None:
        self.bits = 20
        while len(pairs) * 4 > 1 << self.bits:
            self.bits += 1
        self.slots = np.full(1 << self.bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << self.bits, NEVER, dtype=np.int64)
        keys = np.array([a * self.size + b for a, b in pairs], dtype=np.int64)
        values = np.array(list(pairs.values()), dtype=np.int64)
        at = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            spot, first = np.unique(at[left], return_index=True)
            free = self.slots[spot] < 0
            chosen = left[first[free]]
            self.slots[spot[free]], self.ranks[spot[free]] = keys[chosen], values[chosen]
            left = np.setdiff1d(left, chosen)
            at[left] = (at[left] + 1) & (len(self.slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece that two neighbours make, or a number above all ranks."""
        keys = a * self.size + b
        at = self._slot(keys)
        out = np.full(len(keys), NEVER)
        left = np.arange(len(keys))
        while len(left):
            held = self.slots[at[left]]
            same = held == keys[left]
            out[left[same]] = self.ranks[at[left[same]]]
            left = left[~same & (held >= 0)]
            at[left] = (at[left] + 1) & (len(self.slots) - 1)
        return out

    def stay_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether neighbours ``a, b`` are never merged over their border; ``size`` stands for an unknown character.

        The later of the two merges is undone again and again.  The parts at the border existed together just before
        it, so a piece that they make of a better rank would have come first.  Of equal ranks the left comes first.
        """
        out = np.ones(len(a), dtype=bool)
        live = np.flatnonzero((a < self.size) & (b < self.size))
        a, b = a[live], b[live]
        limit = np.full(len(a), NEVER)
        while len(live):
            merged = self.pair_rank(a, b) < limit
            out[live[merged]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~merged & ((ra > 0) | (rb > 0))
            live, a, b, ra, rb = live[go], a[go], b[go], ra[go], rb[go]
            from_left = ra > rb
            limit = np.where(from_left, ra, rb + 1)
            a, b = np.where(from_left, self.right[a], a), np.where(from_left, b, self.left[b])
        return out

    def gap_ids(self, gap: bytes) -> tuple[int, ...]:
        """Ids of spaces and control characters between words."""
        found = self.gaps.get(gap)
        if found is None:
            out: list[int] = []
            at = 0
            while at < len(gap):
                end = at
                while end < len(gap) and gap[end] == 32:
                    end += 1
                if end > at:
                    out += [self.id_of[p] for p in merge([b" "] * (end - at), self.space_runs)]
                else:
                    end = at + 1
                    one = gap[at:end]
                    out.append(self.id_of[one] if one in self.id_of else self.fallback(one)[0])
                at = end
            found = tuple(out)
            if len(self.gaps) < 10_000:
                self.gaps[gap] = found
        return found

    def fallback(self, raw: bytes) -> list[int]:
        return [int(self.byte_ids[b]) for b in raw] if self.byte_fallback else [self.unknown]


@functools.lru_cache(maxsize=2)
def tables(model: bytes) -> Tables:
    return Tables(model)


# --- matching and relaxing ---------------------------------------------------


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Concatenated ``begin .. begin + size - 1``."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - sizes), sizes)


def _keys(rows: np.ndarray) -> list[np.ndarray]:
    """Rows of bytes as big-endian 64-bit numbers, eight bytes each."""
    return [np.ascontiguousarray(rows[:, i : i + 8]).view(">u8").reshape(-1).astype(np.uint64) for i in range(0, rows.shape[1], 8)]


def _suffixes(keys: list[np.ndarray]) -> np.ndarray:
    """Suffixes in the order of their keys: sorted by the first eight bytes, and only the tied ones by the others."""
    order = np.argsort(keys[0])
    first = keys[0][order]
    equal = first[1:] == first[:-1]
    # A zero byte ends a word, and no piece reaches over it: such suffixes may stay as they are.
    equal &= (first[1:] & np.uint64(0xFF)) != 0
    tied = np.zeros(len(order), dtype=bool)
    tied[1:] = equal
    tied[:-1] |= equal
    tied = np.flatnonzero(tied)
    if len(tied):
        mine = order[tied]
        order[tied] = mine[np.lexsort([*(k[mine] for k in keys[:0:-1]), first[tied]])]
    return order


def occurrences(text: np.ndarray, t: Tables) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``t.matched``, first byte) of every piece in ``text``, by a suffix array.

    Suffixes are ordered by as many bytes as the longest piece has, up to a zero byte, which is all that looking up a
    piece compares.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(t.width, dtype=np.uint8)])
    keys = []
    inside = np.ones(n, dtype=bool)
    for first in range(0, t.width, 8):
        key = np.zeros(n, dtype=np.uint64)
        for j in range(first, first + 8):
            byte = padded[j : j + n]
            inside &= byte != 0
            key = (key << np.uint64(8)) | (byte * inside)
        keys.append(key)
    suffixes = _suffixes(keys)
    ordered = [k[suffixes] for k in keys]

    def bound(wanted: list[np.ndarray], after: bool) -> np.ndarray:
        """Places of the wanted keys: by the first eight bytes, then, for pieces that are longer, by the others."""
        low = np.searchsorted(ordered[0], wanted[0])
        high = np.searchsorted(ordered[0], wanted[0], side="right")
        out = np.where(t.lengths > 8, low, high if after else low)
        live = np.flatnonzero((t.lengths > 8) & (low < high))
        low, high = low[live], high[live]
        wanted = [k[live] for k in wanted]
        while (low < high).any():
            middle = np.minimum((low + high) >> 1, n - 1)
            less = np.zeros(len(low), dtype=bool)
            tied = np.ones(len(low), dtype=bool)
            for have, want in zip(ordered[1:], wanted[1:]):
                less |= tied & (have[middle] < want)
                tied &= have[middle] == want
            go = (less | tied if after else less) & (low < high)
            high = np.where(go | (low >= high), high, middle)
            low = np.where(go, middle + 1, low)
        out[live] = low
        return out

    first, last = bound(t.low_keys, False), bound(t.high_keys, True)
    sizes = np.maximum(last - first, 0)
    return np.repeat(np.arange(len(sizes)), sizes), suffixes[_ranges(first, sizes)]


def encode_words(text: np.ndarray, starts: np.ndarray, t: Tables) -> tuple[np.ndarray, np.ndarray]:
    """(ids, sizes): the encoding of each word of ``text``; word i is ``starts[i]`` up to the zero byte before the next."""
    n = len(text)
    ends = np.append(starts[1:], n) - 1
    which, at = occurrences(text, t)
    piece, size = t.matched[which], t.lengths[which]
    heads = np.flatnonzero(((text & 0xC0) != 0x80) & (text != 0))
    known = np.zeros(n + 1, dtype=bool)
    char_size = np.diff(np.append(heads, n))
    char_size = np.minimum(char_size, np.where(text[heads] < 0x80, 1, np.where(text[heads] < 0xE0, 2, np.where(text[heads] < 0xF0, 3, 4))))
    at_char = np.zeros(n + 1, dtype=np.int64)
    at_char[heads] = char_size
    known[at[at_char[at] == size]] = True
    odd = heads[~known[heads]]
    piece = np.concatenate([piece, np.full(len(odd), t.size)])
    size = np.concatenate([size, at_char[odd]])
    at = np.concatenate([at, odd])
    reach = at + size - np.repeat(starts, np.diff(np.append(starts, n)))[at]
    # Sixteen bits are sorted by digits.
    order = np.argsort(reach.astype(np.uint16) if reach.max(initial=0) < 2**16 else reach, kind="stable")
    piece, at, size, reach = piece[order], at[order], size[order], reach[order]
    begins = np.zeros(n + 1, dtype=bool)
    begins[starts] = True
    last, back = np.full(n + 1, -1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
    cuts = np.flatnonzero(np.diff(reach)) + 1
    for lo, hi in zip(np.concatenate([[0], cuts]), np.append(cuts, len(reach))):
        s, p, e = at[lo:hi], piece[lo:hi], at[lo:hi] + size[lo:hi]
        first = begins[s]
        good = first | (last[s] >= 0)
        inner = np.flatnonzero(good & ~first)
        good[inner] = t.stay_apart(last[s[inner]], p[inner])
        last[e[good]], back[e[good]] = p[good], s[good]
    found_word, found_id, found_at, found_end = [], [], [], []
    e, word = ends.copy(), np.arange(len(starts))
    while len(e):
        s = back[e]
        found_word.append(word), found_id.append(last[e]), found_at.append(s), found_end.append(e)
        more = s > starts[word]
        e, word = s[more], word[more]
    word, ids = np.concatenate(found_word), np.concatenate(found_id)
    at, end = np.concatenate(found_at), np.concatenate(found_end)
    order = np.lexsort((at, word))
    word, ids, at, end = word[order], ids[order], at[order], end[order]
    if len(odd):
        width = np.where(ids == t.size, end - at if t.byte_fallback else 1, 1)
        spread = np.repeat(np.arange(len(ids)), width)
        offset = np.arange(len(spread)) - np.repeat(np.cumsum(width) - width, width)
        raw = t.byte_ids[text[np.minimum(at[spread] + offset, n - 1)]] if t.byte_fallback else np.full(len(spread), t.unknown)
        ids, word = np.where(ids[spread] == t.size, raw, ids[spread]), word[spread]
    return ids.astype(np.int32), np.bincount(word, minlength=len(starts))


class Memory:
    """Encodings of the words that a worker has met, by hash; at most ``CACHED_WORDS`` and one batch."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.starts = self.sizes = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int32)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.hashes, hashes)
        if not len(self.hashes):
            return at, np.zeros(len(hashes), dtype=bool)
        return at, self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes

    def add(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        starts = np.cumsum(sizes) - sizes + len(self.ids)
        self.ids = np.concatenate([self.ids, ids])
        hashes = np.concatenate([self.hashes, hashes])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.starts = np.concatenate([self.starts, starts])[order]
        self.sizes = np.concatenate([self.sizes, sizes])[order]


def _match(rows: np.ndarray, w: wd.Words, data: np.ndarray, spaced: np.ndarray, t: Tables) -> tuple:
    """Encodings of some words, concatenated into one text to be indexed."""
    body = w.ends[rows] - w.starts[rows]
    sizes = body + spaced[rows] + 1
    starts = np.cumsum(sizes) - sizes
    joined = np.full(int(sizes.sum()), 32, dtype=np.uint8)
    joined[starts + sizes - 1] = 0
    joined[_ranges(starts + spaced[rows], body)] = data[_ranges(w.starts[rows], body)]
    return encode_words(joined, starts, t)


def encode_texts(data: np.ndarray, offsets: np.ndarray, t: Tables, memory: Memory) -> tuple[np.ndarray, np.ndarray]:
    """(ids, sizes) of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    n_texts = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(n_texts, np.int64)
    w = wd.split(data, offsets, t.word_bytes)
    words = len(w.starts)
    text = w.text_of_word()
    # Slots: the gap before each word and the word, then the gap at the end of each text.
    first = np.zeros(words, dtype=bool)
    full = np.flatnonzero(np.diff(w.bounds))
    first[w.bounds[full]] = True
    gap_from = np.where(first, offsets[text], np.concatenate([[0], w.ends[:-1]])[:words]) if words else np.zeros(0, np.int64)
    dummy = first & t.dummy_prefix
    spaced = np.where(w.starts > gap_from, data[np.maximum(w.starts - 1, 0)] == 32, dummy)
    gap_size = w.starts - gap_from + dummy - spaced
    tail_from = offsets[:-1].copy()
    tail_from[full] = w.ends[w.bounds[full + 1] - 1]
    tail_dummy = (np.diff(w.bounds) == 0) & t.dummy_prefix & (np.diff(offsets) > 0)
    tail_size = offsets[1:] - tail_from + tail_dummy

    hashes = wd.mix(w.hashes + spaced.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    _, known = memory.find(hashes)
    if not known.all():
        if len(memory.hashes) > CACHED_WORDS:
            memory.clear()
            known[:] = False
        new, rows = np.unique(hashes[~known], return_index=True)
        rows = np.flatnonzero(~known)[rows]
        part = np.cumsum(w.ends[rows] - w.starts[rows] + 2) // MATCHED_BYTES
        found = [_match(rows[part == k], w, data, spaced, t) for k in np.unique(part)]
        memory.add(new, np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]))
    at, _ = memory.find(hashes)
    word_from, word_size = memory.starts[at] if words else at, memory.sizes[at] if words else at

    gap_ids: list[int] = []
    pool_at, pool_size = np.zeros(words + n_texts, np.int64), np.zeros(words + n_texts, np.int64)
    base = len(memory.ids)
    lone = np.zeros(words, dtype=bool)
    if words:
        lone = spaced & (memory.ids[word_from] == t.lone_space)
    raw = data.tobytes()
    for k in np.flatnonzero(gap_size > 0):
        gap = b" " * int(dummy[k]) + raw[gap_from[k] : w.starts[k]]
        if spaced[k]:
            if lone[k] and len(gap) > 1 and gap[-2] == 32:
                word_from[k] += 1  # its space joins the run before it
                word_size[k] -= 1
            else:
                gap = gap[:-1]
        ids = t.gap_ids(gap)
        pool_at[k], pool_size[k] = base + len(gap_ids), len(ids)
        gap_ids += ids
    for k in np.flatnonzero(tail_size > 0):
        ids = t.gap_ids(b" " * int(tail_dummy[k]) + raw[tail_from[k] : offsets[k + 1]])
        pool_at[words + k], pool_size[words + k] = base + len(gap_ids), len(ids)
        gap_ids += ids
    pool = np.concatenate([memory.ids, np.array(gap_ids, dtype=np.int32)]) if gap_ids else memory.ids
    # Interleave: slot numbers order the gaps and words of a text, then its tail.
    slot_text = np.concatenate([text, text, np.arange(n_texts)])
    slot_rank = np.concatenate([2 * np.arange(words), 2 * np.arange(words) + 1, np.full(n_texts, 2 * words)])
    begins = np.concatenate([pool_at[:words], word_from, pool_at[words:]])
    sizes = np.concatenate([pool_size[:words], word_size, pool_size[words:]])
    order = np.lexsort((slot_rank, slot_text))
    begins, sizes, slot_text = begins[order], sizes[order], slot_text[order]
    per_text = np.zeros(n_texts, np.int64)
    np.add.at(per_text, slot_text, sizes)
    return pool[_ranges(begins, sizes)], per_text


def decode_ids(ids: np.ndarray, sizes: np.ndarray, t: Tables) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, sizes) of the texts that id lists stand for; ids outside the vocabulary are ignored."""
    inside = (ids >= 0) & (ids < t.size)
    owner = np.repeat(np.arange(len(sizes)), sizes)[inside]
    ids = ids[inside].astype(np.int64)
    width = t.out_sizes[ids]
    data = t.out_bytes[_ranges(t.out_starts[ids], width)]
    per_text = np.bincount(owner, weights=width, minlength=len(sizes)).astype(np.int64)
    if t.dummy_prefix:
        starts = np.cumsum(per_text) - per_text
        full = np.flatnonzero(per_text)
        drop = starts[full][data[starts[full]] == 32]
        keep = np.ones(len(data), dtype=bool)
        keep[drop] = False
        per_text[full] -= data[starts[full]] == 32
        data = data[keep]
    return data, per_text


# --- operators ---------------------------------------------------------------

_memory: dict[int, Memory] = {}


def _worker(model: bytes) -> tuple[Tables, Memory]:
    t = tables(model)
    return t, _memory.setdefault(id(t), Memory())


def _plain(column: pa.Array) -> pa.Array:
    """Texts with the model's own space sign as a plain space, as encoding takes it."""
    import pyarrow.compute as pc

    return pc.replace_substring(column.cast(pa.large_string()), "▁", " ")


def encode(docs: DataFrame, model_path: str, text_column: str = "text", output: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text in ``output`` and whether they decode to it in ``round_trip``.

    The model file (half a megabyte) is read on the driver and broadcast.  Defined cases: a null or empty text has no
    ids; repeated rows have equal ids; a text with the model's own space sign decodes to one with a plain space, so it
    is no round trip; characters outside the vocabulary become byte pieces; other columns are kept, and columns of
    ``docs`` named like the new ones are replaced.
    """
    spark = docs.sparkSession
    with open(model_path, "rb") as f:
        held = spark.sparkContext.broadcast(f.read())
    docs = docs.drop(output, "round_trip")
    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, memory = _worker(held.value)
        for batch in wd.parts(batches):
            plain = _plain(batch.column(place))
            own = batch.column(place).cast(pa.large_binary()).fill_null(b"")
            for row, data, offsets in wd.text_slices(plain, SLICE):
                n = len(offsets) - 1
                ids, sizes = encode_texts(data, offsets, t, memory)
                back, back_sizes = decode_ids(ids, sizes, t)
                exact = np.zeros(n, dtype=bool)
                ends = np.cumsum(back_sizes)
                flat = back.tobytes()
                for i in range(n):
                    exact[i] = own[row + i].as_buffer().to_pybytes() == flat[ends[i] - back_sizes[i] : ends[i]]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(ids, type=pa.int32())
                )
                part = batch.slice(row, n)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, lists, pa.array(exact)], names=[*part.schema.names, output, "round_trip"]
                )

    new = [T.StructField(output, T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())]
    schema = T.StructType([*docs.schema.fields, *new])
    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, model_path: str, ids_column: str = "ids", output: str = "decoded") -> DataFrame:
    """``rows`` with the text of each id list; a null list gives a null text, bytes that are no UTF-8 are replaced."""
    with open(model_path, "rb") as f:
        held = rows.sparkSession.sparkContext.broadcast(f.read())
    rows = rows.drop(output)
    place = rows.columns.index(ids_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, _ = _worker(held.value)
        for batch in batches:
            column = batch.column(place)
            sizes = np.asarray(column.value_lengths().fill_null(0), dtype=np.int64)
            ids = column.flatten().fill_null(-1).to_numpy()
            data, widths = decode_ids(ids, sizes, t)
            flat, ends = data.tobytes(), np.cumsum(widths)
            texts = [flat[e - n : e].decode("utf-8", "replace") for e, n in zip(ends, widths)]
            texts = [x if v else None for x, v in zip(texts, column.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, output]
            )

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(output, T.StringType())]))
