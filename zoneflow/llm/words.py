"""Words of many texts at once: boundaries and 64-bit hashes from one pass over the UTF-8 bytes.

Texts stay in the Arrow buffer they came in.  A word's hash is a polynomial over its bytes modulo 2**64, taken from
running sums, then mixed; it depends on the word alone, not on where it stands or which task reads it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2_000_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_U = np.uint64


def _byte_values() -> np.ndarray:
    values, state = [], 0x243F6A8885A308D3
    for _ in range(256):
        state = (state + _BASE) % 2**64
        z = state
        z = (z ^ (z >> 30)) * 0xBF58476D1CE4E5B9 % 2**64
        z = (z ^ (z >> 27)) * 0x94D049BB133111EB % 2**64
        values.append(z ^ (z >> 31))
    return np.array(values, dtype=np.uint64)


_VALUES = _byte_values()
_CHUNK = 4096
_tables: dict[int, np.ndarray] = {}


def _series(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 .. n - 1."""
    table = _tables.get(base)
    if table is None or len(table) < n:
        table = np.full(max(n, _CHUNK), base, dtype=np.uint64)
        table[0] = 1
        table = _tables[base] = np.multiply.accumulate(table)
    return table[:n]


def _powers(base: int, n: int) -> np.ndarray:
    """Powers 0 .. n - 1 from two short tables, so a worker keeps little between slices."""
    high = _series(pow(base, _CHUNK, 2**64), n // _CHUNK + 1)
    return np.multiply.outer(high, _series(base, _CHUNK)).reshape(-1)[:n]


def _powers_at(base: int, exponents: np.ndarray) -> np.ndarray:
    high = _series(pow(base, _CHUNK, 2**64), int(exponents.max(initial=0)) // _CHUNK + 1)
    return high[exponents // _CHUNK] * _series(base, _CHUNK)[exponents % _CHUNK]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def lower_ascii(table: np.ndarray) -> np.ndarray:
    out = table.copy()
    out[65:91] += 32
    return out


# Byte maps: 0 ends a word, other values are the byte as it is compared.
_bytes = np.arange(256, dtype=np.uint8)
_alnum = (_bytes >= 0x80) | ((_bytes >= 48) & (_bytes <= 57)) | ((_bytes >= 97) & (_bytes <= 122))
_upper = (_bytes >= 65) & (_bytes <= 90)
_space = (_bytes == 0x20) | ((_bytes >= 0x09) & (_bytes <= 0x0D))
ALNUM_WORDS = np.where(_upper, _bytes + 32, np.where(_alnum, _bytes, 0)).astype(np.uint8)
TOKEN_KINDS = np.where(_space, 0, np.where(_alnum | _upper, 1, 2)).astype(np.uint8)  # letters and digits, or signs
SPACED_WORDS = np.where(_space, 0, np.where(_upper, _bytes + 32, _bytes)).astype(np.uint8)


@dataclass
class Words:
    """Words of ``n`` texts: hash, first and end byte in ``data``; words of text i are ``bounds[i]:bounds[i+1]``."""

    first_row: int
    n: int
    data: np.ndarray
    offsets: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), np.diff(self.bounds))


def hash_spans(mapped: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges ``starts .. ends``, none of them empty."""
    sums = _VALUES[mapped]
    sums *= _powers(_BASE, len(mapped))
    np.cumsum(sums, out=sums)
    before = np.where(starts > 0, sums[starts - 1], _U(0)) if len(starts) else np.zeros(0, dtype=np.uint64)
    return mix((sums[ends - 1] - before) * _powers_at(_INVERSE, starts) + (ends - starts).astype(np.uint64))


def split(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, first_row: int = 0, kinds=None) -> Words:
    """Words under a byte map; with ``kinds``, a word also ends where the kind of its bytes changes."""
    mapped = table[data]
    inside = mapped != 0
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    if kinds is not None and len(data):
        kind = kinds[data]
        edge[1:-1] |= kind[1:] != kind[:-1]
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    bounds = np.searchsorted(starts, offsets)
    return Words(first_row, len(offsets) - 1, data, offsets, hash_spans(mapped, starts, ends), starts, ends, bounds)


def parts(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of few rows, so that only those are copied at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows that hold about ``limit`` bytes; a null text has no bytes.

    A text is never cut: one longer than the limit makes a run of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary()
    column = column.cast(pa.large_string()).cast(kind) if not pa.types.is_binary(column.type) else column.cast(kind)
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(n, max(end, row + 1))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def words_of(column: pa.Array, table: np.ndarray, limit: int = SLICE_BYTES, kinds=None) -> Iterator[Words]:
    for row, data, offsets in text_slices(column, limit):
        yield split(data, offsets, table, row, kinds)


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of runs of ``k`` words that start at each word; the last ``k - 1`` starts are absent."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= _U(0xD6E8FEB86659FD93)
        out += hashes[j : n + j]
    return mix(out)


def sequence_hash(hashes: np.ndarray) -> np.uint64:
    """Hash of a whole word sequence shorter than a shingle."""
    out = _U(len(hashes))
    with np.errstate(over="ignore"):
        for h in hashes:
            out = out * _U(0xD6E8FEB86659FD93) + h
    return mix(np.array([out], dtype=np.uint64))[0]


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingles of one text: runs of ``k`` words, or its whole sequence where it has fewer."""
    if len(hashes) == 0:
        return np.zeros(0, dtype=np.uint64)
    if len(hashes) < k:
        return np.array([sequence_hash(hashes)], dtype=np.uint64)
    return np.unique(shingle_hashes(hashes, k))
