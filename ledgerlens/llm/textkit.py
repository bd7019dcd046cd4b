"""Vectorised text primitives over Arrow string buffers.

Texts are handled as UTF-8 bytes: white space and A-Z are single bytes that
never occur inside a longer code, so cutting and folding bytes is exact.  A
batch is walked in chunks of about ``CHUNK_BYTES`` so that the working arrays
stay small whatever the batch size; a longer text is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_CODE = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))
_FOLDED_CODE = _BYTE_CODE[FOLD]
_powers = np.ones(1, _U)
_inverse_powers = np.ones(1, _U)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse_powers
    if len(_powers) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("_powers", _BASE), ("_inverse_powers", _INVERSE)):
            steps = np.full(size, _U(base), _U)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)
    return _powers, _inverse_powers


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts [i, j) of at most ``limit`` bytes, or of one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j
        i = j


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte ranges of the words ``[^\\x20\\x09-\\x0D]+`` and,
    for each text, the index of its first word (one entry more than texts)."""
    if len(data) == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = ~SPACE[data]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[edges] = False
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool) -> np.ndarray:
    """A 64-bit fingerprint of each byte range, A-Z lower-cased if ``fold``."""
    if len(starts) == 0:
        return np.zeros(0, _U)
    power, inverse = _power_tables(len(data))
    total = np.zeros(len(data) + 1, _U)
    np.cumsum((_FOLDED_CODE if fold else _BYTE_CODE)[data] * power[:len(data)], out=total[1:])
    value = (total[ends] - total[starts]) * inverse[starts]
    return mix(value ^ (ends - starts).astype(_U) * _U(0xA24BAED4963EE407))


_PLACE = mix(np.arange(101, 165, dtype=_U)) | _U(1)


def shingles(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Fingerprints of the runs of ``k`` words of one text, in order; a shorter
    text has one run, its whole sequence; a text without words has none."""
    n = len(word_hashes)
    if n == 0:
        return np.zeros(0, _U)
    size = min(n, k)
    out = np.full(n - size + 1, _U(size), _U)
    for j in range(size):
        out = out + word_hashes[j:j + len(out)] * _PLACE[j]
    return mix(out)
