"""Vectorised text helpers shared by the operators: Arrow text columns as byte arrays, words, hashes.

A text column arrives as one contiguous UTF-8 buffer with offsets, so words are found and hashed
for many documents at once with numpy, without a Python object per word. Null texts count as empty.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20  # texts handled at once; one longer text is handled alone

U64 = np.uint64
_MASK = (1 << 64) - 1


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table over byte values, true inside the given inclusive ranges."""
    t = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        t[lo : hi + 1] = True
    return t


#: Words of letters, digits and everything beyond ASCII (texts already in lower case).
ALNUM = byte_table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: Words separated by ASCII white space.
NONSPACE = ~byte_table((0x20, 0x20), (0x09, 0x0D))
#: A-Z to a-z; every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def give_back() -> None:
    """Freed memory goes back to the system, where the C library can do that (glibc). A Python worker would keep
    it while it serves other stages."""
    with contextlib.suppress(OSError, TypeError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null texts have length 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, off - off[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes (one row at least)."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        end = min(n, max(end, row + 1))
        yield row, end
        row = end


def spans(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the words of all texts; no word crosses two texts."""
    mask = table[buf]
    first, last = mask.copy(), mask.copy()
    if len(buf):
        first[1:] &= ~mask[:-1]
        last[:-1] &= ~mask[1:]
        inner = offsets[(offsets > 0) & (offsets < len(buf))]
        first[inner] = mask[inner]
        last[inner - 1] = mask[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words_per_text(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of the first word of each text, and one past the last."""
    return np.searchsorted(starts, offsets, side="left")


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256).astype(U64)
_powers = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        base = _BASE if kind == "up" else pow(_BASE, -1, 1 << 64)
        size = max(n, SLICE_BYTES + 1)
        full = np.full(size, base & _MASK, dtype=U64)
        full[0] = 1
        have = np.multiply.accumulate(full)
        if n <= SLICE_BYTES + 1:
            _powers[kind] = have
    return have[:n]


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span, from one running sum over the buffer."""
    if not len(starts):
        return np.zeros(0, U64)
    run = np.zeros(len(buf) + 1, U64)
    np.cumsum(_BYTES[buf] * _power("up", len(buf)), out=run[1:])
    return mix((run[ends] - run[starts]) * _power("down", len(buf))[starts] + (ends - starts).astype(U64))


def shingles(word: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``n`` consecutive words inside each text, with the text's row.

    ``bounds``: first word of each text and one past the last. A text of fewer than ``n`` words
    (one at least) has its whole sequence as its only window.
    """
    counts = np.diff(bounds)
    rows = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(word)) - bounds[:-1][rows]
    left = counts[rows] - at
    h = np.zeros(len(word), U64)
    for k in range(n):
        step = U64((0xD6E8FEB86659FD93 * (2 * k + 1)) & _MASK)
        inside = left > k
        nxt = np.zeros(len(word), U64)
        nxt[: len(word) - k] = word[k:] if k else word
        h = np.where(inside, mix(h + nxt * step), h)
    keep = (left >= n) | (at == 0)
    return h[keep], rows[keep]


def distinct_per_row(h: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row: (hashes, bounds)."""
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    h, rows = h[keep], rows[keep]
    return h, np.searchsorted(rows, np.arange(n_rows + 1), side="left")
