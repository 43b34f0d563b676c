"""Numpy kernels over Arrow string buffers: words, shingles and mixes of a batch of texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_ODD = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x2127599BF4325C37], dtype=np.uint64) | U(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**i mod 2**64 for i < n; kept for the worker's life up to the largest batch."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        out = np.ones(max(n, 1 << 16), dtype=np.uint64)
        step, size = base, 1
        while size < len(out):
            m = min(size, len(out) - size)
            out[size : size + m] = out[:m] * U(step)
            step, size = step * step % (1 << 64), size * 2
        if n > (1 << 23):
            return out
        _powers[base] = have = out
    return have[:n]


def utf8_batches(column: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with at most `limit` bytes, or of one longer row; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if not len(column):
        return
    column = column.fill_null("") if column.null_count else column
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield a, data[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word."""
    full = ~BLANK[data]
    first = np.zeros(len(data) + 1, bool)
    first[off] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = full[:-1]
    start = np.flatnonzero(full & (~before | first[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = full[1:]
    end = np.flatnonzero(full & (~after | first[1:])) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words, A-Z in lower case: differences of one running sum of bytes times powers."""
    run = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[LOWER[data]] * powers(_BASE, len(data)), out=run[1:])
    return mix((run[end] - run[start]) * powers(_INVERSE, len(data) + 1)[start] + (end - start).astype(np.uint64) * _ODD[7])


def shingle_sets(data: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every distinct word shingle, in order of row and hash; a shorter text is one shingle."""
    start, end, row = words(data, off)
    h = word_hashes(data, start, end)
    n = len(off) - 1
    count = np.bincount(row, minlength=n)
    begin = np.concatenate([[0], np.cumsum(count)])
    rows, hashes = [], []
    if len(h) >= width:
        acc = np.full(len(h) - width + 1, width, dtype=np.uint64)
        for j in range(width):
            acc += h[j : len(h) - width + 1 + j] * _ODD[j]
        whole = row[: len(h) - width + 1] == row[width - 1 :]
        rows.append(row[: len(acc)][whole])
        hashes.append(acc[whole])
    for short in range(1, width):
        at = np.flatnonzero(count == short)
        if len(at):
            acc = np.full(len(at), short, dtype=np.uint64)
            for j in range(short):
                acc += h[begin[at] + j] * _ODD[j]
            rows.append(at)
            hashes.append(acc)
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    row, value = np.concatenate(rows), mix(np.concatenate(hashes)).view(np.int64)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]
