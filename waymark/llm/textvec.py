"""Vectorised text primitives shared by the operators: words, lines and their 64-bit hashes.

A batch of texts is seen as one UTF-8 byte array with row offsets, as Arrow stores it.
Every function is linear in the bytes of a slice, and slices hold at most SLICE bytes unless
a single text is longer than that, so memory is bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE = 1 << 17
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_P = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_P_INV = pow(_P, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _P, np.uint64), np.full(n, _P_INV, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, int(n).bit_length())
    up, down = _powers(size)
    return up[:n], down[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with H[i] = sum of data[j] * p**j for j < i, modulo 2**64."""
    h = np.empty(len(data) + 1, np.uint64)
    h[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0], out=h[1:])
    return h


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end]; equal spans get equal hashes wherever they stand."""
    down = powers(len(prefix))[1]
    value = (prefix[end] - prefix[start]) * down[start]
    return mix(value ^ (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def slices(batch: pa.RecordBatch, name: str = "text", limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets into them); a null text is an empty one."""
    column = batch.column(batch.schema.get_field_index(name))
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(n, max(end, first + 1))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the index of the first word of each row (one more entry than rows)."""
    n = len(data)
    solid = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts, ends = solid.copy(), solid.copy()
    if n:
        starts[1:] &= ~solid[:-1] | edge[1:n]
        ends[:-1] &= ~solid[1:] | edge[1:n]
    start = np.flatnonzero(starts)
    end = np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


def rows_of(bounds: np.ndarray) -> np.ndarray:
    """For the items between consecutive bounds, the index of their row."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def windows(hashes: np.ndarray, bounds: np.ndarray, width: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of `width` items inside a row, and their rows.

    whole: a row with fewer items, but some, gives its whole sequence as one window.
    """
    n = len(hashes)
    row = rows_of(bounds)
    salt = mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(_P)) | np.uint64(1)
    count = np.diff(bounds)
    if n >= width:
        value = np.zeros(n - width + 1, np.uint64)
        for k in range(width):
            value += hashes[k : n - width + 1 + k] * salt[k]
        inside = row[: n - width + 1] == row[width - 1 :]
        value, at = mix(value[inside]), row[: n - width + 1][inside]
    else:
        value, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if whole and (short := np.flatnonzero((count > 0) & (count < width))).size:
        extra = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            has = count[short] > k
            extra[has] += hashes[bounds[short[has]] + k] * salt[k]
        value = np.concatenate([value, mix(extra ^ (count[short].astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))])
        at = np.concatenate([at, short])
        order = np.argsort(at, kind="stable")
        value, at = value[order], at[order]
    return value, at


def distinct(values: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, sorted by row then value; and the row bounds."""
    order = np.lexsort((values, rows))
    v, r = values[order], rows[order]
    keep = np.ones(len(v), bool)
    keep[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    v, r = v[keep], r[keep]
    return v, np.searchsorted(r, np.arange(n_rows + 1))


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = 5, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word-shingle hashes of each row and the row bounds."""
    text = LOWER[data] if lower else data
    start, end, bounds = words(text, offsets)
    value, row = windows(span_hash(prefix_hash(text), start, end), bounds, width, whole=True)
    return distinct(value, row, len(offsets) - 1)


def code_points(data: np.ndarray) -> np.ndarray:
    """C with C[i] = the number of code points that start in the first i bytes."""
    c = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=c[1:])
    return c
