"""Words and their hashes in Arrow string columns, by numpy over the raw bytes of a batch.

A word is a maximal run of digits, letters a-z (A-Z are lowered) and characters beyond ASCII.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BYTE = np.arange(256)
IS_WORD = ((_BYTE >= 0x30) & (_BYTE <= 0x39)) | ((_BYTE >= 0x41) & (_BYTE <= 0x5A)) | ((_BYTE >= 0x61) & (_BYTE <= 0x7A)) | (_BYTE >= 0x80)
LOWER = np.where((_BYTE >= 0x41) & (_BYTE <= 0x5A), _BYTE + 32, _BYTE).astype(np.uint8)
#: A random odd base and random byte values: words are hashed as polynomials modulo 2^64.
_RNG = np.random.default_rng(20260101)
_VALUE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)[LOWER]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        more = min(done, n - done)
        np.multiply(out[:more], np.uint64(pow(base, done, 1 << 64)), out=out[done : done + more])
        done += more
    return out


_UP, _DOWN = _powers(_BASE, _STEP), _powers(_INVERSE, _STEP)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all their bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(29)
    return h


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the row offsets in them; a null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def spans(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end bytes of all words; no word goes over the end of its row."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = IS_WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = rows[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word. Bytes are taken in blocks whose powers are kept; a word over a block's end is done alone."""
    out = np.empty(len(start), np.uint64)
    sums = np.empty(min(_STEP, len(data)) + 1, np.uint64)
    for at in range(0, len(data), _STEP):
        to = min(at + _STEP, len(data))
        i, j = np.searchsorted(start, (at, to))
        if i == j:
            continue
        sums[0] = 0
        np.cumsum(_VALUE[data[at:to]] * _UP[: to - at], out=sums[1 : to - at + 1])
        s, e = start[i:j] - at, np.minimum(end[i:j], to) - at
        out[i:j] = (sums[e] - sums[s]) * _DOWN[s]
        if end[j - 1] > to:
            k, total, power = start[j - 1], 0, 1
            for block in range(k, end[j - 1], _STEP):
                v = _VALUE[data[block : min(block + _STEP, end[j - 1])]]
                total += int((v * _UP[: len(v)]).sum(dtype=np.uint64)) * power
                power = power * pow(_BASE, _STEP, 1 << 64) & ((1 << 64) - 1)
            out[j - 1] = total & ((1 << 64) - 1)
    return mixed(out)


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20):
    """Cut a batch into runs of rows with about so many bytes of text, or one longer row."""
    size = raw(batch.column(column))[1]
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(size, size[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column, and where each row's words begin (one more entry than rows)."""
    data, rows = raw(column)
    start, end = spans(data, rows)
    return hashes(data, start, end), np.searchsorted(start, rows)


def shingles(h: np.ndarray, n: int = 5) -> np.ndarray:
    """Hashes of the runs of n words of one row; fewer words are one run, no word is none."""
    if not len(h):
        return h
    n = min(n, len(h))
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + h[k : len(h) - n + 1 + k]
    return mixed(out)
