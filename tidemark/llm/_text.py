"""Numpy text kernels used inside Arrow tasks.

Every kernel works on the UTF-8 bytes of a slice of an Arrow string column, so
a batch is handled by a few vectorised passes instead of a Python loop per
word. Words are maximal runs of bytes other than ASCII white space, with A-Z
lower-cased; the bytes of a longer UTF-8 sequence never look like white space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUE = None
_powers: tuple[np.ndarray, np.ndarray] | None = None


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def byte_values() -> np.ndarray:
    """A fixed 64-bit value for each byte."""
    global _VALUE
    if _VALUE is None:
        _VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
    return _VALUE


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, n at least."""
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        up, down = np.full(size, _BASE), np.full(size, _BASE_INV)
        up[0] = down[0] = 1
        _powers = np.cumprod(up), np.cumprod(down)
    return _powers


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[s:e] for each range, independent of where it lies."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _M2)


def string_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of row ranges with at most `limit` bytes, or one row."""
    col = batch.column(batch.schema.get_field_index(column))
    if not pa.types.is_string(col.type):
        col = col.cast(pa.string())
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if not n:
        return
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        end = min(end, n)
        yield first, end, raw[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes, bounds): byte ranges and hashes of all words, and each row's range of words."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.astype(np.uint64), np.zeros(len(offsets), np.int64)
    low = _LOWER[data]
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, range_hash(byte_values()[low], starts, ends), np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds) of every row's runs of `size` words, repeats kept.

    With `whole`, a row of fewer words has its whole sequence as its only run.
    """
    n, rows = len(hashes), len(bounds) - 1
    count = np.diff(bounds)
    full = np.maximum(count - size + 1, 0)
    run = np.zeros(max(n - size + 1, 0), dtype=np.uint64)
    for j in range(size):
        run += hashes[j : j + len(run)] * mix(np.array([j + 1], dtype=np.uint64) * _BASE)
    row_of = np.repeat(np.arange(rows), full)
    at = np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full) + np.repeat(bounds[:-1], full)
    out = mix(run[at] + np.uint64(size))
    if whole and (short := (count > 0) & (count < size)).any():
        extra = range_hash(hashes, bounds[:-1][short], bounds[1:][short])
        order = np.argsort(np.concatenate([row_of, np.flatnonzero(short)]), kind="stable")
        out = np.concatenate([out, extra])[order]
        full = full + short
    return out, np.concatenate([[0], np.cumsum(full)])


def long_array(values: list[np.ndarray]) -> pa.ListArray:
    """An Arrow array of lists of longs."""
    sizes = np.concatenate([[0], np.cumsum([len(v) for v in values])]) if values else np.zeros(1)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(sizes.astype(np.int32)), pa.array(flat.view(np.int64) if flat.dtype == np.uint64 else flat.astype(np.int64)))
