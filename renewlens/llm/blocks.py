"""Array helpers on blocks of texts, used inside Spark tasks.

A block is the UTF-8 bytes of some rows plus their offsets. All work on it is
numpy, so the cost of a word is a few dozen nanoseconds, and memory is bounded
by ``BLOCK_BYTES`` or one text, whichever is larger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
# Space and tab to carriage return separate words; A-Z is lower-cased.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_STEP = 0x9E3779B97F4A7C15
_BASE = 0x5851F42D4C957F2D  # odd, hence invertible modulo 2**64
_MASK = (1 << 64) - 1


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(30)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(31)
    return v


def seeds(n: int, seed: int) -> np.ndarray:
    """``n`` repeatable 64-bit values."""
    start = np.uint64((seed * 0xD1342543DE82EF95 + 1) & _MASK)
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_STEP) + start)


_BYTE_VALUES = seeds(256, 1)
_powers = np.ones(1, np.uint64)
_inverse_powers = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse_powers
    if len(_powers) < n:
        size = max(n, 1 << 16)
        inverse = pow(_BASE, -1, 1 << 64)
        tables = []
        for factor in (_BASE, inverse):
            table = np.full(size, factor, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=np.uint64))
        _powers, _inverse_powers = tables
    return _powers, _inverse_powers


def byte_offsets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null row counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def blocks(
    column: pa.Array, limit: int = BLOCK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of at most ``limit`` bytes or one row: (first, end, bytes, offsets)."""
    data, bounds = byte_offsets(column)
    first, rows = 0, len(bounds) - 1
    while first < rows:
        end = int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), rows)
        yield first, end, data[bounds[first] : bounds[end]], bounds[first : end + 1] - bounds[first]
        first = end


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each lower-cased word, and where each row's words begin.

    The hash is a polynomial in the word's bytes, read off one running sum over
    the block, then mixed. Different words share a hash with a chance of about
    2**-64 a pair.
    """
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    gap = SEPARATORS[data]
    filled = bounds[:-1] < bounds[1:]
    before = np.empty(len(data), bool)
    before[1:] = gap[:-1]
    before[bounds[:-1][filled]] = True
    after = np.empty(len(data), bool)
    after[:-1] = gap[1:]
    after[bounds[1:][filled] - 1] = True
    starts = np.flatnonzero(before & ~gap)
    ends = np.flatnonzero(after & ~gap) + 1
    up, down = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[LOWER[data]] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts]), np.searchsorted(starts, bounds)


def run_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` values (64-bit), from one running sum."""
    up, down = _power_tables(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    count = len(values) - n + 1
    return mix((sums[n:] - sums[:count]) * down[:count])


def shingles(
    hashes: np.ndarray, first: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``width`` words, and where each row's runs begin.

    A row with fewer words has one run, all its words; a row without words none.
    """
    counts = np.diff(first)
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(runs)])
    out = np.zeros(begin[-1], np.uint64)
    long = counts >= width
    at = np.repeat(first[:-1][long] - begin[:-1][long], runs[long])
    place = np.flatnonzero(np.repeat(long, runs))
    source = place + at
    factor = np.uint64(_STEP)
    acc = np.zeros(len(place), np.uint64)
    for k in range(width):
        acc = acc * factor + hashes[source + k]
    out[place] = mix(acc + np.uint64(width))
    for row in np.flatnonzero((counts > 0) & ~long):
        value = 0
        for h in hashes[first[row] : first[row + 1]].tolist():
            value = (value * _STEP + h) & _MASK
        short = np.array([(value + int(counts[row])) & _MASK], np.uint64)
        out[begin[row]] = mix(short)[0]
    return out, begin


def grams(data: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all runs of ``n`` bytes inside a row, and the row of each."""
    size = len(data) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    code = np.zeros(size, np.uint64)
    for k in range(n):
        code = (code << np.uint64(8)) | data[k : k + size]
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = rows[:size] == rows[n - 1 :]
    return code[inside], rows[:size][inside]


def string_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A column by name, as strings, whatever else the batch holds."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.large_string())
