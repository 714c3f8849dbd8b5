"""Texts as byte arrays inside tasks: word spans, span hashes and sliding minima, all vectorised.

Texts are taken in runs of bounded size, so a task needs memory for one run, or for one very long
text, whatever the size of its partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
RUN_BYTES = 1 << 20  # text handled at once
_ODD = U64(0x9E3779B97F4A7C15)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def column_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column end to end, and the offset of each row plus the end; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(offsets: np.ndarray, most: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each, or of a single longer row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = max(first + 1, min(last, rows))
        yield first, last
        first = last


def text_runs(batches, column: str = "text", most: int = RUN_BYTES):
    """``(rows, bytes, offsets)`` for each run of texts of the Arrow batches; ``rows`` is the slice of the batch."""
    for batch in batches:
        data, offsets = column_bytes(batch.column(column))
        for a, b in runs(offsets, most):
            yield batch.slice(a, b - a), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (splitmix64 finaliser)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_tables: dict[int, np.ndarray] = {}


def _power_table(n: int, base: int) -> np.ndarray:
    held = _tables.get(base)
    if held is None or len(held) < n:
        held = _tables[base] = _powers(max(n, RUN_BYTES + 1), base)
    return held[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums; the hash of any span is then two lookups."""
    out = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum((data.astype(U64) + U64(1)) * _power_table(len(data), _BASE), out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span and its length."""
    inverse = _power_table(len(sums), _INVERSE)
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h ^ ((ends - starts).astype(U64) * _ODD))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of non-space bytes, and the number of words before each row (plus the total)."""
    word = ~IS_SPACE[data]
    first, last = word.copy(), word.copy()
    if len(data):
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < len(data))]
        joined = word[1:] & word[:-1]
        joined[cut - 1] = False  # a word never runs on into the next row
        first[1:] &= ~joined
        last[:-1] &= ~joined
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def row_of(counts_before: np.ndarray) -> np.ndarray:
    """Row number of each item, from the number of items before each row."""
    return np.repeat(np.arange(len(counts_before) - 1), np.diff(counts_before))


def shingles(hashes: np.ndarray, before: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each window of ``width`` words; a row with fewer words, but one, gives its whole sequence."""
    n = np.diff(before)
    rows = row_of(before)
    place = np.arange(len(hashes)) - before[rows]
    full = np.flatnonzero(place <= n[rows] - width)
    acc = np.zeros(len(full), dtype=U64)
    for j in range(width):
        acc = mix(acc * U64(31) + hashes[full + j] + U64(j + 1))
    short = np.flatnonzero((n > 0) & (n < width))
    tail = np.zeros(len(short), dtype=U64)
    for j in range(width - 1):
        has = n[short] > j
        at = before[short][has] + j
        tail[has] = mix(tail[has] * U64(31) + hashes[at] + U64(j + 1))
    tail = mix(tail + n[short].astype(U64) * _ODD)
    return np.concatenate([acc, tail]), np.concatenate([rows[full], short])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values: minima of windows twice as wide each time, and two that overlap."""
    if len(values) < width:
        return np.zeros(0, dtype=values.dtype)
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark longs."""
    return x.view(np.int64)
