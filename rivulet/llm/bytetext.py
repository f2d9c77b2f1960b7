"""Texts of an Arrow batch as one byte array: words, lower-casing and hashes of any substring
without a Python object per word."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

# Bytes that part words: 0x09-0x0D and the space.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

# All of ASCII but letters and digits.
PUNCTUATION = np.array([x < 128 and not chr(x).isalnum() for x in range(256)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# At most this many bytes of text are held as one array.
SLICE_BYTES = 1 << 20


def text_slices(column: pa.Array, most: int = SLICE_BYTES):
    """(first row, row count, bytes, row offsets) over a string column, in slices of about `most`
    bytes; a longer text is a slice of its own. Null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last - first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last
    # Idle workers of earlier stages stay in memory next to those at work: keep no more than needed.
    pa.default_memory_pool().release_unused()


def give_back() -> None:
    """Hand freed memory back to the machine, which executors and their idle workers share."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(
    data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of bytes outside `breaks`; words never cross rows."""
    word = np.zeros(len(data) + 1, dtype=bool)
    np.logical_not(breaks[data], out=word[: len(data)])
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[edges] |= word[edges]
    ends[edges - 1] |= word[edges - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends[: len(data)]) + 1
    return starts, stops, np.searchsorted(offsets, starts, side="right") - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def _tables(seed: int) -> tuple[np.ndarray, int]:
    rng = np.random.default_rng(seed)
    table = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return table, int(rng.integers(1 << 61, 1 << 62)) * 8 + 5 & (1 << 64) - 1


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, size: int) -> np.ndarray:
    """Powers of a base from 0 up, `size` at least; kept for the task."""
    if len(_POWERS.get(base, ())) < size:
        powers = np.full(size, base, dtype=np.uint64)
        powers[0] = 1
        _POWERS[base] = np.multiply.accumulate(powers)
    return _POWERS[base]


class SubstringHash:
    """64-bit polynomial hashes of substrings, from running sums; equal bytes hash alike wherever
    they stand. Two seeds give independent hashes."""

    def __init__(self, values: np.ndarray, seed: int = 1):
        table, base = _tables(seed)
        n = len(values)
        size = 1 << max(10, n.bit_length())
        terms = table[values] if values.dtype == np.uint8 else mixed(values + np.uint64(seed))
        self._sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(terms * _powers(base, size)[:n], out=self._sums[1:])
        self._back = _powers(_inverse(base), size)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        x = (self._sums[ends] - self._sums[starts]) * self._back[starts]
        return mixed(x + (ends - starts).astype(np.uint64))


def distinct_in_rows(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, values and counts of the distinct pairs, by row and value."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    at = np.flatnonzero(new)
    return rows[at], values[at], np.diff(np.append(at, len(rows)))
