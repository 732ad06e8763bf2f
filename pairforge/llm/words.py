"""Words of a text and hashes of its word windows, as numpy arrays.

Texts are bytes here. ``bytes.split`` separates at exactly the six characters space and \\x09-\\x0D, so
``joined`` has the words of ``[^\\x20\\x09-\\x0D]+`` with one space between them, whatever the whitespace was.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
TO_LOWER = bytes.maketrans(UPPER, LOWER)
_PRIME = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_PRIME, -1, 1 << 64)
_SLICE = 1 << 16  # windows hashed at a time, which bounds the power tables
_tables: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _tables or len(_tables[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        _tables[:] = [
            np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, base, np.uint64)]), dtype=np.uint64)
            for base in (_PRIME, _INVERSE)
        ]
    return _tables[0], _tables[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bounds(joined: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, and start and end of each word, of words joined by one space."""
    data = np.frombuffer(joined, np.uint8)
    if not len(data):
        return data, np.empty(0, np.int64), np.empty(0, np.int64)
    gaps = np.flatnonzero(data == 32)
    return data, np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(data)]])


def window_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of the bytes of every ``width`` consecutive words; empty if there are fewer words.

    A polynomial prefix sum modulo 2**64 gives each window by one subtraction. Slices of the text are
    hashed one after the other, so memory does not grow with its length.
    """
    n = len(starts) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.empty(n, np.uint64)
    for at in range(0, n, _SLICE):
        to = min(n, at + _SLICE)
        base, stop = starts[at], ends[to + width - 2]
        power, inverse = _powers(stop - base + 1)
        sums = np.zeros(stop - base + 1, np.uint64)
        np.cumsum((data[base:stop].astype(np.uint64) + np.uint64(1)) * power[: stop - base], out=sums[1:])
        left, right = starts[at:to] - base, ends[at + width - 1 : to + width - 1] - base
        out[at:to] = (sums[right] - sums[left]) * inverse[left]
    return mix(out)


def rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples of the named columns."""
    for batch in batches:
        for at in range(0, batch.num_rows, 128):  # few rows at a time are Python objects
            part = batch.slice(at, 128)
            yield from zip(*(part.column(part.schema.get_field_index(n)).to_pylist() for n in names))


class Sink:
    """Collects rows or arrays column by column and gives them back as Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema, rows: int = 20_000, size: int = 8 << 20):
        self.schema, self.rows, self.size = schema, rows, size
        self._start()

    def _start(self):
        self.columns: list[list] = [[] for _ in self.schema]
        self.n = self.bytes = 0

    def add(self, *values, size: int = 64) -> None:
        for column, value in zip(self.columns, values):
            column.append(value)
        self.n += 1
        self.bytes += size

    def full(self) -> bool:
        return self.n >= self.rows or self.bytes >= self.size

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            arrays = [pa.array(c, f.type) for c, f in zip(self.columns, self.schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)
            self._start()
