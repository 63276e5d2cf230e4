"""Words of whole texts as 64-bit names, computed on Arrow buffers with numpy.

A word is a run of bytes other than ``\\x20 \\x09-\\x0D``. Equal words get equal names in
every task. All functions look at one slice of a record batch at a time, so memory
follows the slice (or its one very long text), not the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

_RANDOM = np.random.Generator(np.random.PCG64(20240131))
_BYTE = _RANDOM.integers(1, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE[_SPACE] = 0
#: Lower-cases and blanks all ASCII signs but letters and digits.
PLAIN = LOWER.copy()
PLAIN[[b for b in range(128) if not chr(b).isalnum()]] = 0x20
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 2 * len(_powers), 64), _BASE, np.uint64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a name over all bits; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts record batches into pieces of at most ``limit`` text bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), np.int64)
        piece = (np.cumsum(sizes) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column, and where each row begins (with an end). Null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of a text column: names, byte spans, and the first word of each row.

    ``letters`` replaces bytes first, such as ``LOWER``.
    """

    def __init__(self, column: pa.Array, letters: np.ndarray | None = None):
        n = self._cut(column, letters)
        self.name = _names(self.data, self.start, self.end, n)

    @classmethod
    def spans(cls, column: pa.Array) -> Words:
        """Without names."""
        found = cls.__new__(cls)
        found._cut(column, None)
        return found

    def _cut(self, column: pa.Array, letters: np.ndarray | None) -> int:
        data, rows = text_bytes(column)
        if letters is not None:
            data = letters[data]
        self.data, n = data, len(data)
        word = ~_SPACE[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        starts = rows[:-1][rows[:-1] < n]
        first[starts] = word[starts]
        last = word.copy()
        last[:-1] &= ~word[1:] | first[1:]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.row = np.searchsorted(self.start, rows)
        return n

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.row)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Names of all windows of n words within a row, and the index of each one's first word."""
        size = len(self.name)
        if size < n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        names = sequence_names(self.name, n)
        inside = np.ones(size - n + 1, bool)
        for k in range(1, n):
            edge = self.row[1:-1] - k
            inside[edge[(edge >= 0) & (edge < len(inside))]] = False
        at = np.flatnonzero(inside)
        return names[at], at

    def kept(self, row: int, keep: np.ndarray) -> bytes:
        """The words of a row with ``keep`` set, joined by one space."""
        a, b = self.row[row], self.row[row + 1]
        start, end = self.start[a:b][keep], self.end[a:b][keep]
        return joined(self.data, start, end)


def _names(data: np.ndarray, start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    if not len(start):
        return np.zeros(0, np.uint64)
    cut = int(start[0])
    span = np.diff(np.append(start, n))
    place = np.arange(cut, n) - np.repeat(start, span)
    values = _BYTE[data[cut:]] * powers(int(span.max()))[place]
    return mix(np.add.reduceat(values, start - cut) + (end - start).astype(np.uint64))


def joined(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    if not len(start):
        return b""
    size = end - start + 1
    stop = np.cumsum(size)
    source = np.arange(stop[-1]) + np.repeat(start - (stop - size), size)
    out = data[np.minimum(source, len(data) - 1)]
    out[stop - 1] = 0x20
    return out[:-1].tobytes()


def sequence_names(names: np.ndarray, n: int) -> np.ndarray:
    """The name of each run of n consecutive names."""
    size = len(names) - n + 1
    total = np.full(size, np.uint64(n), np.uint64)
    for k, factor in enumerate(powers(n + 1)[1:]):
        total += names[k : k + size] * factor
    return mix(total)
