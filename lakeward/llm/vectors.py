"""Text as numpy vectors inside Arrow tasks.

A batch of texts is viewed as one byte buffer with document offsets; words are
(start, end) positions in that buffer and windows of words or bytes get 64-bit
hashes from prefix sums of a polynomial (mod 2**64, finished with a mixer).
Work is done in blocks of bounded size, so memory follows the block, or the
single longest text, and never the partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: The words of most contracts are runs of bytes other than these.
SPACES = b" \t\n\x0b\x0c\r"
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (splitmix64's mixer), elementwise."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def return_large_arrays(size: int = 1 << 20) -> None:
    """From now on this process gives arrays of ``size`` bytes and more pages of
    their own, which go back to the system as soon as they are freed.  Else the
    C library keeps what a reused Python worker ever needed at once.  Where the
    library has no such setting nothing changes."""
    try:
        ctypes.CDLL(None).mallopt(-3, size)  # M_MMAP_THRESHOLD
    except (OSError, AttributeError):
        pass


def _byte_values(seed: int) -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=U) * U(_BASE) + U(seed))


class Polynomial:
    """Prefix sums of values times powers of an odd base; powers are kept."""

    def __init__(self, seed: int = 0):
        self.base = (_BASE * (2 * seed + 1) | 1) & _MASK
        self.values = _byte_values(seed)
        self._up = np.ones(1, U)
        self._down = np.ones(1, U)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            size = max(n, 1 << 16)
            inverse = pow(self.base, -1, 1 << 64)
            for name, b in (("_up", self.base), ("_down", inverse)):
                steps = np.full(size, U(b), dtype=U)
                steps[0] = U(1)
                setattr(self, name, np.cumprod(steps))
        return self._up, self._down

    def sums(self, values: np.ndarray) -> np.ndarray:
        """n + 1 prefix sums of 64-bit ``values``."""
        up, _ = self._powers(len(values) + 1)
        out = np.zeros(len(values) + 1, U)
        np.cumsum(values * up[: len(values)], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of values[start:end] for each pair; equal content, equal hash."""
        _, down = self._powers(len(sums))
        return mix64((sums[ends] - sums[starts]) * down[starts])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null reads as empty text."""
    col = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, np.int64, n + 1, col.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    lo, hi = int(offsets[0]), int(offsets[-1])
    return np.frombuffer(data, np.uint8, hi - lo, lo), offsets - lo


def rebased(column: pa.Array) -> pa.Array:
    """The same texts (null: empty) with offsets that start at 0; some Arrow
    kernels misread the offsets of a slice that was cast."""
    data, offsets = text_buffer(column)
    parts = [None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, parts)


def values(column: pa.Array) -> list:
    """Python values of a column without nulls."""
    return column.to_numpy(zero_copy_only=False).tolist()


def blocks(column: pa.Array, max_bytes: int = 1 << 21) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets) of runs of whole texts with
    at most ``max_bytes`` together; a longer text is a block of its own."""
    data, offsets = text_buffer(column)
    row, n = 0, len(column)
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + max_bytes, "right")) - 1
        end = min(n, max(row + 1, end))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """A batch in parts of so many rows: what is copied of a part stays small
    beside the batch."""
    for lo in range(0, len(batch), rows):
        yield batch.slice(lo, rows)


def word_table(separators: bytes) -> np.ndarray:
    """256 flags: the byte belongs to a word."""
    flags = np.ones(256, bool)
    flags[list(separators)] = False
    return flags


WORD_BYTES = word_table(SPACES)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes unchanged."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = WORD_BYTES):
    """(starts, ends, first word of each document plus the total)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = table[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | cut[1:n]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | cut[1:n]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, poly: Polynomial) -> np.ndarray:
    return poly.spans(poly.sums(poly.values[data]), starts, ends)


def window_starts(bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, document rows) of all windows of ``length`` units that lie
    within one document; ``bounds`` are the documents' unit offsets."""
    counts = np.maximum(np.diff(bounds) - length + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    return ranges(bounds[:-1], counts), rows


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated start, start + 1, ... for each (start, count)."""
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(starts - before, counts)


def covered(positions: np.ndarray, length: int, total: int) -> np.ndarray:
    """Flags of the units that lie in a window starting at a position."""
    opened = np.cumsum(np.bincount(positions, minlength=total)[:total])
    flags = opened > 0
    flags[length:] = opened[length:] > opened[:-length]
    return flags


def narrow(values: np.ndarray) -> np.ndarray:
    """Non-negative numbers below 2**32 in 16 bits each if they fit, else 32."""
    return values.astype(np.uint16 if not len(values) or int(values.max()) < 1 << 16 else np.uint32)


def wide(cell: pa.Scalar, n: int) -> np.ndarray:
    """``n`` numbers of a binary cell that ``narrow`` made."""
    raw = cell.as_buffer()
    return np.frombuffer(raw, np.uint16 if len(raw) == 2 * n else np.uint32).astype(np.int64)


def binary_array(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary cells of the bytes of ``values[cuts[i]:cuts[i + 1]]``."""
    values = np.ascontiguousarray(values)
    offsets = (np.asarray(cuts, np.int64) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])
