"""Whole Arrow batches of texts as numpy arrays: words, lines and their hashes.

A `TextBlock` holds the UTF-8 bytes of some rows back to back. Words are runs of
bytes other than space and 0x09-0x0D, lines are split at 0x0A; both end at the
end of their text. Nothing is decoded to Python strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_ODD = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeded(seed: int, n: int) -> np.ndarray:
    """n fixed 64-bit numbers."""
    start = (seed * 0x632BE59BD9B4E019 + 1) % (1 << 64)
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_ODD) + np.uint64(start))


_BYTE_VALUES = seeded(1, 256)
_STEP_VALUES = seeded(2, 64) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < n:
        size = max(n, BLOCK_BYTES + 1)
        table = np.empty(size, np.uint64)
        table[0] = 1
        table[1:] = np.uint64(base)
        np.multiply.accumulate(table, out=table)
        if size <= 4 * BLOCK_BYTES:
            _powers[base] = table
    return table


class TextBlock:
    """Rows lo..hi of a string column; null counts as an empty text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = data
        self.offsets = offsets
        self.rows = len(offsets) - 1
        self._hashes: np.ndarray | None = None

    def _edges(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of `inside`, cut at the ends of texts."""
        filled = self.offsets[1:] > self.offsets[:-1]
        before = np.zeros(len(inside), bool)
        before[1:] = inside[:-1]
        before[self.offsets[:-1][filled]] = False
        after = np.zeros(len(inside), bool)
        after[:-1] = inside[1:]
        after[self.offsets[1:][filled] - 1] = False
        return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        return self._edges(~_SPACE[self.data])

    def runs(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs of bytes for which the 256-entry table `member` is true."""
        return self._edges(member[self.data])

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and rows of all lines; every text has at least one."""
        breaks = np.flatnonzero(self.data == 10)
        rows = np.searchsorted(self.offsets, breaks, "right") - 1
        starts = np.concatenate([self.offsets[:-1], breaks + 1])
        owner = np.concatenate([np.arange(self.rows), rows])
        order = np.lexsort((starts, owner))
        starts, owner = starts[order], owner[order]
        last = np.ones(len(owner), bool)
        last[:-1] = owner[1:] != owner[:-1]
        ends = np.empty_like(starts)
        ends[:-1] = starts[1:] - 1
        ends[last] = self.offsets[owner[last] + 1]
        return starts, ends, owner

    def row_bounds(self, starts: np.ndarray) -> np.ndarray:
        """Where each row's items begin, for items in text order (rows + 1 numbers)."""
        return np.searchsorted(starts, self.offsets)

    def row_sums(self, per_byte: np.ndarray) -> np.ndarray:
        total = np.zeros(len(per_byte) + 1, np.int64)
        np.cumsum(per_byte, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte spans; equal spans have equal hashes anywhere."""
        if self._hashes is None:
            terms = _BYTE_VALUES[self.data] * _power_table(_BASE, len(self.data) + 1)[: len(self.data)]
            self._hashes = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(terms, out=self._hashes[1:])
        inverse = _power_table(_BASE_INVERSE, len(self.data) + 1)
        return mix((self._hashes[ends] - self._hashes[starts]) * inverse[starts])


def lower_ascii(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def window_hashes(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of `width` items in a row, and the bounds of each row's windows.

    A row with 1 to width - 1 items has one window that holds them all.
    """
    counts = np.diff(bounds)
    per_row = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    starts = np.zeros(len(per_row) + 1, np.int64)
    np.cumsum(per_row, out=starts[1:])
    first = np.repeat(bounds[:-1] - starts[:-1], per_row) + np.arange(starts[-1])
    end = np.repeat(bounds[1:], per_row)
    total = np.zeros(len(first), np.uint64)
    for k in range(width):
        at = first + k
        inside = at < end
        total[inside] += hashes[at[inside]] * _STEP_VALUES[k]
    return mix(total), starts


def text_blocks(column: pa.Array) -> Iterator[tuple[int, int, TextBlock]]:
    """(lo, hi, block) over rows lo..hi of a string column."""
    if pa.types.is_large_string(column.type) or pa.types.is_string_view(column.type):
        column = column.cast(pa.large_string())
        kind = np.int64
    else:
        column = column.cast(pa.string())
        kind = np.int32
    n = len(column)
    if n == 0:
        return
    if column.null_count:
        column = column.fill_null("")
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + BLOCK_BYTES, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, TextBlock(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi
