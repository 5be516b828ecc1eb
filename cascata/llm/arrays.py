"""Array helpers that the text operators share inside tasks."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

EMPTY = np.uint64(0)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class HashIndex:
    """Map 64-bit keys to the row numbers 0, 1, 2, ... in the order of insertion; many keys at a time.

    Open addressing in two arrays that double when half full. Key 0 is reserved (it marks a
    free slot) and is stored as 1.
    """

    def __init__(self, bits: int = 12) -> None:
        self.bits, self.size = bits, 0
        self.keys = np.zeros(1 << bits, np.uint64)
        self.rows = np.zeros(1 << bits, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where it is not there."""
        keys = np.where(keys == EMPTY, np.uint64(1), keys)
        found = np.full(len(keys), -1, np.int32)
        slots = self._slots(keys)
        seen = self.keys[slots]
        hit = seen == keys
        found[hit] = self.rows[slots[hit]]
        open_ = np.flatnonzero(~hit & (seen != EMPTY))
        while open_.size:
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
            seen = self.keys[slots[open_]]
            hit = seen == keys[open_]
            found[open_[hit]] = self.rows[slots[open_[hit]]]
            open_ = open_[~hit & (seen != EMPTY)]
        return found

    def add(self, keys: np.ndarray) -> None:
        """Insert distinct keys that are not there yet."""
        keys = np.where(keys == EMPTY, np.uint64(1), keys)
        if 2 * (self.size + len(keys)) > 1 << self.bits:
            while 2 * (self.size + len(keys)) > 1 << self.bits:
                self.bits += 1
            used = self.keys != EMPTY
            old_keys, old_rows = self.keys[used], self.rows[used]
            self.keys, self.rows = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
            self._place(old_keys, old_rows)
        self._place(keys, np.arange(self.size, self.size + len(keys), dtype=np.int32))
        self.size += len(keys)

    def _place(self, keys: np.ndarray, rows: np.ndarray) -> None:
        slots = self._slots(keys)
        while keys.size:
            free = np.flatnonzero(self.keys[slots] == EMPTY)
            taken, first = np.unique(slots[free], return_index=True)
            won = free[first]
            self.keys[taken], self.rows[taken] = keys[won], rows[won]
            rest = np.ones(len(keys), bool)
            rest[won] = False
            keys, rows, slots = keys[rest], rows[rest], (slots[rest] + 1) & ((1 << self.bits) - 1)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every range, one range after another."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - ends + lengths, lengths)


def give_back() -> None:
    """Return freed memory to the machine: a Python worker is kept for later tasks, and with it all it ever held."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
        if trim:
            trim(0)


def byte_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def byte_lengths(column: pa.Array | pa.ChunkedArray) -> list[int]:
    """How many UTF-8 bytes each text has, without a copy of the texts; null counts as empty."""
    return pc.binary_length(column).fill_null(0).to_pylist()


def slices(sizes: list[int], most: int, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Cut a list into runs whose sizes add up to at most ``most``; a larger single item is a run of its own."""
    begin = total = 0
    for i, size in enumerate(sizes):
        if i > begin and (total + size > most or i - begin >= rows):
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def whole_groups(blocks: Iterator[pa.RecordBatch], keys: list[str], least: int = 8192) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of sorted rows that hold whole groups, with the row at which each group starts.

    A table has at least ``least`` rows, except the last, and ends with a group.
    """
    held: list[pa.RecordBatch] = []

    def starts_of(table: pa.Table) -> np.ndarray:
        change = np.zeros(table.num_rows, bool)
        change[0] = True
        for key in keys:
            values = table.column(key).to_numpy()
            change[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(change)

    for block in blocks:
        if not block.num_rows:
            continue
        held.append(block)
        if sum(b.num_rows for b in held) < least:
            continue
        table = pa.Table.from_batches(held)
        starts = starts_of(table)
        if len(starts) > 1:
            cut = int(starts[-1])
            yield table.slice(0, cut), starts[:-1]
            held = pa.table(table.slice(cut)).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, starts_of(table)


def vectors_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All components as doubles, where each row's begin, and how many it has; a null row has none, a null component is NaN."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    values = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    return values, np.cumsum(lengths) - lengths, lengths


def usable(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows that have components, all of them finite and not all zero."""
    good = np.zeros(len(lengths), bool)
    full = np.flatnonzero(lengths > 0)
    if full.size:
        finite = np.minimum.reduceat(np.isfinite(values), starts[full])
        nonzero = np.maximum.reduceat(values != 0, starts[full])
        good[full] = finite & nonzero
    return good
