"""Words of many texts at once as numpy arrays, for use inside Arrow tasks.

Texts are handled as UTF-8 bytes. A task's batches are cut at whole rows so that one
block holds a bounded number of bytes; a single longer text is a block of its own.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Lower-cases A-Z and leaves other bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words made of digits, a-z and everything beyond ASCII (after LOWER).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

#: Bytes of words parted by blank, tab, line feed, vertical tab, form feed and return.
VISIBLE = np.ones(256, dtype=bool)
VISIBLE[[32, 9, 10, 11, 12, 13]] = False

BLOCK_BYTES = 2 << 20
BLOCK_ROWS = 100_000


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and where each begins; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    begins = np.frombuffer(column.buffers()[1], dtype=np.int64)
    begins = begins[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None or len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[begins[0] : begins[-1]]
    return data, begins - begins[0]


def blocks(
    batches: Iterator[pa.RecordBatch], text: str, size: int = BLOCK_BYTES
) -> Iterator[pa.Table]:
    """The rows of all batches in tables of about ``size`` bytes of text each at most.

    Small batches are put together and large ones cut, always between rows.
    """
    kept, held, rows = [], 0, 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch])
        _, begins = text_bytes(table[text])
        start = 0
        while start < table.num_rows:
            room = begins[start] + size - held
            stop = max(int(np.searchsorted(begins, room, side="right")) - 1, start)
            stop = min(stop, start + BLOCK_ROWS - rows)
            if stop == start and held == 0:
                stop = start + 1
            if stop > start:
                kept.append(table.slice(start, stop - start))
                held += int(begins[stop] - begins[start])
                rows += stop - start
            if stop < table.num_rows or held >= size or rows >= BLOCK_ROWS:
                yield pa.concat_tables(kept)
                kept, held, rows = [], 0, 0
            start = stop
    if kept:
        yield pa.concat_tables(kept)
    del kept
    release()


def release() -> None:
    """Gives freed memory back to the machine: workers live on after their task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


class Words:
    """Where the words of a block of texts begin and end.

    ``data`` holds the bytes after ``lower``; ``first[i]`` to ``first[i + 1]`` are the
    words of text i. A word never spans two texts.
    """

    def __init__(self, data, begins, word: np.ndarray, lower: np.ndarray | None = None):
        self.data = data if lower is None else lower[data]
        self.begins = begins
        inside = word[self.data]
        edge = np.zeros(len(inside) + 1, dtype=bool)
        edge[begins] = True
        step = inside.copy()
        step[1:] &= ~inside[:-1] | edge[1:-1]
        self.starts = np.flatnonzero(step)
        step = inside.copy()
        step[:-1] &= ~inside[1:] | edge[1:-1]
        self.ends = np.flatnonzero(step) + 1
        self.first = np.searchsorted(self.starts, begins)
        self._inside = inside

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def codes(self) -> tuple[np.ndarray, list[bytes]]:
        """A number for each word and the distinct words in the order of the numbers."""
        return number_pieces(self.data[self._inside], self.ends - self.starts)


def number_pieces(flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Numbers equal pieces of ``flat`` alike; the distinct pieces by number."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=offsets[1:])
    values = pa.Array.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(flat)]
    )
    coded = values.dictionary_encode()
    distinct = coded.dictionary
    ends = np.frombuffer(distinct.buffers()[1], dtype=np.int64)[: len(distinct) + 1].tolist()
    raw = distinct.buffers()[2].to_pybytes() if len(distinct) else b""
    pieces = [raw[a:b] for a, b in zip(ends, ends[1:], strict=False)]
    return coded.indices.to_numpy(zero_copy_only=False), pieces


def mix(value: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers over all bits (the finishing step of splitmix64)."""
    value = value.astype(np.uint64)
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))
