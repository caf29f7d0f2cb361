"""Array functions on the word hashes of a batch of texts, inside a task.

A batch is flat: ``row``, the number of each word's text, and ``words``, its 64-bit hash. The
functions named ``_words`` are given the words themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WORD, TRIPLE = 0, 1
#: Words that are worked on at once; a longer text stays whole.
BATCH_WORDS = 2**20
#: Size of the largest bitmap of pairs.
BITMAP_BYTES = 64 * 2**20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit depends on all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chained(words: list[np.ndarray], start: int) -> np.ndarray:
    """One hash for each sequence; its k-th word is in the k-th array."""
    found = np.full(len(words[0]), start, dtype=np.uint64)
    for word in words:
        found = mixed((found + word) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    return found


def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and entries of a list column."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    entries = column.flatten().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), sizes), entries.astype(np.int64).view(np.uint64)


def joined(batches):
    """Flat batches of about ``BATCH_WORDS`` words from batches of one list column."""
    parts, held, rows = [], 0, 0
    for batch in batches:
        column, begin = batch.column(0), 0
        sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        while begin < len(column):
            before = ends[begin - 1] if begin else 0
            end = int(np.searchsorted(ends, before + BATCH_WORDS - held)) + 1
            row, words = lists(column.slice(begin, end - begin))
            parts.append((row + rows, words))
            held, rows, begin = held + len(words), rows + end - begin, end
            if held >= BATCH_WORDS:
                yield tuple(np.concatenate(p) for p in zip(*parts, strict=True))
                parts, held, rows = [], 0, 0
    if held:
        yield tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def joined_words(batches):
    """``(words, row)``: flat parts of about ``BATCH_WORDS`` words from batches of a list column."""
    for batch in batches:
        column, begin = batch.column(0), 0
        sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        while begin < len(column):
            before = ends[begin - 1] if begin else 0
            end = max(int(np.searchsorted(ends, before + BATCH_WORDS, side="right")), begin + 1)
            row = np.repeat(np.arange(end - begin), sizes[begin:end])
            yield column.slice(begin, end - begin).flatten(), row
            begin = end


def counted_words(words: pa.Array, row: np.ndarray, end: str):
    """Columns ``(w1, w2, nxt)`` of the distinct triples of a flat part, and their numbers.

    A text's last pair leads to ``end``; a text of two words has no triple.
    """
    coded = words.dictionary_encode()
    known = pa.concat_arrays([coded.dictionary, pa.array([end], words.type)])
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    at, last = _pairs(row)
    if not len(at):
        return
    after = np.where(last, len(known) - 1, code[np.minimum(at + 2, len(code) - 1)])
    parts, base = [code[at], code[at + 1], after], len(known)
    if base < 2**21:
        key, n = np.unique((parts[0] * base + parts[1]) * base + parts[2], return_counts=True)
        parts = [key // (base * base), key // base % base, key % base]
    else:
        parts, n = _counted(parts)
    yield [known.take(pa.array(p)) for p in parts], pa.array(n.astype(np.int64))


def packed_ngrams(row: np.ndarray, words: np.ndarray, n: int, groups: int):
    """Record batches ``(n, part, total, hashes)``: the distinct n-grams of each part."""
    size = max(len(words) - n + 1, 0)
    inside = np.flatnonzero(row[:size] == row[n - 1 :])
    if not len(inside):
        return
    gram = [words[inside + k] for k in range(n)]
    part = chained(gram, 2 * n) % np.uint64(groups)
    value = chained(gram, 2 * n + 1)
    order = np.lexsort((value, part))
    part, value = part[order], value[order]
    new = np.ones(len(part), dtype=bool)
    new[1:] = (part[1:] != part[:-1]) | (value[1:] != value[:-1])
    total = np.bincount(part.astype(np.int64), minlength=groups)
    sizes = np.bincount(part[new].astype(np.int64), minlength=groups)
    used = np.flatnonzero(total)
    offsets = np.concatenate([[0], np.cumsum(sizes[used]) * 8]).astype(np.int32)
    data = np.ascontiguousarray(value[new])
    hashes = pa.Array.from_buffers(
        pa.binary(), len(used), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    )
    yield pa.record_batch(
        [
            pa.array(np.full(len(used), n, dtype=np.int32)),
            pa.array(used.astype(np.int32)),
            pa.array(total[used].astype(np.int64)),
            hashes,
        ],
        ["n", "part", "total", "hashes"],
    )


def distinct(hashes: pa.ChunkedArray) -> int:
    """How many different 8-byte values a column of packed ones has."""
    parts = [np.frombuffer(h.as_buffer(), dtype=np.uint64) for h in hashes]
    return len(np.unique(np.concatenate(parts)))


def _pairs(row: np.ndarray):
    """Where a pair of neighbours begins that is not all of its text, and whether it is the last."""
    at = np.flatnonzero(row[:-1] == row[1:])
    here = row[at]
    last = np.ones(len(at), dtype=bool)
    last[:-1] = here[1:] != here[:-1]
    first = np.ones(len(at), dtype=bool)
    first[1:] = here[1:] != here[:-1]
    kept = ~(first & last)
    return at[kept], last[kept]


def triples(row: np.ndarray, words: np.ndarray, end: int):
    """``(row, pair, triple, after)``, hashes as signed numbers.

    A text's last pair leads to ``end``; a text of two words has no triple.
    """
    at, last = _pairs(row)
    ending = np.array([end], dtype=np.int64).view(np.uint64)[0]
    after = np.where(last, ending, words[np.minimum(at + 2, len(words) - 1)] if len(at) else ending)
    pair = chained([words[at], words[at + 1]], 0)
    triple = chained([words[at], words[at + 1], after], 1)
    return row[at], pair.view(np.int64), triple.view(np.int64), after.view(np.int64)


def bitmap_bits(pairs: int, limit: int = BITMAP_BYTES) -> int:
    """A power of two, sixteen bits a pair if ``limit`` bytes allow them."""
    return int(min(max(2 ** int(np.ceil(np.log2(max(pairs, 1) * 16))), 64), 2 ** int(np.log2(limit * 8))))


def _counted(columns: list[np.ndarray]):
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.diff(np.append(at, len(order)))


def counted_triples(row: np.ndarray, words: np.ndarray, end: int, bitmap: np.ndarray):
    """Record batches ``(kind, pair, triple, n)``.

    The triples whose pair has its bit set, counted; and each distinct successor once, as
    ``pair`` of the other kind.
    """
    _, pair, triple, after = triples(row, words, end)
    bit = pair & (len(bitmap) * 8 - 1)
    asked = (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
    (pair, triple), n = _counted([pair[asked], triple[asked]])
    after = np.unique(after)
    for kind, p, t, count in (
        (TRIPLE, pair, triple, n),
        (WORD, after, np.zeros_like(after), np.ones(len(after), dtype=np.int64)),
    ):
        kinds = pa.array(np.full(len(p), kind, dtype=np.int32))
        yield pa.record_batch(
            [kinds, pa.array(p), pa.array(t), pa.array(count.astype(np.int64))],
            ["kind", "pair", "triple", "n"],
        )
