"""Verbatim overlap of documents with test texts, found in suffix arrays of the documents.

The documents are cut into shards of bounded size inside the tasks. Each shard's words are
numbered, its suffixes sorted, and every suffix of every test text is binary-searched in
all shards, which gives the places of its first ``window`` words; neighbouring places on
one diagonal are one longer match. A word that no test text has stands as zero: nothing
that reaches one can match, so suffixes beginning there are not sorted. Documents are
parted by a zero too, so no match spans two of them.

The tests travel to the tasks in blocks of at most ``TEST_BYTES``. More tests than that
take one pass over the documents for each block, with the marked words carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.store import written
from corpusloom.llm.words import ALNUM, LOWER, Words, blocks, text_bytes

WINDOW = 10
TEST_BYTES = 32 << 20


@dataclass
class Tests:
    """Distinct windows of a block of test texts, as numbers of a vocabulary from 1."""

    vocabulary: dict[bytes, int]
    windows: np.ndarray  # one row each, padded with zeros
    lengths: np.ndarray
    owners: list[np.ndarray]  # (item, first word) rows of each window
    items: list[str]


def build_tests(ids: list[str], texts: pa.Array, window: int) -> Tests:
    words = Words(*text_bytes(texts), ALNUM, LOWER)
    codes, vocabulary = words.codes()
    codes = codes.astype(np.int64) + 1
    numbers = {word: n for n, word in enumerate(vocabulary, 1)}
    found: dict[tuple, list[tuple[int, int]]] = {}
    for item in range(len(ids)):
        own = codes[words.first[item] : words.first[item + 1]].tolist()
        size = min(window, len(own))
        for at in range(len(own) - size + 1 if own else 0):
            found.setdefault(tuple(own[at : at + size]), []).append((item, at))
    lengths = np.array([len(w) for w in found], dtype=np.int64)
    table = np.zeros((len(found), window), dtype=np.int64)
    for row, w in enumerate(found):
        table[row, : len(w)] = w
    return Tests(numbers, table, lengths, [np.array(o) for o in found.values()], ids)


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes that begin with a test word, in the order of their words.

    ``codes`` ends with ``depth`` zeros. The order covers ``depth`` words, or fewer where
    a zero comes first. Several words are sorted as one number; ties go on.
    """
    bits = max(int(codes.max(initial=0)).bit_length(), 1)
    step = max(62 // bits, 1)
    starts = np.flatnonzero(codes)

    def packed(at: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
        key = np.zeros(len(at), dtype=np.int64)
        whole = np.ones(len(at), dtype=bool)
        for k in range(first, min(first + step, depth)):
            word = codes[at + k]
            key = key << bits | word
            whole &= word != 0
        return key, whole

    key, whole = packed(starts, 0)
    order = np.argsort(key, kind="stable")
    out, key, whole = starts[order], key[order], whole[order]
    at = np.arange(len(out))
    group = np.cumsum(np.concatenate([[False], key[1:] != key[:-1]])) if len(out) else at
    for first in range(step, depth, step):
        sizes = np.bincount(group, minlength=1)
        tied = whole & (sizes[group] > 1)
        at, group = at[tied], group[tied]
        if not len(at):
            break
        starts = out[at]
        key, whole = packed(starts, first)
        order = np.lexsort((key, group))
        out[at], key, whole, group = starts[order], key[order], whole[order], group[order]
        new = np.concatenate([[False], (key[1:] != key[:-1]) | (group[1:] != group[:-1])])
        group = np.cumsum(new)
    return out


def search(codes: np.ndarray, array: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one place of each window in the suffix array."""

    def bound(after: bool) -> np.ndarray:
        low = np.zeros(len(tests.lengths), dtype=np.int64)
        high = np.full(len(tests.lengths), len(array), dtype=np.int64)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) // 2
            right = np.full(len(open_), after)
            same, at = np.arange(len(open_)), array[middle]
            for k in range(tests.windows.shape[1]):
                same = same[tests.lengths[open_[same]] > k]
                if not len(same):
                    break
                mine, theirs = codes[at[same] + k], tests.windows[open_[same], k]
                right[same[mine < theirs]] = True
                right[same[mine > theirs]] = False
                same = same[mine == theirs]
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]

    return bound(False), bound(True)


@dataclass
class Matches:
    words: Words
    hit: np.ndarray  # one flag for each word of the shard
    items: list[set]  # ids for each text
    longest: list[tuple | None]  # (words, first word, item) for each text


def match(table: pa.Table, text: str, tests: Tests) -> Matches:
    """Marks the words of a shard that lie in an occurrence of a window."""
    words = Words(*text_bytes(table[text]), ALNUM, LOWER)
    depth = tests.windows.shape[1]
    texts = table.num_rows
    code, distinct = words.codes()
    number = (tests.vocabulary.get(word, 0) for word in distinct)
    code = np.fromiter(number, dtype=np.int64, count=len(distinct))[code]
    text_of = np.repeat(np.arange(texts), words.counts)
    place = np.arange(len(words)) + text_of
    codes = np.zeros(len(words) + texts + depth, dtype=np.int64)
    codes[place] = code
    array = suffix_array(codes, depth)
    low, high = search(codes, array, tests)

    found = np.flatnonzero(high > low)
    counts = (high - low)[found]
    window = np.repeat(found, counts)
    before = np.concatenate([[0], np.cumsum(counts)])
    at = array[np.repeat(low[found], counts) + np.arange(before[-1]) - np.repeat(before[:-1], counts)]
    step = np.bincount(at, minlength=len(codes) + 1)
    step = step - np.bincount(at + tests.lengths[window], minlength=len(codes) + 1)
    hit = (np.cumsum(step) > 0)[place]

    items: list[set] = [set() for _ in range(texts)]
    longest: list[tuple | None] = [None] * texts
    if len(at):
        begins = np.concatenate([[0], np.cumsum(words.counts + 1)])
        doc = np.searchsorted(begins, at, side="right") - 1
        owned = [tests.owners[w] for w in window]
        times = np.array([len(o) for o in owned])
        owner = np.concatenate(owned)
        rows = np.stack(
            [np.repeat(doc, times), owner[:, 0], np.repeat(at, times) - owner[:, 1],
             np.repeat(at, times), np.repeat(tests.lengths[window], times)], axis=1
        )
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1) | (rows[1:, 3] > rows[:-1, 3] + 1)
        run = np.flatnonzero(new)
        size = np.diff(np.append(run, len(rows))) - 1 + rows[run, 4]
        for (d, item, _, first, _), length in zip(rows[run].tolist(), size.tolist(), strict=True):
            items[d].add(tests.items[item])
            best = (length, -(first - int(begins[d])), tests.items[item])
            if longest[d] is None or best > longest[d]:
                longest[d] = best
    return Matches(words, hit, items, longest)


def _test_blocks(tests: DataFrame, key: str, text: str, window: int):
    """Broadcasts of the tests in blocks of bounded size."""
    spark = tests.sparkSession
    rows = tests.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    total = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    parts = -(-int(total) // TEST_BYTES) or 1
    for part in range(parts):
        chosen = rows
        if parts > 1:
            chosen = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part)
        block = chosen.toArrow()
        built = build_tests(block["id"].to_pylist(), block["text"].combine_chunks(), window)
        yield spark.sparkContext.broadcast(built)


_STATE = T.StructType(
    [
        T.StructField("_hits", T.BinaryType()),
        T.StructField("_items", T.ArrayType(T.StringType())),
        T.StructField("_hit", T.LongType()),
        T.StructField("_words", T.LongType()),
        T.StructField("_longest", T.LongType()),
        T.StructField("_longest_at", T.LongType()),
        T.StructField("_longest_item", T.StringType()),
    ]
)


def _pass(docs: DataFrame, text: str, tests) -> DataFrame:
    """Adds what one block of tests marks to the state columns of ``docs``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, text):
            found = match(table, text, tests.value)
            first = found.words.first
            hits, items, marked = [], [], []
            before = table["_hits"].to_pylist()
            held = table["_items"].to_pylist()
            best = list(zip(*(table[c].to_pylist() for c in _STATE.names[4:]), strict=True))
            for i in range(table.num_rows):
                now = np.packbits(found.hit[first[i] : first[i + 1]])
                if before[i] is not None:
                    now |= np.frombuffer(before[i], dtype=np.uint8)
                hits.append(now.tobytes())
                marked.append(int(np.bitwise_count(now).sum()))
                items.append(sorted(found.items[i].union(held[i] or ())))
                length, start, item = found.longest[i] or (0, 0, None)
                if best[i][0] is None or length > best[i][0]:
                    best[i] = (length, -start, item)
            state = [hits, items, marked, found.words.counts, *zip(*best, strict=True)]
            for name, values in zip(_STATE.names, state, strict=True):
                kind = table.schema.field(name)
                column = pa.array(values, type=kind.type)
                table = table.set_column(table.schema.get_field_index(name), kind, column)
            yield from table.to_batches()

    return docs.mapInArrow(work, docs.schema)


def scan(
    docs: DataFrame,
    tests: DataFrame,
    text: str = "text",
    test_key: str = "item_id",
    test_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """``docs`` with what the test texts share with each row.

    Adds ``n_words``, ``n_hit`` (words inside an occurrence of a window of a test text; a
    test text of fewer words is one window), ``items`` (ids of those tests as text, sorted,
    each once; a null id is ""), ``longest_words``, ``longest_at`` and ``longest_item``
    (the longest verbatim match, its first word and its test; 0, 0 and null without one;
    the earliest of equally long ones). Words are runs of digits, a-z and characters
    beyond ASCII after A-Z are lower-cased. Null and empty texts have no words; empty
    tests match nothing. One row out for each row in, whatever the other columns hold,
    except that their names must not be those of the added columns: those are replaced.
    """
    added = ["n_words", "n_hit", "items", "longest_words", "longest_at", "longest_item"]
    kept = docs.drop(*added, *_STATE.names)
    state = kept.withColumns({f.name: F.lit(None).cast(f.dataType) for f in _STATE})
    for number, block in enumerate(_test_blocks(tests, test_key, test_text, window)):
        if number:
            state, _ = written(state, "decontamination")
        state = _pass(state, text, block)
    values = {
        "n_words": F.col("_words"),
        "n_hit": F.col("_hit"),
        "items": F.col("_items"),
        "longest_words": F.col("_longest"),
        "longest_at": F.col("_longest_at"),
        "longest_item": F.col("_longest_item"),
    }
    return state.select(*kept.columns, *[v.alias(k) for k, v in values.items()])


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def remove_contaminated(docs: DataFrame, tests: DataFrame, text: str = "text", **options):
    """``docs`` without the rows that hold a window of a test text (see ``scan``)."""
    return scan(docs, tests, text, **options).filter("n_hit = 0").select(*docs.columns)
