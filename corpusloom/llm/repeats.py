"""Long verbatim repeats between and inside documents, by compacting a graph of word k-mers.

Every window of ``window`` words is an edge of a de Bruijn graph. Edges are not sent one by
one: consecutive windows of a text that have the same anchor (the run of ``anchor`` words
with the smallest hash inside the window, the leftmost of equals) form a path without a
branch as far as this text goes, and travel as one row of the anchor's bucket. Equal windows
have equal anchors, so all copies of an edge meet in one bucket:

* paths with the same words are one class; all of its members but the first (smallest key,
  then smallest start) are repeated as a whole, with the first one's place as their source;
* a bucket with several classes is where paths branch or end. Only the first members of its
  classes are then opened into single windows, which are compared the same way.

A text's repeated paths are joined again where they continue each other both here and at
their source, which gives its repeated spans. Equality means equal 64-bit hashes of the
anchor and of the whole words, or equal 128-bit hashes of a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.store import drop_table, written
from corpusloom.llm.words import VISIBLE, Words, blocks, mix, text_bytes

WINDOW = 20
ANCHOR = 8
SEED = 42
#: Bytes of text that a task works on at a time, and rows of a bucket.
BLOCK = 2 << 20
ROWS = 100_000
#: In ``source_start`` of a row that is not known to be repeated.
OPEN = -1


def _hashed_words(words: Words) -> np.ndarray:
    codes, distinct = words.codes()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, SEED) for w in distinct), np.uint64, len(distinct))[codes]


def _joined(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """All words with a blank after each, and where each word begins."""
    lengths = words.ends - words.starts
    begin = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum(lengths + 1, out=begin[1:])
    joined = np.full(begin[-1], 32, dtype=np.uint8)
    letters = np.ones(begin[-1], dtype=bool)
    letters[begin[1:] - 1] = False
    joined[letters] = words.data[words._inside]
    return joined, begin


def _anchors(hashes: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window by its first word the place of its anchor, and the anchors' hashes.

    Leftmost smallest of a span, from spans of powers of two.
    """
    grams = np.zeros(max(len(hashes) - anchor + 1, 0), dtype=np.uint64)
    for k in range(anchor):
        grams = mix(grams * np.uint64(31) + hashes[k : k + len(grams)])
    best = np.arange(len(grams))
    span, wanted = 1, window - anchor + 1

    def smaller(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(grams[left] <= grams[right], left, right)

    while 2 * span <= wanted:
        best = smaller(best[:-span], best[span:])
        span *= 2
    if span < wanted:
        best = smaller(best[: span - wanted], best[wanted - span :])
    return best, grams


def paths(words: Words, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Text, first word in it, windows, anchor hash and hash of all words of each path."""
    total = len(words)
    nothing = (np.zeros(0, dtype=np.int64),) * 3 + (np.zeros(0, dtype=np.uint64),) * 2
    if total < window:
        return nothing
    best, grams = _anchors(_hashed_words(words), window, anchor)
    text = np.repeat(np.arange(len(words.counts)), words.counts)
    at = np.flatnonzero(text[: total - window + 1] == text[window - 1 :])
    if not len(at):
        return nothing
    new = np.ones(len(at), dtype=bool)
    new[1:] = (best[at[1:]] != best[at[:-1]]) | (text[at[1:]] != text[at[:-1]])
    begins = np.flatnonzero(new)
    first, count = at[begins], np.diff(np.append(begins, len(at)))
    joined, begin = _joined(words)
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    ends = begin[first + count + window - 1] - 1
    whole = np.fromiter(
        (digest(raw[a:b], SEED) for a, b in zip(begin[first].tolist(), ends.tolist(), strict=True)),
        np.uint64,
        len(first),
    )
    return text[first], first - words.first[text[first]], count, grams[best[first]], whole


def _classes(bucket, whole, code, start) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows sorted by bucket, class, key and start: bucket starts, first of class, whether first.

    Rows of the same key and start as their class's first are first as well.
    """
    new_bucket = np.ones(len(bucket), dtype=bool)
    new_bucket[1:] = bucket[1:] != bucket[:-1]
    new = new_bucket.copy()
    new[1:] |= whole[1:] != whole[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    return new_bucket, first, (code == code[first]) & (start == start[first])


def _schema(key: T.DataType) -> T.StructType:
    fields = [
        ("bucket", T.LongType()), ("whole", T.LongType()), ("key", key), ("body", T.LongType()),
        ("start", T.LongType()), ("windows", T.LongType()),
        ("source", key), ("source_start", T.LongType()),
    ]
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def _table(bucket, whole, key, body, start, windows, source, source_start) -> pa.Table:
    numbers = {
        "bucket": bucket.view(np.int64), "whole": whole.view(np.int64), "key": key, "body": body,
        "start": start, "windows": windows, "source": source, "source_start": source_start,
    }
    return pa.table({k: v if isinstance(v, pa.ChunkedArray) else pa.array(v) for k, v in numbers.items()})


def _reduced(table: pa.Table, text, start, windows, bucket, whole) -> pa.Table:
    """The rows of a block of texts; those that repeat others of the block know their source.

    Only the first of a class stays open, so copies within a block are not sent to one task;
    what is settled goes to any.
    """
    key, body = table["key"], table["body"].to_numpy()
    rank = pc.rank(key.combine_chunks(), null_placement="at_end", tiebreaker="dense").to_numpy()[text]
    order = np.lexsort((start, rank, whole, bucket))
    text, start, windows, bucket, whole = (c[order] for c in (text, start, windows, bucket, whole))
    _, first, is_first = _classes(bucket, whole, rank[order], start)
    settled = ~is_first
    number = np.arange(len(text), dtype=np.uint64)
    bucket = np.where(settled, mix(bucket + number), bucket)
    whole = np.where(settled, np.uint64(0), whole)
    source = pa.array(np.where(settled, text[first], 0), mask=is_first)
    return _table(
        bucket, whole, key.take(pa.array(text)), body[text], start, windows,
        key.take(source), np.where(settled, start[first], OPEN),
    )


def _rows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """Every path of every text of ``(key, body, text)``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, "text", BLOCK):
            found = paths(Words(*text_bytes(table["text"]), VISIBLE), window, anchor)
            if len(found[0]):
                yield from _reduced(table, *found).to_batches(max_chunksize=ROWS)

    return docs.select("key", "body", "text").mapInArrow(work, _schema(docs.schema["key"].dataType))


def _opened(docs: DataFrame, window: int) -> DataFrame:
    """Single windows of the paths in ``opened`` of ``(key, body, text, opened)``.

    A path is start * 256 + windows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh128_intdigest
        for table in blocks(batches, "text", BLOCK):
            words = Words(*text_bytes(table["text"]), VISIBLE)
            joined, begin = _joined(words)
            raw = joined.tobytes()
            lists = table["opened"].combine_chunks()
            text = np.repeat(np.arange(table.num_rows), lists.value_lengths().to_numpy())
            packed = lists.flatten().to_numpy()
            start, count = packed >> 8, packed & 255
            text = np.repeat(text, count)
            before = np.repeat(np.cumsum(count) - count, count)
            start = np.repeat(start, count) + np.arange(len(text)) - before
            at = words.first[text] + start
            bounds = zip(begin[at].tolist(), (begin[at + window] - 1).tolist(), strict=True)
            hashes = b"".join(digest(raw[a:b], SEED).to_bytes(16, "little") for a, b in bounds)
            halves = np.frombuffer(hashes, dtype="<u8").reshape(-1, 2)
            one = np.ones(len(text), dtype=np.int64)
            if len(text):
                rows = _reduced(table, text, start, one, halves[:, 0].copy(), halves[:, 1].copy())
                yield from rows.to_batches(max_chunksize=ROWS)

    return docs.select("key", "body", "text", "opened").mapInArrow(
        work, _schema(docs.schema["key"].dataType)
    )


def _settled(rows: DataFrame) -> DataFrame:
    """The repeated rows with their source, and the open first rows of branching buckets.

    A bucket is read in order and never held: what is carried from one batch to the next is
    its first row, that of the present class, and those of equal key and start.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, branched = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            known = pc.greater_equal(table["source_start"], 0)
            yield from table.filter(known).to_batches()
            table = table.filter(pc.invert(known))
            old = 0
            if carried is not None:
                old = carried.num_rows
                table = pa.concat_tables([carried, table])
            if not table.num_rows:
                continue
            bucket, whole, start = (table[c].to_numpy() for c in ("bucket", "whole", "start"))
            key = table["key"].combine_chunks()
            code = key.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            new_bucket, first, is_first = _classes(bucket, whole, code, start)
            begins = np.flatnonzero(new_bucket)
            classes = np.add.reduceat(first == np.arange(len(first)), begins, dtype=np.int64)
            number = np.cumsum(new_bucket) - 1
            wanted = is_first & (classes[number] > 1)
            # Carried rows of a bucket that had branched before have been given out.
            wanted[:old] &= not branched
            yield from table.filter(pa.array(wanted)).to_batches()
            again = ~is_first
            again[:old] = False
            again = np.flatnonzero(again)
            if len(again):
                told = table.take(pa.array(again))
                told = told.set_column(6, "source", key.take(pa.array(first[again])))
                told = told.set_column(7, "source_start", pa.array(start[first[again]]))
                yield from told.to_batches()
            last = number == number[-1]
            branched = bool(classes[-1] > 1)
            last &= is_first & ((first == begins[-1]) | (first == first[-1]))
            carried = table.filter(pa.array(last)).combine_chunks()

    dealt = rows.repartition("bucket").sortWithinPartitions(
        "bucket", "whole", F.col("key").asc_nulls_last(), "start"
    )
    return dealt.mapInArrow(work, rows.schema)


def _spans(settled: DataFrame, window: int) -> DataFrame:
    """``(key, body, spans)``: the repeated paths of each text, bounded by its length."""
    one = F.struct("start", (F.col("windows") + (window - 1)).alias("words"), "source", "source_start")
    return settled.groupBy("key", "body").agg(F.collect_list(one).alias("spans"))


def _same(left: DataFrame, right: DataFrame):
    return left["_key"].eqNullSafe(right["key"]) & (left["_body"] == right["body"])


def _body(docs: DataFrame, key: str, text: str) -> Column:
    """A number that tells rows of one key apart: 0 as long as no key repeats."""
    repeated = docs.groupBy(F.col(key).alias("key")).count().filter("count > 1")
    return F.lit(0).cast("bigint") if repeated.isEmpty() else F.xxhash64(text)


def find(docs: DataFrame, key: str, text: str, body: Column, window: int, anchor: int) -> DataFrame:
    """``(key, body, spans)``: the repeated paths of each text that has any, written.

    ``spans`` is an array of ``(start, words, source, source_start)`` in any order: these
    words stand earlier, at that place of that key.
    """
    source = docs.select(F.col(key).alias("key"), body.alias("body"), F.col(text).alias("text"))
    settled, path = written(_settled(_rows(source, window, anchor)), "paths")
    packed = F.shiftleft("start", 8) + F.col("windows")
    opened = settled.filter(F.col("source_start") < 0).groupBy("key", "body")
    opened, opened_path = written(opened.agg(F.collect_set(packed).alias("opened")), "opened")
    left = source.select(F.col("key").alias("_key"), F.col("body").alias("_body"), "text")
    joined = left.join(opened, _same(left, opened))
    known = settled.filter(F.col("source_start") >= 0)
    edges = _settled(_opened(joined, window)).filter(F.col("source_start") >= 0)
    spans, _ = written(_spans(known.unionByName(edges), window), "spans")
    drop_table(docs.sparkSession, path)
    drop_table(docs.sparkSession, opened_path)
    return spans


def _kept(words: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each text joined by one blank."""
    joined, begin = _joined(words)
    letters = np.repeat(keep, np.diff(begin))
    own = np.diff(begin) * keep
    ends = np.concatenate([[0], np.cumsum(own)])[words.first]
    size = np.diff(ends)
    flat = joined[letters]
    # The blank after the last kept word of a text goes.
    last = ends[1:][size > 0] - 1
    flat = np.delete(flat, last)
    offsets = np.concatenate([[0], np.cumsum(np.maximum(size - 1, 0))]).astype(np.int64)
    parts = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))]
    return pa.Array.from_buffers(pa.large_string(), len(size), parts)


def _flat_spans(lists: pa.ListArray) -> dict[str, np.ndarray | pa.Array]:
    """The spans of all texts: text, start, words, source and its place."""
    lists = lists.fill_null([])
    flat = lists.flatten()
    found = {n: pc.struct_field(flat, n) for n in ("start", "words", "source", "source_start")}
    out = {n: v if n == "source" else v.to_numpy(zero_copy_only=False) for n, v in found.items()}
    out["text"] = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    return out


def glued(spans: dict, texts: int) -> pa.ListArray:
    """Spans that go on, or overlap, here and at their source alike as one; by start."""
    text, start, words = spans["text"], spans["start"], spans["words"]
    source = spans["source"].dictionary_encode(null_encoding="encode")
    code = source.indices.to_numpy(zero_copy_only=False)
    shift = spans["source_start"] - start
    order = np.lexsort((start, shift, code, text))
    text, start, words, code, shift = (c[order] for c in (text, start, words, code, shift))
    line = np.zeros(len(text), dtype=bool)
    line[1:] = (text[1:] == text[:-1]) & (code[1:] == code[:-1]) & (shift[1:] == shift[:-1])
    group = np.cumsum(~line)
    end, far = start + words, int((start + words).max(initial=0)) + 1
    reach = np.maximum.accumulate(end + group * far) - group * far
    new = ~line
    new[1:] |= start[1:] > reach[:-1]
    begins = np.flatnonzero(new)
    last = np.append(begins[1:], len(new)) - 1 if len(begins) else begins
    words = reach[last] - start[begins]
    text, start, code, shift = (c[begins] for c in (text, start, code, shift))
    order = np.lexsort((shift, code, start, text))
    fields = {
        "start": pa.array(start[order]),
        "words": pa.array(words[order]),
        "source": source.dictionary.take(pa.array(code[order])),
        "source_start": pa.array((start + shift)[order]),
    }
    offsets = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=texts))])
    values = pa.StructArray.from_arrays(list(fields.values()), list(fields))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def drop_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    anchor: int = ANCHOR,
) -> DataFrame:
    """``docs`` with the words that repeat an earlier passage of ``window`` words cut out.

    Words are parted by ASCII white space and taken as they are. A window is ``window``
    consecutive words of one row; it is repeated if the same words also start at a smaller
    key, or at an earlier word of the same key. All words of repeated windows go; windows
    are judged on the input, not on what is left. ``text`` becomes the kept words joined by
    one blank. Adds ``n_words`` and ``n_removed``, and ``repeats``: where the removed spans
    were and where their words stand first, (start, words, source, source_start) by start.
    A null text has no words and becomes empty. A null key is larger than any other. Rows
    that repeat a key are compared by their starts; equal rows have equal results, since
    neither is earlier. Other columns are kept, but for those named like the added ones. An
    empty table gives an empty one.
    """
    added = ["n_words", "n_removed", "repeats", "_key", "_body"]
    rest = docs.drop(*added)
    body = _body(rest, key, text)
    spans = find(rest, key, text, body, window, anchor)
    left = rest.withColumns({"_key": F.col(key), "_body": body})
    right = spans.select("key", "body", F.col("spans").alias("repeats"))
    joined = left.join(right, _same(left, right), "left")
    joined = joined.select(*(left[c] for c in rest.columns), right["repeats"])
    joined = joined.withColumns(
        {
            text: F.coalesce(F.col(text), F.lit("")),
            "n_words": F.lit(None).cast("bigint"),
            "n_removed": F.lit(None).cast("bigint"),
        }
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, text, BLOCK):
            words = Words(*text_bytes(table[text]), VISIBLE)
            spans = _flat_spans(table["repeats"].combine_chunks())
            step = np.zeros(len(words) + 1, dtype=np.int64)
            starts = words.first[spans["text"]] + spans["start"]
            np.add.at(step, starts, 1)
            np.add.at(step, starts + spans["words"], -1)
            gone = np.cumsum(step[:-1]) > 0
            total = np.concatenate([[0], np.cumsum(gone)])
            new = {
                text: _kept(words, ~gone),
                "n_words": pa.array(words.counts.astype(np.int64)),
                "n_removed": pa.array(np.diff(total[words.first]).astype(np.int64)),
                "repeats": glued(spans, table.num_rows),
            }
            for name, values in new.items():
                field = table.schema.field(name)
                at = table.schema.get_field_index(name)
                table = table.set_column(at, field, values.cast(field.type))
            yield from table.to_batches()

    return joined.mapInArrow(work, joined.schema).select(*rest.columns, *added[:3])
