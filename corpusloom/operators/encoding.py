"""Vocabularies, token ids, fixed-length rows, batches and language-model windows."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions import tokens as tk
from corpusloom.functions.det import uniform
from corpusloom.functions.text import UNKNOWN
from corpusloom.operators.indexing import with_index, with_running_total
from corpusloom.session import materialise

# Ids of the special tokens that precede a corpus vocabulary.
SPECIALS = [tk.BOS, tk.PAD, tk.EOS, UNKNOWN]
BOS_ID, PAD_ID, EOS_ID, UNKNOWN_ID = range(4)
IGNORED_LABEL = -100

#: Vocabularies up to this many bytes are sent to the tasks; larger ones are joined.
BROADCAST_LIMIT = 64 * 2**20


def build_vocab(token_rows: DataFrame, position: list[str], first_id: int = 0) -> DataFrame:
    """Distinct tokens numbered by first appearance: ``(token, token_id, n)``.

    ``token_rows`` has ``token`` and the ``position`` columns. One partial aggregation
    reduces the corpus to one row per distinct token before anything is ordered.
    """
    first = token_rows.groupBy("token").agg(
        F.count("*").alias("n"), F.min(_place(token_rows, position)).alias("first")
    )
    numbered = with_index(first, ["first"], "token_id")
    return numbered.select("token", (F.col("token_id") + first_id).alias("token_id"), "n")


def _place(df: DataFrame, position: list[str]) -> Column:
    """The position columns as one value that sorts like them.

    A number where the text id is one: a minimum over numbers is hash-aggregated, over
    structs it would sort all tokens first. Line and token positions are ints.
    """
    text_id, *within = position
    kinds = dict(df.dtypes)
    numbers = kinds[text_id] in ("int", "bigint") and all(kinds[c] == "int" for c in within)
    if not numbers or len(within) > 2:
        return F.struct(*position)
    place = F.lit(0).cast("bigint")
    for column in within:
        place = place * 2**31 + F.col(column)
    return F.col(text_id).cast("decimal(19,0)") * F.lit(Decimal(2**62)) + place


def with_specials(spark, vocab: DataFrame) -> DataFrame:
    """Put the special tokens in front of a vocabulary built with ``first_id=4``."""
    fixed = spark.range(len(SPECIALS)).select(
        F.get(F.lit(SPECIALS), F.col("id").cast("int")).alias("token"),
        F.col("id").alias("token_id"),
        F.lit(0).cast("bigint").alias("n"),
    )
    return fixed.union(vocab.filter(~F.col("token").isin(SPECIALS)))


def build_char_vocab(df: DataFrame, text_col: str) -> DataFrame:
    """Distinct characters numbered in code-point order."""
    distinct = df.select(F.explode(tk.chars(F.col(text_col))).alias("token")).distinct()
    return with_index(distinct, ["token"], "token_id")


def encode_rows(token_rows: DataFrame, vocab: DataFrame, unknown_id: int | None = None) -> DataFrame:
    """Replace ``token`` by ``token_id``; unknown tokens get ``unknown_id`` or null.

    No hint: Spark broadcasts the vocabulary when its size allows and shuffles both
    sides otherwise, where AQE splits the partitions of frequent tokens.
    """
    joined = token_rows.join(vocab.select("token", "token_id"), "token", "left").drop("token")
    if unknown_id is not None:
        joined = joined.withColumn("token_id", F.coalesce("token_id", F.lit(unknown_id)))
    return joined


def collect_ordered(df: DataFrame, keys: list[str], pos: str, value: str, name: str) -> DataFrame:
    """Put the tokens of one text back together as an array in position order."""
    pairs = F.sort_array(F.collect_list(F.struct(pos, value)))
    return df.groupBy(*keys).agg(pairs[value].alias(name))


def encode_texts(
    df: DataFrame,
    keys: list[str],
    columns: dict[str, str],
    vocab: DataFrame,
    tokenizer=tk.pieces,
    unknown_id: int | None = UNKNOWN_ID,
    limits: dict[str, int] | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """``keys`` and one id array per text column; ``columns`` maps array name to column.

    A text without tokens gets an empty array. ``limits`` keeps the leading tokens only,
    for operators whose result is a fixed-length row. A vocabulary within
    ``broadcast_limit`` bytes is looked up inside the tasks, without any shuffle; of a larger
    one its lowest ids are, and only the tokens that they leave are joined.
    """
    limits = limits or {}
    tokens = {}
    for name, column in columns.items():
        found = tokenizer(F.col(column))
        tokens[name] = F.slice(found, 1, limits[name]) if name in limits else found
    size = vocab.agg(
        F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("token")), F.lit(0)).alias("bytes")
    ).first()
    if size["bytes"] + 16 * size["n"] <= broadcast_limit:
        split = df.select(*keys, *[c.alias(n) for n, c in tokens.items()])
        return _look_up(split, keys, list(columns), vocab, unknown_id)
    head = _head(vocab, broadcast_limit)
    if head:
        split = df.select(*keys, *[c.alias(n) for n, c in tokens.items()])
        return _look_up_and_join(split, keys, list(columns), vocab, unknown_id, head)
    return _join_and_regroup(df, keys, tokens, vocab, unknown_id)


def _head(vocab: DataFrame, limit: int) -> int:
    """A power of two, or 0: the tokens of lower ids have at most ``limit`` bytes."""
    power = F.length(F.bin("token_id"))
    cost = F.sum(F.octet_length("token") + 16)
    sizes = vocab.filter("token_id >= 0").groupBy(power.alias("power")).agg(cost.alias("bytes"))
    head = total = 0
    for row in sizes.orderBy("power").collect():
        total += row["bytes"]
        if total > limit:
            break
        head = 1 << row["power"]
    return head


def _look_up_and_join(
    split: DataFrame, keys: list[str], names: list[str], vocab: DataFrame, unknown_id: int | None, head: int
) -> DataFrame:
    """Ids below ``head`` are looked up in the tasks; the tokens left are joined.

    Ids follow first appearance, so few tokens of a text are left. Rows have a number, which
    is written, so their keys may be equal or null.
    """
    table = vocab.filter(F.col("token_id") < head).select("token", "token_id").toArrow()
    shared = split.sparkSession.sparkContext.broadcast(
        (table["token"].combine_chunks(), table["token_id"].combine_chunks())
    )

    def ends_of(column):
        lengths = pc.fill_null(pc.list_value_length(column), 0)
        return np.concatenate([[0], np.cumsum(lengths.to_numpy(zero_copy_only=False))])

    def look_up(batches):
        known, ids = shared.value
        for batch in batches:
            done = [batch.column(k) for k in keys]
            rest = []
            for name in names:
                column = batch.column(name)
                tokens, ends = column.flatten(), ends_of(column)
                at = pc.index_in(tokens, value_set=known)
                done.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids.take(at)))
                left = np.flatnonzero(pc.is_null(at).to_numpy(zero_copy_only=False))
                pos = left - ends[np.searchsorted(ends, left, side="right") - 1]
                parts = [pa.array(pos, pa.int32()), tokens.take(pa.array(left))]
                places = pa.StructArray.from_arrays(parts, ["pos", "token"])
                offsets = pa.array(np.searchsorted(left, ends), pa.int32())
                rest.append(pa.ListArray.from_arrays(offsets, places))
            yield pa.RecordBatch.from_arrays([*done, *rest], [*keys, *names, *left_names])

    def fill(batches):
        for batch in batches:
            done = [batch.column(k) for k in keys]
            for name in names:
                column = batch.column(batch.schema.get_field_index(name))
                flat, ends = column.flatten(), ends_of(column)
                missing = pc.is_null(flat).to_numpy(zero_copy_only=False).copy()
                ids = pc.fill_null(flat, unknown_id or 0).to_numpy(zero_copy_only=False).copy()
                found = batch.column(batch.schema.get_field_index(f"_found_{name}"))
                row = np.repeat(np.arange(batch.num_rows), np.diff(ends_of(found)))
                pos, token_id = (p.to_numpy(zero_copy_only=False) for p in found.flatten().flatten())
                place = ends[row] + pos
                ids[place], missing[place] = token_id, False
                values = pa.array(ids, pa.int64(), mask=missing if unknown_id is None else None)
                done.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values))
            yield pa.RecordBatch.from_arrays(done, [*keys, *names])

    left_names = [f"_left_{n}" for n in names]
    kinds = dict(split.dtypes)
    schema = [f"`{k}` {kinds[k]}" for k in keys] + [f"`{n}` array<bigint>" for n in names]
    rest_schema = [f"`{n}` array<struct<pos:int,token:string>>" for n in left_names]
    coded = split.mapInArrow(look_up, ", ".join([*schema, *rest_schema]))
    coded = materialise(coded.withColumn("_row", F.monotonically_increasing_id()), "coded")

    def named(name: str) -> Column:
        return F.transform(
            f"_left_{name}", lambda t: F.struct(F.lit(name).alias("part"), t["pos"].alias("pos"), t["token"].alias("token"))
        )

    rows = coded.select("_row", F.inline(F.concat(*[named(n) for n in names])))
    rest = vocab.filter(F.col("token_id") >= head).select("token", "token_id")
    pair = F.struct(F.col("pos"), F.col("token_id").cast("bigint").alias("token_id"))
    found = rows.join(rest, "token").groupBy("_row").agg(
        *[F.collect_list(F.when(F.col("part") == n, pair)).alias(f"_found_{n}") for n in names]
    )
    some = F.greatest(F.lit(0), *[F.size(n) for n in left_names]) > 0
    with_rest = coded.filter(some).drop(*left_names).join(found, "_row", "left")
    filled = with_rest.unionByName(coded.filter(~some).drop(*left_names), allowMissingColumns=True)
    return filled.drop("_row").mapInArrow(fill, ", ".join(schema))


def _look_up(
    split: DataFrame, keys: list[str], names: list[str], vocab: DataFrame, unknown_id: int | None
) -> DataFrame:
    """Token arrays to id arrays, batch by batch, with the vocabulary in each task."""
    table = vocab.select("token", "token_id").toArrow()
    shared = split.sparkSession.sparkContext.broadcast(
        (table["token"].combine_chunks(), table["token_id"].combine_chunks())
    )
    unknown = pa.scalar(unknown_id, pa.int64())

    def run(batches):
        known, ids = shared.value
        for batch in batches:
            done = [batch.column(k) for k in keys]
            for name in names:
                column = batch.column(name)
                at = pc.index_in(column.flatten(), value_set=known)
                found = pc.fill_null(ids.take(at), unknown) if unknown_id is not None else ids.take(at)
                lengths = pc.fill_null(pc.list_value_length(column), 0)
                ends = np.concatenate([[0], np.cumsum(lengths.to_numpy(zero_copy_only=False))])
                done.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found))
            yield pa.RecordBatch.from_arrays(done, keys + names)

    kinds = dict(split.dtypes)
    schema = [f"`{k}` {kinds[k]}" for k in keys] + [f"`{n}` array<bigint>" for n in names]
    return split.mapInArrow(run, ", ".join(schema))


def _join_and_regroup(
    df: DataFrame,
    keys: list[str],
    tokens: dict[str, Column],
    vocab: DataFrame,
    unknown_id: int | None,
) -> DataFrame:
    """All columns through one explode, one vocabulary join and one regrouping.

    A row number keeps rows apart whose keys are equal or null. It is written, so that it
    stays the same when a lost task runs again.
    """
    split = df.select(*keys, *[column.alias(name) for name, column in tokens.items()])
    numbered = materialise(split.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    none = F.array().cast("array<struct<part:string,pos:int,token:string>>")
    parts = [F.coalesce(_numbered(name, F.col(name)), none) for name in tokens]
    rows = numbered.select("_row", *keys, F.inline_outer(F.concat(*parts)))
    encoded = encode_rows(rows, vocab, unknown_id)
    grouped = encoded.groupBy("_row", *keys).agg(
        *[
            F.sort_array(
                F.collect_list(F.when(F.col("part") == name, F.struct("pos", "token_id")))
            )["token_id"].alias(name)
            for name in tokens
        ]
    )
    return grouped.drop("_row")


def _numbered(part: str, tokens: Column) -> Column:
    return F.transform(
        tokens,
        lambda token, pos: F.struct(
            F.lit(part).alias("part"), pos.alias("pos"), token.alias("token")
        ),
    )


def decode_rows(id_rows: DataFrame, vocab: DataFrame, keys: list[str], sep: str = "") -> DataFrame:
    """Rows ``(keys, pos, token_id)`` back to one ``text`` per key; an id outside the
    vocabulary reads ``<unk>``."""
    named = id_rows.join(vocab.select("token_id", "token"), "token_id", "left")
    named = named.withColumn("token", F.coalesce("token", F.lit(UNKNOWN)))
    joined = collect_ordered(named, keys, "pos", "token", "tokens")
    return joined.select(*keys, F.array_join("tokens", sep).alias("text"))


def decode_texts(
    df: DataFrame,
    keys: list[str],
    ids: str,
    vocab: DataFrame,
    sep: str = "",
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """``keys`` and the ``text`` of each id array, where rows stay rows.

    An id outside the vocabulary reads ``<unk>``; an empty or null array is an empty text.
    A vocabulary within ``broadcast_limit`` bytes is looked up in the tasks; of a larger one
    the tokens are joined, and rows without ids come back by their number.
    """
    size = vocab.agg(
        F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("token")), F.lit(0)).alias("bytes")
    ).first()
    if size["bytes"] + 16 * size["n"] > broadcast_limit:
        numbered = materialise(
            df.select(*keys, ids).withColumn("_row", F.monotonically_increasing_id()), "numbered"
        )
        rows = numbered.select("_row", F.posexplode(ids).alias("pos", "token_id"))
        texts = decode_rows(rows, vocab, ["_row"], sep)
        joined = numbered.select("_row", *keys).join(texts, "_row", "left")
        return joined.select(*keys, F.coalesce("text", F.lit("")).alias("text"))
    table = vocab.select("token_id", "token").toArrow()
    shared = df.sparkSession.sparkContext.broadcast(
        (table["token_id"].combine_chunks(), table["token"].combine_chunks())
    )

    def run(batches):
        known, tokens = shared.value
        for batch in batches:
            column = batch.column(len(keys))
            at = pc.index_in(column.flatten(), value_set=known)
            found = pc.fill_null(tokens.take(at), UNKNOWN)
            lengths = pc.fill_null(pc.list_value_length(column), 0)
            ends = np.concatenate([[0], np.cumsum(lengths.to_numpy(zero_copy_only=False))])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)
            done = [batch.column(k) for k in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*done, pc.binary_join(lists, sep)], [*keys, "text"])

    kinds = dict(df.dtypes)
    schema = [f"`{k}` {kinds[k]}" for k in keys] + ["text string"]
    cut = df.select(*keys, F.col(ids).cast("array<bigint>"))
    return cut.mapInArrow(run, ", ".join(schema))


def pad_truncate(
    ids: Column, length: int, bos: int = BOS_ID, pad: int = PAD_ID, eos: int = EOS_ID
) -> tuple[Column, Column]:
    """Fixed-length ids with begin and end markers, and the attention mask."""
    marked = F.concat(
        F.array(F.lit(bos).cast("bigint")),
        F.slice(ids, 1, length - 2),
        F.array(F.lit(eos).cast("bigint")),
    )
    missing = F.lit(length) - F.size(marked)
    padded = F.concat(marked, F.array_repeat(F.lit(pad).cast("bigint"), missing))
    mask = F.concat(F.array_repeat(F.lit(1), F.size(marked)), F.array_repeat(F.lit(0), missing))
    return padded, mask


def encode_pairs(
    prompts: DataFrame, vocab: DataFrame, max_source: int = 42, max_target: int = 384
) -> DataFrame:
    """``(id, variant, input_ids, attention_mask, labels)`` of prompt rows."""
    keys = ["id", "variant"]
    encoded = encode_texts(
        prompts,
        keys,
        {"source_ids": "source", "target_ids": "target"},
        vocab,
        limits={"source_ids": max_source, "target_ids": max_target},
    )
    input_ids, mask = pad_truncate(F.col("source_ids"), max_source)
    labels, _ = pad_truncate(F.col("target_ids"), max_target)
    return encoded.select(
        *keys, input_ids.alias("input_ids"), mask.alias("attention_mask"), labels.alias("labels")
    )


def assign_batches(
    df: DataFrame,
    order: list[str],
    batch_size: int = 8,
    split_col: str = "split",
    shuffle: bool = False,
    seed: int = 42,
) -> DataFrame:
    """Consecutive batches of ``batch_size`` rows in each split; the last may be short."""
    if shuffle:
        df = df.withColumn("_draw", uniform(seed, *order))
        order = ["_draw", *order]
    placed = with_index(df, [split_col, *order], "_idx")
    starts = placed.groupBy(split_col).agg(F.min("_idx").alias("_start"))
    batch = F.floor((F.col("_idx") - F.col("_start")) / batch_size)
    return (
        placed.join(starts, split_col)
        .withColumn("batch_id", batch)
        .drop("_idx", "_start", "_draw")
    )


def pad_to_batch(
    df: DataFrame, batch_cols: list[str], column: str, pad: int
) -> DataFrame:
    """Pad an array column to the longest of its batch (a group of batch-size rows)."""
    longest = F.max(F.size(column)).over(W.partitionBy(*batch_cols))
    fill = F.array_repeat(F.lit(pad).cast("bigint"), longest - F.size(column))
    return df.withColumn(column, F.concat(column, fill))


def token_stream(encoded: DataFrame, key: str, ids: str = "ids") -> DataFrame:
    """One flat stream ``(pos, token_id)`` of the encoded texts in key order.

    Only the text lengths are put in order; tokens are numbered inside their text. The
    encoded texts are written once, as both the lengths and the tokens are read from them.
    """
    encoded = materialise(encoded, "encoded")
    lengths = encoded.select(key, F.size(ids).cast("bigint").alias("_n"))
    offsets = with_running_total(lengths, [key], "_n", "_offset").select(key, "_offset")
    return (
        encoded.join(offsets, key)
        .select("_offset", F.posexplode(ids).alias("_pos", "token_id"))
        .select((F.col("_offset") + F.col("_pos")).alias("pos"), "token_id")
    )


def lm_windows(
    stream: DataFrame, length: int, block_size: int, windows: int, seed: int = 42
) -> DataFrame:
    """Random windows ``(window_id, start, x, y)``; ``y`` is ``x`` one position later.

    The stream is cut into blocks longer than a window, so each window needs at most two
    of them: the join moves two rows per window, not one row per token.
    """
    if length <= block_size:
        raise ValueError("the stream must be longer than a window")
    width = block_size + 1
    start = F.floor(uniform(seed, "window_id") * float(length - block_size))
    wanted = (
        stream.sparkSession.range(windows)
        .withColumnRenamed("id", "window_id")
        .withColumn("start", start)
        .withColumn("first_block", F.floor(F.col("start") / width))
        .withColumn("last_block", F.floor((F.col("start") + block_size) / width))
        .withColumn(
            "block", F.explode(F.array_distinct(F.array("first_block", "last_block")))
        )
    )
    # Only blocks that a window needs are put together.
    blocks = (
        stream.withColumn("block", F.floor(F.col("pos") / width))
        .join(wanted.select("block").distinct(), "block", "left_semi")
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "token_id")))["token_id"].alias("ids"))
    )
    tokens = F.flatten(F.sort_array(F.collect_list(F.struct("block", "ids")))["ids"])
    offset = (F.col("start") - F.col("first_block") * width).cast("int")
    return (
        wanted.join(blocks, "block")
        .groupBy("window_id", "start", "first_block")
        .agg(tokens.alias("ids"))
        .select(
            "window_id",
            "start",
            F.slice("ids", offset + 1, block_size).alias("x"),
            F.slice("ids", offset + 2, block_size).alias("y"),
        )
    )
