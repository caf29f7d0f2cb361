"""Forward and backward values of lines of any length, by an associative scan.

A line is rows of chunks, each of a bounded number of tokens, and every chunk becomes a
matrix. Consecutive chunks of a line that lie together are a segment, whose matrices are
multiplied where they are made. A line of several segments has their products multiplied
block by block, the products again, until one block has the whole line. On the way down each
block hands its segments, and a segment its chunks, the state probabilities they are entered
with and the backward values they leave with, and the chunks are then worked on by
themselves. No task holds more than a segment or a block of matrices, whatever the length of
a line; the number of levels is its logarithm. Matrices of a line that is one segment are
never sent or written.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import hmm_kernel as kernel
from corpusloom.operators.hmm import BROADCAST_LIMIT, Model, _with_emissions
from corpusloom.session import materialise

# What runs in the tasks travels with the job, so executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Tokens of a chunk, and matrices of a block.
CHUNK, FAN = 4096, 64
#: Tokens of a segment; a longer chunk is one by itself.
SEGMENT = 2**15
#: Up to so many lines of several segments are broadcast to tell them from the others.
FEW_CUT = 100_000


def cut_lines(lines: DataFrame, size: int = CHUNK) -> DataFrame:
    """``(_seq, _chunk, keys, ids)`` of rows with an ``ids`` array each; empty ones go.

    Lines have a number of their own, which is written, so their keys may be equal or null.
    """
    keys = [c for c in lines.columns if c != "ids"]
    numbered = lines.filter(F.size("ids") > 0).withColumn("_seq", F.monotonically_increasing_id())
    at = F.sequence(F.lit(0), F.floor((F.size("ids") - 1) / size).cast("int"))
    parts = F.transform(at, lambda i: F.slice("ids", i * size + 1, size))
    cut = numbered.select("_seq", *keys, F.posexplode(parts).alias("_chunk", "ids"))
    return materialise(cut.withColumn("_chunk", F.col("_chunk").cast("bigint")), "chunks")


def cut_tokens(rows: DataFrame, keys: list[str], size: int = CHUNK) -> DataFrame:
    """The same of rows ``(keys, pos, token_id)``: a line is never put together.

    ``keys`` tell the lines apart; positions run from 0 without gaps.
    """
    chunk = F.expr(f"CAST(pos AS BIGINT) div {size}").alias("_chunk")
    tokens = F.sort_array(F.collect_list(F.struct("pos", "token_id")))["token_id"]
    grouped = rows.groupBy(*keys, chunk).agg(tokens.alias("ids"))
    line = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("_seq")
    return materialise(grouped.select(line, "_chunk", *keys, "ids"), "chunks")


def _rows(table: DataFrame, function, schema: str) -> DataFrame:
    """The rows ``function`` makes of each row, as dictionaries; ``_seq`` is carried along."""
    kind = table.schema["_seq"].dataType.simpleString()
    names = [part.split()[0] for part in schema.split(", ")]
    arrow = {"bigint": pa.int64(), "array<double>": pa.list_(pa.float64())}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [{**out, "_seq": row["_seq"]} for row in batch.to_pylist() for out in function(row)]
            if made:
                line = batch.schema.field("_seq").type
                types = [line, *(arrow[p.split()[1]] for p in schema.split(", "))]
                columns = [
                    pa.array([m[n] for m in made], t)
                    for n, t in zip(["_seq", *names], types, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(columns, ["_seq", *names])

    return table.mapInArrow(work, f"_seq {kind}, {schema}")


def _parts(row: dict, k: int):
    rows = [np.array(p["rows"]).reshape(k, k) for p in row["parts"]]
    return rows, [np.array(p["logs"]) for p in row["parts"]]


_NODE = "_chunk bigint, rows array<double>, logs array<double>"
_VECTORS = "_chunk bigint, left array<double>, right array<double>"


def _vectors(nodes: DataFrame, pi: np.ndarray) -> DataFrame:
    """``(_seq, _chunk, left, right)``: what each chunk is entered and left with."""
    k = len(pi)
    listed = F.sort_array(F.collect_list(F.struct("_chunk", "rows", "logs"))).alias("parts")
    blocks = nodes.groupBy("_seq", F.expr(f"_chunk div {FAN}").alias("_block")).agg(listed)

    def up(row: dict):
        rows, logs = kernel.composed(*_parts(row, k))
        yield {"_chunk": row["_block"], "rows": rows.ravel().tolist(), "logs": logs.tolist()}

    def down(row: dict):
        ends = np.array(row["left"]), np.array(row["right"])
        before, after = kernel.entered(*_parts(row, k), *ends)
        for part, left, right in zip(row["parts"], before, after, strict=True):
            yield {"_chunk": part["_chunk"], "left": left.tolist(), "right": right.tolist()}

    if nodes.filter(F.col("_chunk") >= FAN).isEmpty():
        whole = [F.lit([float(p) for p in pi]).alias("left"), F.lit([1.0 / k] * k).alias("right")]
        return _rows(blocks.select("*", *whole), down, _VECTORS)
    above = _vectors(materialise(_rows(blocks, up, _NODE), "products"), pi)
    above = above.withColumnRenamed("_chunk", "_block")
    return _rows(blocks.join(above, ["_seq", "_block"]), down, _VECTORS)


def _segments(chunks: DataFrame, size: int) -> DataFrame:
    """``(_seq, _chunk, keys, sizes, ids)``: consecutive chunks of a line that lie together.

    ``_chunk`` is the first one, ``sizes`` has the tokens of each. Which chunks those are
    depends on how the table is read, so the segments are written.
    """
    kept = [f for f in chunks.schema if f.name != "ids"]
    names = [f.name for f in kept]

    def starts_of(batch: pa.RecordBatch) -> np.ndarray:
        seq, chunk = (batch.column(batch.schema.get_field_index(n)) for n in ("_seq", "_chunk"))
        other = pc.not_equal(seq.slice(1), seq.slice(0, len(seq) - 1)).to_numpy(zero_copy_only=False)
        begins = np.concatenate([[True], other | (np.diff(chunk.to_numpy()) != 1)])
        tokens = kernel.list_parts(batch, "ids")[0]
        before = np.cumsum(tokens) - tokens
        piece = (before - before[np.flatnonzero(begins)[np.cumsum(begins) - 1]]) // size
        begins[1:] |= piece[1:] != piece[:-1]
        return np.flatnonzero(begins)

    def made(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        sizes, ids = kernel.list_parts(batch, "ids")
        tokens = np.add.reduceat(sizes, starts)
        counts = np.diff(np.append(starts, batch.num_rows))
        at = pa.array(starts)
        own = [batch.column(batch.schema.get_field_index(n)).take(at) for n in names]
        lists = [kernel.list_column(counts, sizes.astype(np.int32)), kernel.list_column(tokens, ids)]
        return pa.RecordBatch.from_arrays([*own, *lists], [*names, "sizes", "ids"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the last segment so far, which the next batch may go on with
        for batch in batches:
            if not batch.num_rows:
                continue
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            starts = starts_of(batch)
            if len(starts) > 1:
                yield made(batch.slice(0, starts[-1]), starts[:-1])
            rest = batch.slice(starts[-1])
        if rest is not None:
            yield made(rest, np.array([0]))

    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
    schema = ", ".join([*own, "sizes array<int>", "ids array<bigint>"])
    return materialise(chunks.mapInArrow(work, schema), "segments")


def _batched(segments: DataFrame, model: Model, limit: int, compute, schema: str) -> DataFrame:
    """The columns that ``compute(batch, layout, emissions)`` makes of batches of segments.

    ``layout`` is that of their chunks. Columns that have a row for each chunk go beside the
    other columns of the segment.
    """
    kept = [f for f in segments.schema if f.name not in ("sizes", "ids", "left", "right")]
    names = [f.name for f in kept]
    lines, with_emissions = _with_emissions(segments, model, limit)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, emitted in with_emissions(batches):
            counts, sizes = kernel.list_parts(batch, "sizes")
            layout = kernel.Layout(sizes.astype(np.int64))
            added = compute(batch, layout, layout.scatter(emitted), counts)
            each = len(next(iter(added.values())))
            rows = np.arange(len(counts)) if each == len(counts) else np.repeat(np.arange(len(counts)), counts)
            own = {n: batch.column(batch.schema.get_field_index(n)).take(pa.array(rows)) for n in names}
            columns = own | added
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
    return lines.mapInArrow(work, ", ".join([*own, schema]))


def _numbers(batch: pa.RecordBatch, counts: np.ndarray) -> np.ndarray:
    """The number in its line of each chunk of a batch of segments."""
    first = batch.column(batch.schema.get_field_index("_chunk")).to_numpy()
    return np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def scan(
    chunks: DataFrame, model: Model, limit: int = BROADCAST_LIMIT, segment: int = SEGMENT
) -> DataFrame:
    """``(_seq, _chunk, keys, log_likelihood, alpha, beta)`` of the chunks of ``cut_lines``.

    ``alpha`` and ``beta`` hold K numbers for each position of the chunk: the filtered state
    probabilities and the backward values, which are scaled to sum to one. The logarithms
    of all chunks of a line add up to its log-likelihood. A position after which the line
    is impossible has zeros.
    """
    a, pi, k = model.a, model.pi, model.states

    def products(batch, layout, e, counts):
        rows, logs = kernel.chunk_products(layout, e, a, _numbers(batch, counts) == 0)
        rows, logs = kernel.composed_runs(kernel.Layout(counts), rows, logs)
        n = len(rows)
        return {
            "rows": kernel.list_column(np.full(n, k * k), rows.ravel()),
            "logs": kernel.list_column(np.full(n, k), logs.ravel()),
        }

    def passes(batch, layout, e, counts):
        numbers = _numbers(batch, counts)
        first = numbers == 0
        if "left" in batch.schema.names:
            ends = [kernel.list_parts(batch, n)[1].reshape(-1, k) for n in ("left", "right")]
        else:
            ends = [np.tile(pi, (len(counts), 1)), np.full((len(counts), k), 1.0 / k)]
        rows, logs = kernel.chunk_products(layout, e, a, first)
        left, right = kernel.entered_runs(kernel.Layout(counts), rows, logs, *ends)
        prior = np.where(first[:, None], left, left @ a)
        alpha, beta, scale = kernel.chunk_passes(layout, e, a, prior, right)
        size = layout.lengths * k
        return {
            "_chunk": pa.array(numbers),
            "log_likelihood": pa.array(kernel.log_likelihood(layout, scale)),
            "alpha": kernel.list_column(size, layout.gather(alpha).ravel()),
            "beta": kernel.list_column(size, layout.gather(beta).ravel()),
        }

    schema = "log_likelihood double, alpha array<double>, beta array<double>"
    segments = _segments(chunks, segment)
    several = materialise(segments.filter("_chunk > 0").select("_seq").distinct(), "cut")
    if several.isEmpty():
        return _batched(segments, model, limit, passes, schema)
    if several.count() <= FEW_CUT:
        several = F.broadcast(several)
    whole = segments.join(several, "_seq", "left_anti")
    parts = materialise(segments.join(several, "_seq", "left_semi"), "parts")
    slim = parts.select("_seq", "_chunk", "sizes", "ids")
    made = _batched(slim, model, limit, products, "rows array<double>, logs array<double>")
    vectors = _vectors(materialise(made, "products"), pi)
    joined = _batched(parts.join(vectors, ["_seq", "_chunk"]), model, limit, passes, schema)
    return _batched(whole, model, limit, passes, schema).unionByName(joined)


def _keys(df: DataFrame) -> list[str]:
    inner = ("_seq", "_chunk", "ids", "left", "right", "log_likelihood", "alpha", "beta")
    return [c for c in df.columns if c not in inner]


def forward(scanned: DataFrame, states: int) -> DataFrame:
    """``(keys, tokens, log_likelihood, alpha)`` as ``hmm.forward``, of the result of ``scan``."""
    keys = _keys(scanned)
    tokens = (F.size("alpha") / states).cast("bigint")
    last = F.max_by(F.slice("alpha", F.size("alpha") - states + 1, states), "_chunk")
    return (
        scanned.groupBy("_seq", *keys)
        .agg(
            F.sum(tokens).alias("tokens"),
            F.sum("log_likelihood").alias("log_likelihood"),
            last.alias("alpha"),
        )
        .drop("_seq")
    )


def backward(scanned: DataFrame, states: int) -> DataFrame:
    """``(keys, beta)`` at the first position as ``hmm.backward``."""
    return scanned.filter("_chunk = 0").select(*_keys(scanned), F.slice("beta", 1, states).alias("beta"))


def positions(scanned: DataFrame, states: int, size: int = CHUNK) -> DataFrame:
    """``(keys, pos, alpha, beta, gamma)`` of every position; ``size`` is that of the cut."""
    keys = _keys(scanned)
    at = F.sequence(F.lit(0), (F.size("alpha") / states).cast("int") - 1)
    both = F.transform(
        at,
        lambda t: F.struct(
            F.slice("alpha", t * states + 1, states).alias("alpha"),
            F.slice("beta", t * states + 1, states).alias("beta"),
        ),
    )
    rows = scanned.select(*keys, "_chunk", F.posexplode(both).alias("_at", "_v"))
    product = F.zip_with("_v.alpha", "_v.beta", lambda x, y: x * y)
    total = F.aggregate("_product", F.lit(0.0), lambda s, x: s + x)
    gamma = F.transform("_product", lambda x: F.when(total > 0, x / total).otherwise(0.0))
    return rows.withColumn("_product", product).select(
        *keys,
        (F.col("_chunk") * size + F.col("_at")).alias("pos"),
        F.col("_v.alpha").alias("alpha"),
        F.col("_v.beta").alias("beta"),
        gamma.alias("gamma"),
    )
