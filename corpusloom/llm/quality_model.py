"""Quality of texts, learnt from preferences: a Bradley-Terry ranking of documents.

A document's strength is linear in measures of its text. Pairs of one labelled document of
either class are preferences for the better one; the logistic loss on the difference of
their measures gives the weights. A quantile of the strengths, at the labels' share of the
lower class, is the threshold. Every labelled row counts in all of them: Spark adds up what
each step of the fit needs, and only such sums reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.linear import sigmoid
from corpusloom.llm.store import bytes_of, size_on_disk, written
from corpusloom.llm.words import LOWER, VISIBLE, Words, blocks, mix, text_bytes
from corpusloom.operators.indexing import with_index, with_running_total

#: Preferences of each row of the larger class.
PARTNERS = 8

_SIGNS = np.zeros(256, dtype=bool)
_SIGNS[list(b"#*$%&|<>@^~=+_{}[]\\/")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_STOPS = np.zeros(256, dtype=bool)
_STOPS[list(b".,;:")] = True


def _per_text(flags: np.ndarray, begins: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[begins]).astype(np.float64)


def _repeats(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """How many entries of each row repeat an earlier one."""
    at = row.astype(np.uint64) << np.uint64(40) | value.astype(np.uint64) >> np.uint64(24)
    at.sort()
    again = np.flatnonzero(at[1:] == at[:-1])
    return np.bincount((at[again] >> np.uint64(40)).astype(np.int64), minlength=rows).astype(float)


MEASURES = [
    "signs", "signs_in_words", "capitals", "digits", "exclamations", "stops", "bars", "word_length",
    "same_as_before", "repeated_words", "repeated_runs", "repeated_lines", "line_words", "length",
    "many_signs", "many_capitals", "many_repeats",
]


def measures(column: pa.ChunkedArray) -> np.ndarray:
    """One row of ``MEASURES`` for each whole text; a text without words is all zeros."""
    data, begins = text_bytes(column)
    rows = len(begins) - 1
    words = Words(data, begins, VISIBLE, LOWER)
    n = words.counts.astype(np.float64)
    codes, distinct = words.codes()
    row = np.repeat(np.arange(rows), words.counts)
    size = np.maximum(_per_text(VISIBLE[data], begins), 1)
    some = np.maximum(n, 1)
    hashed = mix(codes.astype(np.uint64) + np.uint64(1))

    def runs(length: int) -> np.ndarray:
        value, end = hashed.copy(), max(len(hashed) - length + 1, 0)
        for k in range(1, length):
            value[:end] = mix(value[:end] * np.uint64(31) + hashed[k : k + end])
        inside = np.flatnonzero(row[:end] == row[length - 1 : length - 1 + end])
        return _repeats(row[inside], value[inside], rows)

    before = np.zeros(len(codes), dtype=bool)
    before[1:] = (codes[1:] == codes[:-1]) & (row[1:] == row[:-1])
    lined = np.ones(256, dtype=bool)
    lined[10] = False
    lines = Words(data, begins, lined)
    line, _ = lines.codes()
    line_row = np.repeat(np.arange(rows), lines.counts)
    n_lines = np.maximum(lines.counts, 1)
    signs = _per_text(_SIGNS[data], begins)
    capitals = _per_text(_UPPER[data], begins) / size
    repeated = runs(3) / some
    table = [
        signs / size,
        np.minimum(signs / some, 2),
        capitals,
        _per_text(_DIGIT[data], begins) / size,
        _per_text(data == 33, begins) / some,
        _per_text(_STOPS[data], begins) / some,
        _per_text(data == 124, begins) / some,
        np.minimum(size / some, 30) / 10,
        np.bincount(row[before], minlength=rows) / some,
        _repeats(row, hashed, rows) / some,
        repeated,
        _repeats(line_row, mix(line.astype(np.uint64) + np.uint64(1)), rows) / n_lines,
        np.log1p(n / n_lines) / 5,
        np.log1p(n) / 10,
        np.minimum(signs / size, 0.05) * 20,
        np.minimum(capitals, 0.3) * 3,
        np.minimum(repeated, 0.3) * 3,
    ]
    return np.stack(table, axis=1) * (n > 0)[:, None]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * (self.strength(x) - self.threshold))


def fit_preferences(better: np.ndarray, worse: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Weights for which ``better`` beats ``worse``, row by row, most likely (Newton steps)."""
    apart = better - worse
    return _newton(lambda w: _lost(apart, w), apart.shape[1], len(apart), penalty)


def _lost(apart: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sums of the loss's slope and, row by row, of its curvature at ``w``."""
    lost = sigmoid(-(apart @ w))
    bend = (apart * (lost * (1 - lost))[:, None]).T @ apart
    return np.concatenate([-(apart * lost[:, None]).sum(0), bend.ravel()])


def _newton(sums: Callable, width: int, rows: int, penalty: float = 1e-3) -> np.ndarray:
    w = np.zeros(width)
    for _ in range(30):
        found = sums(w) / rows
        slope, bend = found[:width] + penalty * w, found[width:].reshape(width, width)
        step = np.linalg.solve(bend + penalty * np.eye(width), slope)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(MEASURES))


def _summed(table: DataFrame, compute: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum of ``compute(x)``, ``size`` numbers, over all batches of the column ``x``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += compute(_matrix(pa.chunked_array([batch.column(0)])))
        yield pa.record_batch([pa.array(np.arange(size)), pa.array(total)], ["place", "value"])

    rows = table.select("x").mapInArrow(work, "place bigint, value double")
    found, out = rows.groupBy("place").agg(F.sum("value").alias("value")).toArrow(), np.zeros(size)
    out[found["place"].to_numpy()] = found["value"].to_numpy()
    return out


def _measured(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """``(key, label, x)`` of every labelled document.

    Repeated labels of a key count once (the larger), null ones not at all. Within Spark's
    broadcast threshold the labels go to the texts; beyond it every text is measured and the
    measures are joined, so that no text is shuffled.
    """
    known = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max(label).cast("bigint").alias("_label"))
    )
    spark = docs.sparkSession
    known, path = written(known, "labels")
    small = size_on_disk(spark, path) <= bytes_of(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    texts = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    none = F.lit(None).cast("bigint").alias("label")
    if small:
        texts = texts.join(F.broadcast(known), F.col("key") == F.col("_key"))
        texts = texts.select("key", F.col("_label").alias("label"), "text")
    else:
        texts = texts.select("key", none, "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, "text"):
            x = pa.array(list(measures(table["text"])), type=pa.list_(pa.float64()))
            kept = [table[c].combine_chunks() for c in ("key", "label")]
            yield pa.record_batch([*kept, x], ["key", "label", "x"])

    kind = texts.schema["key"].dataType.simpleString()
    found = texts.mapInArrow(work, f"key {kind}, label bigint, x array<double>")
    if not small:
        found = found.drop("label").join(known, F.col("key") == F.col("_key"))
        found = found.select("key", F.col("_label").alias("label"), "x")
    return written(found, "measures")[0]


def _preferences(rows: DataFrame, good: int, bad: int) -> DataFrame:
    """``x``, better minus worse: ``PARTNERS`` rows of the smaller class for each of the larger.

    ``rows`` have ``idx``, the worse ones first. Partners follow from the row's number.
    """
    many = 1 if good >= bad else 0
    many_rows = rows.filter(F.col("label") == many)
    at = F.pmod(F.xxhash64("idx", "turn"), F.lit(min(good, bad))) + (0 if many else bad)
    turns = F.explode(F.sequence(F.lit(0), F.lit(PARTNERS - 1))).alias("turn")
    asked = many_rows.select("idx", "x", turns).select(F.col("x").alias("mine"), at.alias("idx"))
    pairs = asked.join(rows.filter(F.col("label") != many).select("idx", "x"), "idx")
    better, worse = ("mine", "x") if many else ("x", "mine")
    return pairs.select(F.zip_with(better, worse, lambda p, q: p - q).alias("x"))


def _threshold(rows: DataFrame, share: float, good: int, bad: int) -> float:
    """The quantile of ``strength`` below which the labels' share of the lower class is.

    Between the two strengths around it, halfway, so that none of them sits on it.
    """
    numbered = rows.withColumnRenamed("idx", "number")
    placed = with_running_total(numbered, ["strength", "label", "number"], "label")
    goods = F.col("before") + F.col("label")
    below = goods * (share / good) + (F.col("idx") + 1 - goods) * ((1 - share) / bad)
    last = good + bad - 1
    cut = placed.filter(below >= 1 - share - 1e-9).agg(F.min("idx")).first()[0]
    cut = last if cut is None else cut
    asked = [min(cut, last), min(cut + 1, last)]
    found = {r["idx"]: r["strength"] for r in placed.filter(F.col("idx").isin(asked)).collect()}
    return float(np.mean([found[i] for i in asked]))


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> Model:
    """Fits the ranking on all labelled rows of ``labels``.

    Give only the rows that may be learnt from. Without rows of both classes every text
    scores alike, on the side of the class there is (the better one without any label).
    """
    measured, width = _measured(docs, labels, key, text, label), len(MEASURES)
    counts = {r["label"]: r["count"] for r in measured.groupBy("label").count().collect()}
    good, bad = counts.get(1, 0), counts.get(0, 0)
    if not good or not bad:
        zero = np.zeros(width)
        side = -1.0 if good or not bad else 1.0
        return Model(zero, zero + 1, zero, side, 1.0)
    share = labels.agg(F.avg(F.col(label).cast("double"))).first()[0]
    n = good + bad
    mean = _summed(measured, lambda x: x.sum(0), width) / n
    spread = _summed(measured, lambda x: ((x - mean) ** 2).sum(0), width) / n
    scale = np.maximum(np.sqrt(spread), 1e-6)
    rows = with_index(measured, ["label", F.xxhash64("key"), "key", "x"])
    apart, _ = written(_preferences(rows, good, bad), "preferences")
    pairs = PARTNERS * max(good, bad)
    weights = _newton(
        lambda w: _summed(apart, lambda d: _lost(d / scale, w), width * (width + 1)), width, pairs
    )

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(pa.chunked_array([batch.column(2)]))
            strength = pa.array((x - mean) / scale @ weights)
            yield pa.record_batch([batch.column(0), batch.column(1), strength], ["idx", "label", "strength"])

    schema = "idx bigint, label bigint, strength double"
    rows, _ = written(rows.select("idx", "label", "x").mapInArrow(judged, schema), "strengths")
    threshold = _threshold(rows, share, good, bad)
    slope = 1.0
    weight = F.when(F.col("label") == 1, share / good).otherwise((1 - share) / bad)
    over = F.col("strength") - threshold
    for _ in range(50):
        p = 1 / (1 + F.exp(over * -slope))
        sums = rows.agg(
            F.sum(weight * (p - F.col("label")) * over), F.sum(weight * p * (1 - p) * over * over)
        ).first()
        step = np.clip((sums[0] + 1e-4 * slope) / (sums[1] + 1e-4), -1, 1)
        slope = float(np.clip(slope - step, 0.05, 50))
        if abs(step) < 1e-9:
            break
    return Model(mean, scale, weights, threshold, slope)


def score(docs: DataFrame, model: Model, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with a score between 0 and 1 of each whole text; 0.5 is the threshold.

    Null, empty and blank texts are scored too, by measures of zero. A column of that name
    is replaced; all others, nulls and repeated rows pass through.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    state = docs.drop(column).withColumn(column, F.lit(None).cast("double"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, text):
            field = table.schema.field(column)
            made = pa.array(sent.value.score(measures(table[text])), type=field.type)
            table = table.set_column(table.schema.get_field_index(column), field, made)
            yield from table.to_batches()

    return state.mapInArrow(work, state.schema)
