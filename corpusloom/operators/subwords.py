"""Subword ids by byte-pair merges of a given vocabulary, and back to text.

The vocabulary is a file of ``base64-token rank`` lines, whose path is a parameter; a pair
of neighbouring parts is merged if the two together are a token, lowest rank first. Marker
texts (a newline, the ends of a prompt) are tokens of their own and part the text around
them. Texts are cut into pieces by one expression in the JVM; a task merges each distinct
piece of a batch once and remembers what it merged, so nothing is shuffled: the vocabulary
is a fixed file and travels to the tasks.
"""

from __future__ import annotations

import base64
import heapq
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import tokens as tk
from corpusloom.functions.text import UNKNOWN
from corpusloom.operators import encoding as en

# What runs in the tasks travels with the job, so executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: White space as Unicode has it, and the patterns that part a text.
WHITE = r"\t-\r\x{85}\p{Z}"
BLANKS = r"\t\x0b-\r\x{85}\p{Z}"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
MARKERS = (tk.BOS, tk.PAD, tk.EOS, UNKNOWN, "\n")
#: Pieces that a task remembers; then it starts again.
REMEMBERED = 200_000


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """The tokens and ranks of a vocabulary file, a few ten thousand short lines."""
    rows = spark.read.text(path).collect()
    pairs = (row["value"].split() for row in rows if row["value"].strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece: the pair of lowest rank, the leftmost of equals, goes first.

    Parts are linked by where they end, and pairs wait in a heap, so a piece of any length
    costs about its length times its logarithm.
    """
    ends = list(range(1, len(piece) + 1))
    before = list(range(-1, len(piece) - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(at: int) -> None:
        if at >= 0 and ends[at] < len(piece):
            last = ends[ends[at]]
            rank = ranks.get(piece[at:last])
            if rank is not None:
                heapq.heappush(heap, (rank, at, last))

    for at in range(len(piece) - 1):
        offer(at)
    while heap:
        rank, at, last = heapq.heappop(heap)
        middle = ends[at]
        if not middle or middle >= len(piece) or ends[middle] != last:
            continue  # one of the two has been merged meanwhile
        ends[at], ends[middle] = last, 0
        if last < len(piece):
            before[last] = at
        offer(before[at])
        offer(at)
    out, at = [], 0
    while at < len(piece):
        out.append(ranks[piece[at : ends[at]]])
        at = ends[at]
    return out


@dataclass
class Subwords:
    """A vocabulary: token bytes to ids, and the ids of the markers after them."""

    ranks: dict[bytes, int]
    markers: dict[str, int] = field(default_factory=dict)

    @classmethod
    def load(cls, spark: SparkSession, path: str, markers: tuple[str, ...] = MARKERS) -> Subwords:
        """The file's vocabulary; the markers take the next free ids in their order."""
        ranks = read_ranks(spark, path)
        first = max(ranks.values(), default=-1) + 1
        return cls(ranks, {text: first + n for n, text in enumerate(markers)})

    def pieces(self, text: Column) -> Column:
        """A text as an array of markers and of pieces that no merge crosses.

        A word or a run of signs takes one blank before it; of a longer run of white space
        the last character stays for what follows, unless the text or a marker ends it.
        """
        marker = "|".join(re.escape(m) for m in sorted(self.markers, key=len, reverse=True)) or "(?!)"
        inside = rf"(?!{marker})"
        parts = [
            marker, CONTRACTIONS, r" ?\p{L}+", r" ?\p{N}+",
            rf" ?(?:{inside}[^{WHITE}\p{{L}}\p{{N}}])+",
            rf"(?:{inside}[{WHITE}])+(?!{inside}[^{WHITE}])", rf"(?:{inside}[{WHITE}])+",
        ]
        return F.regexp_extract_all(text, F.lit("|".join(parts)), F.lit(0))

    def encode(
        self, df: DataFrame, keys: list[str], columns: dict[str, str], limits: dict[str, int] | None = None
    ) -> DataFrame:
        """``keys`` and one id array for each text column; ``columns`` maps array to column.

        A null text has no ids. ``limits`` keeps the leading ids only.
        """
        limits = limits or {}
        split = {}
        for name, column in columns.items():
            found = self.pieces(F.col(column))
            # A piece has an id at least, so no more pieces than ids are needed.
            split[name] = F.slice(found, 1, limits[name]) if name in limits else found
        cut = df.select(*keys, *[c.alias(n) for n, c in split.items()])
        shared = df.sparkSession.sparkContext.broadcast((self.ranks, self.markers))
        names = list(columns)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ranks, markers = shared.value
            known: dict[str, np.ndarray] = {}

            def ids_of(piece: str) -> np.ndarray:
                ids = known.get(piece)
                if ids is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    own = [markers[piece]] if piece in markers else merged(piece.encode(), ranks)
                    ids = known[piece] = np.array(own, dtype=np.int64)
                return ids

            for batch in batches:
                done = [batch.column(k) for k in keys]
                for name in names:
                    column = batch.column(batch.schema.get_field_index(name))
                    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                    coded = column.flatten().dictionary_encode()
                    found = [ids_of(p) for p in coded.dictionary.to_pylist()]
                    done.append(_gathered(coded.indices.to_numpy(), lengths, found, limits.get(name)))
                yield pa.RecordBatch.from_arrays(done, keys + names)

        kinds = dict(cut.dtypes)
        schema = [f"`{k}` {kinds[k]}" for k in keys] + [f"`{n}` array<bigint>" for n in names]
        return cut.mapInArrow(run, ", ".join(schema))

    def decode(self, df: DataFrame, keys: list[str], ids: str = "ids", name: str = "text") -> DataFrame:
        """``keys`` and the text of each id array; bytes that are no text read U+FFFD.

        An id outside the vocabulary reads ``<unk>``; a null array is a null text.
        """
        table = {rank: token for token, rank in self.ranks.items()}
        table |= {number: text.encode() for text, number in self.markers.items()}
        shared = df.sparkSession.sparkContext.broadcast(table)
        unknown = UNKNOWN.encode()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in batches:
                column = batch.column(batch.schema.get_field_index(ids))
                texts = [
                    None if own is None else b"".join(known.get(i, unknown) for i in own).decode(errors="replace")
                    for own in column.to_pylist()
                ]
                kept = [batch.column(k) for k in keys]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], [*keys, name])

        kinds = dict(df.dtypes)
        schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), f"`{name}` string"])
        return df.select(*keys, ids).mapInArrow(run, schema)

    def encode_pairs(self, prompts: DataFrame, max_source: int = 42, max_target: int = 384) -> DataFrame:
        """``(id, variant, input_ids, attention_mask, labels)`` of prompt rows.

        Sources are cut and padded to ``max_source``; labels are cut only, for a batch to pad.
        """
        keys = ["id", "variant"]
        limits = {"source_ids": max_source, "target_ids": max_target}
        coded = self.encode(prompts, keys, {"source_ids": "source", "target_ids": "target"}, limits)
        ends = [self.markers[m] for m in (tk.BOS, tk.PAD, tk.EOS)]
        input_ids, mask = en.pad_truncate(F.col("source_ids"), max_source, *ends)
        begin, _, end = (F.array(F.lit(i).cast("bigint")) for i in ends)
        labels = F.concat(begin, F.slice("target_ids", 1, max_target - 2), end)
        return coded.select(
            *keys, input_ids.alias("input_ids"), mask.alias("attention_mask"), labels.alias("labels")
        )


def _gathered(
    codes: np.ndarray, lengths: np.ndarray, found: list[np.ndarray], limit: int | None
) -> pa.ListArray:
    """The ids of all texts, from those of each distinct piece."""
    size = np.array([len(ids) for ids in found], dtype=np.int64)
    flat = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    own = size[codes] if len(codes) else np.zeros(0, dtype=np.int64)
    after = np.concatenate([[0], np.cumsum(own)]).astype(np.int64)
    at = np.arange(after[-1]) - np.repeat(after[:-1] - begin[codes], own) if len(codes) else np.zeros(0, np.int64)
    ends = after[np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)]
    if limit is not None:
        within = np.arange(after[-1]) - np.repeat(ends[:-1], np.diff(ends))
        at, ends = at[within < limit], np.concatenate([[0], np.cumsum(np.minimum(np.diff(ends), limit))])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat[at]))
