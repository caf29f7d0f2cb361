"""The rows with the k smallest draws, found by counting instead of sorting."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.det import DRAW_BITS
from corpusloom.operators.indexing import with_index, with_number

#: Bits of a draw that are told apart in each counting pass; a pass returns at most 2^20
#: groups to the driver for each rank, whatever the number of rows.
PASSES = (16, 16, 20)


@dataclass(frozen=True)
class Cut:
    """The draw at a rank: ``below`` rows are smaller, ``equal`` rows have the same one."""

    draw: int
    below: int
    equal: int


def cuts(draws: DataFrame, ranks: Callable[[int], list[int]]) -> list[tuple[int, Cut | None]]:
    """The wanted ranks, from 0, each with the cut there; None beyond the last row.

    ``ranks`` gets the number of rows. Column ``_draw`` holds integers of ``DRAW_BITS``
    bits. Each pass counts rows by the next bits of the draw, only in the ranges that hold
    a wanted rank: a partial aggregation, and after the first pass a filter that leaves
    one part in 65,536.
    """
    prefixes, left = None, DRAW_BITS
    for bits in PASSES:
        here = draws
        if prefixes is not None:
            wanted = sorted({p for p in prefixes if p is not None})
            here = draws.filter(F.shiftright("_draw", left).isin(wanted))
        left -= bits
        counted = (
            here.groupBy(F.shiftright("_draw", left).alias("prefix"))
            .agg(F.count("*").alias("n"))
            .toArrow()
            .sort_by("prefix")
        )
        found = list(zip(*(c.to_pylist() for c in counted.columns), strict=True))
        if prefixes is None:
            size = sum(n for _, n in found)
            places = ranks(size)
            prefixes = [0 if 0 <= rank < size else None for rank in places]
            below, equal = [0] * len(places), [0] * len(places)
        for i, rank in enumerate(places):
            if prefixes[i] is None:
                continue
            outer = prefixes[i]
            for prefix, n in found:
                if prefix >> bits != outer:
                    continue
                if below[i] + n > rank:
                    prefixes[i], equal[i] = prefix, n
                    break
                below[i] += n
    return [
        (rank, None if p is None else Cut(p, b, e))
        for rank, p, b, e in zip(places, prefixes, below, equal, strict=True)
    ]


def mark_first(
    df: DataFrame, drawn: DataFrame, keys: list[str], end: int, cut: Cut | None, name: str
) -> DataFrame:
    """Add ``name``: whether a row's key is among the first ``end`` of ``drawn``.

    ``drawn`` has each key once, in order of ``_draw`` and then of the keys; ``df`` has
    ``_draw`` too. Only if equal draws lie across the border are their keys numbered and
    joined.
    """
    if cut is None:
        return df.withColumn(name, F.lit(True))
    before = F.col("_draw") < cut.draw
    if cut.below == end:
        return df.withColumn(name, before)
    tied = with_index(drawn.filter(F.col("_draw") == cut.draw), keys, "_idx")
    first = tied.filter(F.col("_idx") < end - cut.below).select(
        *[F.col(k).alias(f"_tied_{k}") for k in keys], F.lit(True).alias("_tied")
    )
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_tied_{k}"))
    return (
        df.join(first, same, "left")
        .withColumn(name, before | F.coalesce("_tied", F.lit(False)))
        .drop("_tied", *[f"_tied_{k}" for k in keys])
    )


def take_first(df: DataFrame, end: int, cut: Cut | None) -> DataFrame:
    """Exactly ``end`` rows of the smallest ``_draw``, or all where there are fewer.

    Of rows with the same draw as the last one, those stored first are taken; they are
    the only ones that are written and numbered.
    """
    if cut is None:
        return df
    taken = df.filter(F.col("_draw") < cut.draw)
    if cut.below == end:
        return taken
    tied = with_number(df.filter(F.col("_draw") == cut.draw), "_number")
    return taken.unionByName(tied.filter(F.col("_number") < end - cut.below).drop("_number"))
