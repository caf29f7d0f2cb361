"""Train/valid/test splits and samples, drawn by hashing keys."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.det import draw_bits, uniform
from corpusloom.operators.indexing import with_index
from corpusloom.operators.selection import cuts, mark_first, take_first


def split_rows(
    df: DataFrame,
    keys: list[str],
    valid_size: float = 0.1,
    test_size: float = 0.1,
    seed: int = 42,
) -> DataFrame:
    """Add ``split``: a narrow expression, no shuffle.

    Rows with equal ``keys`` stay in one split. Give the text id to keep all prompt forms
    of a text together, or the id and the variant to split row by row.
    """
    u = uniform(seed, *keys)
    return df.withColumn(
        "split",
        F.when(u < test_size, "test").when(u < test_size + valid_size, "valid").otherwise("train"),
    )


def split_rows_exact(
    df: DataFrame,
    keys: list[str],
    valid_size: float = 0.1,
    test_size: float = 0.1,
    seed: int = 42,
) -> DataFrame:
    """As ``split_rows`` with exact sizes, rounded up, over the distinct ``keys``.

    The draws at the two borders are found by counting, so each row is placed by its own
    draw without a sort or a join. Keys whose draws collide right at a border go by key.
    """
    test, valid = Fraction(str(test_size)), Fraction(str(valid_size))

    def ends(n: int) -> list[int]:
        n_test = math.ceil(n * test)
        return [n_test, n_test + math.ceil((n - n_test) * valid / (1 - test))]

    placed = df.withColumn("_draw", draw_bits(seed, *keys))
    drawn = placed.select(*keys, "_draw").distinct()
    borders = cuts(drawn, ends)
    for name, (end, cut) in zip(("_in_test", "_in_valid"), borders, strict=True):
        placed = mark_first(placed, drawn, keys, end, cut, name)
    split = F.when(F.col("_in_test"), "test").when(F.col("_in_valid"), "valid").otherwise("train")
    return placed.withColumn("split", split).drop("_draw", "_in_test", "_in_valid")


def split_select(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("split") == name)


def sample_fraction(df: DataFrame, keys: list[str], fraction: float, seed: int = 42) -> DataFrame:
    """A sample without replacement of about ``fraction`` of the rows."""
    return df.filter(uniform(seed, *keys) < fraction)


def sample_fraction_exact(
    df: DataFrame, keys: list[str], fraction: float, seed: int = 42
) -> DataFrame:
    """A sample without replacement of exactly ``round(fraction * rows)`` rows.

    The draw of the last row is found by counting; nothing is sorted.
    """
    placed = df.withColumn("_draw", draw_bits(seed, *keys))
    ((end, cut),) = cuts(placed, lambda n: [round(fraction * n)])
    return take_first(placed, end, cut).drop("_draw")


def pick_with_replacement(
    items: DataFrame, order: list[str], picks: DataFrame, pick_keys: list[str], seed: int = 42
) -> DataFrame:
    """For every row of ``picks`` one uniformly drawn row of ``items``.

    The draw is a position, so each pick is an equi-join on one number.
    """
    indexed = with_index(items, order, "_idx")
    n = indexed.count()
    drawn = picks.withColumn("_idx", F.floor(uniform(seed, *pick_keys) * float(n)))
    return drawn.join(indexed, "_idx").drop("_idx")
