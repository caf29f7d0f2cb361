"""Uniform numbers computed from the data itself."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Bits of md5 that make a draw.
DRAW_BITS = 52


def draw_bits(seed: int, *keys) -> Column:
    """The draw behind ``uniform`` as an integer, in the same order."""
    columns = [_escaped(F.col(k) if isinstance(k, str) else k) for k in keys]
    text = F.concat_ws("|", F.lit(str(seed)), *columns)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint")


def uniform(seed: int, *keys) -> Column:
    """A number in (0, 1) that depends only on ``seed`` and ``keys``.

    52 bits of md5, so a recomputed task draws the same number and an independent SQL
    engine can reproduce it. Different keys never share their text: bars and backslashes
    inside one are escaped, and null has a text of its own.
    """
    return (draw_bits(seed, *keys).cast("double") + 0.5) / float(2**DRAW_BITS)


def _escaped(key: Column) -> Column:
    text = F.replace(key.cast("string"), F.lit("\\"), F.lit("\\\\"))
    return F.coalesce(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\\N"))


def uniform_value(seed: int, *keys) -> float:
    """The same number for plain Python values."""
    parts = ["\\N" if k is None else str(k).replace("\\", "\\\\").replace("|", "\\|") for k in keys]
    text = "|".join([str(seed), *parts])
    bits = int(hashlib.md5(text.encode()).hexdigest()[:13], 16)
    return (bits + 0.5) / 2**52
