"""Dense positions and running totals over a total order, without a one-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.session import materialise


def _sorted_table(df: DataFrame, order: list) -> DataFrame:
    """Range-partition and sort once, then write with partition number and row number.

    ``monotonically_increasing_id`` is (partition << 33) + row, and the range partitions
    are in order, so both numbers come without another shuffle. The range split uses the
    whole order, so a hot leading value spreads over several partitions. Writing fixes
    the partition numbers before anything is derived from them. AQE may merge small
    neighbouring ranges, which keeps their order.
    """
    return _placed_table(df.repartitionByRange(*order).sortWithinPartitions(*order), "sorted")


def _placed_table(df: DataFrame, label: str) -> DataFrame:
    return (
        materialise(df.withColumn("_at", F.monotonically_increasing_id()), label)
        .withColumn("_part", F.shiftright("_at", 33))
        .withColumn("_row", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    )


def _with_offsets(table: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Add for each sum its value over all earlier partitions.

    The sums make a table of one row per partition, which is joined back by ``_part``.
    """
    per_part = table.groupBy("_part").agg(*[c.alias(n) for n, c in sums.items()])
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = per_part.select(
        "_part", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in sums]
    )
    return table.join(before, "_part")


def with_index(df: DataFrame, order: list, name: str = "idx") -> DataFrame:
    """Add the dense 0-based position of each row in ``order`` (a total order)."""
    table = _sorted_table(df, order)
    placed = _with_offsets(table, {"_rows": F.count("*")})
    index = F.col("_rows") + F.col("_row")
    return placed.withColumn(name, index).drop("_at", "_part", "_row", "_rows")


def with_number(df: DataFrame, name: str) -> DataFrame:
    """Number the rows from 0 as they are stored: no sort, and no shuffle of the rows."""
    placed = _with_offsets(_placed_table(df, "numbered"), {"_rows": F.count("*")})
    number = F.col("_rows") + F.col("_row")
    return placed.withColumn(name, number).drop("_at", "_part", "_row", "_rows")


def with_running_total(df: DataFrame, order: list, value: str, name: str = "before") -> DataFrame:
    """Add the sum of the integer column ``value`` over all earlier rows, and ``idx``.

    The window runs inside one sorted partition, never over the whole table. Sums of
    decimals stay exact far beyond a bigint.
    """
    table = _sorted_table(df, order)
    placed = _with_offsets(table, {"_rows": F.count("*"), "_total": F.sum(value)})
    here = W.partitionBy("_part").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    return (
        placed.withColumn("idx", F.col("_rows") + F.col("_row"))
        .withColumn(name, F.col("_total") + F.coalesce(F.sum(value).over(here), F.lit(0)))
        .drop("_at", "_part", "_row", "_rows", "_total")
    )
