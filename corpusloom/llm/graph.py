"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.store import drop_table, written


def _low(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("low"))


def _large(edges: DataFrame) -> DataFrame:
    """Hangs every larger neighbour of a node on the smallest node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _low(both).select("a", F.least("a", "low").alias("low"))
    return (
        both.filter("b > a")
        .join(low, "a")
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def _small(edges: DataFrame) -> DataFrame:
    """Hangs a node and its smaller neighbours on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = _low(down)
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    own = low.select("a", F.col("low").alias("b"))
    return moved.union(own).filter("a <> b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node with an edge; component: its smallest node.

    ``edges`` has two bigint columns ``a`` and ``b``; loops, repeats and either direction
    are fine and edges with a null end are left out. Large-star and small-star rounds
    alternate until nothing moves: each is one partial aggregate and one join on a node,
    so a node with very many edges is reduced inside the map tasks and split by AQE in
    the join. Every round is a written table; the one before it is removed.
    """
    table, path = written(edges.filter("a <> b").select("a", "b"), "edges")
    seen = None
    for _ in range(max_rounds):
        following, new_path = written(_small(_large(table)), "stars")
        drop_table(table.sparkSession, path)
        table, path = following, new_path
        now = table.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == seen:
            return table.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                table.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
