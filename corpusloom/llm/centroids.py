"""K-means on integer vectors, from a distance matrix that is kept and updated.

The components are integers, so every dot product of a vector with a centroid is exact and
can be carried on: a round changes a centroid in some of its components, and the kept
products change by those differences times the vector's components, nothing else. The
matrix (a row of products for each vector) is a written table beside the vectors; the
squared distance is |v|^2 - 2 v.c + |c|^2 and the nearest centroid the smallest of
|c|^2 - 2 v.c. A round is one narrow pass that updates and writes the products, and one
that sums the vectors of each cluster inside its task and sends one row per cluster and
task. Only the centroids themselves (a fixed number of rows) come to the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.store import drop_table, written

CLUSTERS = 16
ROUNDS = 3
SCALE = 64
WIDTH = 64
#: Components below this keep every product, squared distance and task's sum in a long.
LARGEST = 1 << 26


@dataclass
class Clustering:
    """``rows``: (key, cluster, distance) of every kept vector; ``centroids``: the final ones."""

    rows: DataFrame
    centroids: list[list[int]]

    def digests(self) -> list[str]:
        return [digest(c) for c in self.centroids]


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def kept_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
    width: int = WIDTH, scale: int = SCALE,
) -> DataFrame:
    """``(key, v)``: the rows with ``width`` finite components, each as floor(scale * x)."""
    x = F.col(vector)
    # A null beside a wrong size or a missing vector: the whole condition must be true.
    whole = F.size(x) == width
    finite = F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < math.inf)
    )
    scaled = F.transform(x, lambda e: F.floor(e.cast("double") * F.lit(float(scale))))
    return vectors.filter(whole & finite).select(F.col(key).alias("key"), scaled.alias("v"))


def _first_centroids(ints: DataFrame, clusters: int) -> list[list[int]]:
    """The vectors with the smallest hash of their key; equal keys go by components."""
    name = F.sha2(F.concat(F.lit("1:"), F.col("key").cast("string")), 256)
    chosen = ints.select(name.alias("name"), "v").orderBy(F.asc_nulls_last("name"), "v")
    return [list(r["v"]) for r in chosen.limit(clusters).collect()]


def _matrix(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    flat = batch.column(batch.schema.get_field_index(name)).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _lists(values: np.ndarray) -> pa.Array:
    at = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values.reshape(-1)))


def _nearest(products: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (the smaller one of a tie), and |c|^2 - 2 v.c of it."""
    from_each = (centroids * centroids).sum(axis=1) - 2 * products
    chosen = from_each.argmin(axis=1)
    return chosen, from_each[np.arange(len(chosen)), chosen]


def update_products(products: np.ndarray, v: np.ndarray, old: np.ndarray, new: np.ndarray) -> int:
    """Moves the products from the old centroids to the new ones; columns of v touched.

    Only the components in which a centroid has changed are looked at.
    """
    touched = 0
    for number, change in enumerate(new - old):
        at = np.flatnonzero(change)
        if len(at):
            products[:, number] += v[:, at] @ change[at]
            touched += len(at)
    return touched


def _start(ints: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(key, v, products)``: the only full products that are ever computed."""
    kind = ints.schema["key"].dataType.simpleString()
    width = centroids.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch, "v", width)
            if v.max() >= LARGEST or v.min() <= -LARGEST:
                raise OverflowError(f"components of {LARGEST} and more do not fit exact products")
            columns = [batch.column(0), _lists(v.astype(np.int32)), _lists(v @ centroids.T)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "v", "products"])

    return ints.mapInArrow(work, f"key {kind}, v array<int>, products array<bigint>")


def _moved(state: DataFrame, old: np.ndarray, new: np.ndarray) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            products = _matrix(batch, "products", len(old))
            update_products(products, _matrix(batch, "v", old.shape[1]), old, new)
            yield batch.set_column(2, "products", _lists(products))

    return state.mapInArrow(work, state.schema)


def _sums(state: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Count and exact component sums of each cluster that has vectors."""
    clusters, width = centroids.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((clusters, width + 1), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                chosen, _ = _nearest(_matrix(batch, "products", clusters), centroids)
                v = _matrix(batch, "v", width)
                for number in np.unique(chosen):
                    own = v[chosen == number]
                    total[number, 0] += len(own)
                    total[number, 1:] += own.sum(axis=0)
        full = np.flatnonzero(total[:, 0])
        if len(full):
            yield pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)), _lists(total[full])], ["cluster", "part"]
            )

    parts = state.mapInArrow(work, "cluster int, part array<bigint>")
    long = parts.select("cluster", F.posexplode("part").alias("place", "value"))
    summed = long.groupBy("cluster", "place").agg(
        F.sum(F.col("value").cast("decimal(20,0)")).alias("value")
    )
    found: dict[int, list[int]] = {}
    for row in summed.collect():  # clusters x (width + 1) rows
        found.setdefault(row["cluster"], [0] * (width + 1))[row["place"]] = int(row["value"])
    return {number: (own[0], own[1:]) for number, own in found.items()}


def _assigned(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    kind = state.schema["key"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch, "v", centroids.shape[1])
            chosen, rest = _nearest(_matrix(batch, "products", len(centroids)), centroids)
            distance = (v * v).sum(axis=1) + rest
            columns = [batch.column(0), pa.array(chosen.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "cluster", "distance"])

    return state.mapInArrow(work, f"key {kind}, cluster int, distance bigint")


def cluster(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    width: int = WIDTH,
    scale: int = SCALE,
) -> Clustering:
    """Clusters the vectors of exactly ``width`` components, none null, NaN or infinite.

    Other rows are left out. A component x counts as floor(scale * x), x as a double. The
    first centroids are the vectors with the smallest SHA-256 of ``1:<key>``; rows of equal
    keys go by their components and rows without a key come last. Each round assigns every
    vector to the nearest centroid (of equally near ones the smaller number) and moves each
    centroid that has vectors to the floor of their mean. A repeated row counts each time.
    Fewer vectors than ``clusters`` make fewer centroids; without any the result is empty.
    Integers of 2^26 and more raise an error, since distances would not fit a long. Other
    columns are not read.
    """
    spark = vectors.sparkSession
    ints = kept_vectors(vectors, key, vector, width, scale)
    centroids = np.array(_first_centroids(ints, clusters), dtype=np.int64).reshape(-1, width)
    if not len(centroids):
        rows = ints.select("key", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        return Clustering(rows.withColumnRenamed("key", key), [])
    state, path = written(_start(ints, centroids), "products")
    for _ in range(rounds):
        moved = centroids.copy()
        for number, (count, sums) in _sums(state, centroids).items():
            moved[number] = [s // count for s in sums]
        if (moved == centroids).all():
            break
        state, new_path = written(_moved(state, centroids, moved), "products")
        drop_table(spark, path)
        path, centroids = new_path, moved
    rows, _ = written(_assigned(state, centroids), "clusters")
    drop_table(spark, path)
    return Clustering(rows.withColumnRenamed("key", key), centroids.tolist())
