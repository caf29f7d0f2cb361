import hashlib
import math

import numpy as np
import pytest

from corpusloom.llm import centroids

SCHEMA = "vec_id bigint, embedding array<float>, v string, key string, cluster string, products string"


def brute(rows, width, clusters=16, rounds=3, scale=64):
    """Every distance computed anew in each round, with Python's integers."""
    kept = []
    for name, vector, *_ in rows:
        if vector is None or len(vector) != width:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((name, tuple(math.floor(scale * float(np.float32(x))) for x in vector)))

    def rank(row):
        name = row[0]
        found = hashlib.sha256(f"1:{name}".encode()).hexdigest()
        return (name is None, found if name is not None else "", row[1])

    now = [v for _, v in sorted(kept, key=rank)[:clusters]]

    def assign():
        out = []
        for name, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in now]
            out.append((name, far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        chosen = assign()
        moved = list(now)
        for k in range(len(now)):
            own = [v for (_, v), (_, c, _) in zip(kept, chosen, strict=True) if c == k]
            if own:
                moved[k] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
        now = moved
    return assign(), [list(c) for c in now]


def check(spark, rows, width, **options):
    table = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)
    done = centroids.cluster(table.repartition(3), width=width, **options)
    expected, final = brute(rows, width, **options)
    assert done.centroids == final
    got = [tuple(r) for r in done.rows.collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    return got


def test_equals_distances_computed_anew(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(i % 5, 1.5, 8).astype(np.float32).tolist()) for i in range(400)]
    check(spark, rows, 8)
    check(spark, rows, 8, clusters=3, rounds=6)


def test_odd_rows_ties_and_repeats(spark):
    ok = [0.5, -0.25, 3.0]
    rows = [
        (1, ok), (1, ok), (1, [0.5, -0.25, 2.9]), (None, ok), (2, None), (3, []), (4, [1.0, None, 2.0]),
        (5, [1.0, float("nan"), 0.0]), (6, [float("inf"), 0.0, 0.0]), (7, [0.0] * 4), (8, [-0.001, 0.0, -1.0]),
        (9, [0.0, 0.0, 0.0]), (10, [2.0, 0.0, 0.0]), (11, [1.0, 0.0, 0.0]),
    ]
    got = check(spark, rows, 3)
    assert len(got) == 8
    # Two equal centroids: the smaller number takes the vectors, the other one stays as it is.
    check(spark, [(k, ok) for k in range(40)] + [(99, [9.0, 9.0, 9.0])], 3, clusters=4)


def test_empty_and_too_large(spark):
    table = spark.createDataFrame([(1, [1.0], *"xxxx")], SCHEMA)
    done = centroids.cluster(table)
    assert (done.rows.collect(), done.centroids, done.rows.columns) == ([], [], ["vec_id", "cluster", "distance"])
    assert centroids.cluster(table.limit(0), width=1).rows.collect() == []
    with pytest.raises(Exception, match="do not fit"):
        centroids.cluster(spark.createDataFrame([(1, [3e38], *"xxxx")], SCHEMA), width=1)


def test_products_follow_changed_components_only():
    rng = np.random.default_rng(1)
    v = rng.integers(-64, 64, (50, 8))
    old = rng.integers(-64, 64, (4, 8))
    new = old.copy()
    new[1, 3] += 5
    new[2, :2] -= 7
    products = v @ old.T
    assert centroids.update_products(products, v, old, new) == 3
    assert (products == v @ new.T).all()
