import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import hmm, hmm_kernel, hmm_scan


def make_model(spark, k=3, v=5, seed=0, b=None):
    rng = np.random.default_rng(seed)
    b = rng.dirichlet(np.ones(v), k) if b is None else np.asarray(b)
    vocab = spark.createDataFrame([(str(i), i) for i in range(b.shape[1])], "token string, token_id bigint")
    schema = ", ".join(["token_id bigint", *(f"p{s} double" for s in range(len(b)))])
    rows = [(i, *map(float, b[:, i])) for i in range(b.shape[1])]
    a, pi = rng.dirichlet(np.ones(len(b)), len(b)), rng.dirichlet(np.ones(len(b)))
    return hmm.Model(pi, a, spark.createDataFrame(rows, schema), vocab, b.shape[1])


def by_key(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def close(left, right):
    for x, y in zip(left, right, strict=True):
        if isinstance(x, list | tuple):
            close(x, y)
        else:
            assert x == y if not isinstance(x, float) else x == pytest.approx(y, rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("limit", [hmm.BROADCAST_LIMIT, 0])
@pytest.mark.parametrize("size", [1, 3, 8])
def test_equals_whole_lines(spark, monkeypatch, limit, size):
    monkeypatch.setattr(hmm_scan, "FAN", 2)
    rng = np.random.default_rng(size)
    model = make_model(spark)
    rows = [(i % 4 if i % 5 else None, [int(x) for x in rng.integers(0, 5, n)]) for i, n in
            enumerate([1, 2, 3, 7, 8, 9, 20, 24, 40, 1, 16, 5, 0])]
    lines = spark.createDataFrame(rows, "id int, ids array<bigint>").repartition(3)
    scanned = hmm_scan.scan(hmm_scan.cut_lines(lines, size), model, limit)
    close(by_key(hmm_scan.forward(scanned, 3)), by_key(hmm.forward(lines, model, limit)))
    close(by_key(hmm_scan.backward(scanned, 3)), by_key(hmm.backward(lines, model, limit)))
    gamma = hmm_scan.positions(scanned, 3, size).select("id", "pos", "gamma")
    whole = hmm.posterior(lines, model, limit).withColumn("pos", F.col("pos").cast("bigint"))
    close(by_key(gamma), by_key(whole))


@pytest.mark.parametrize("segment", [1, 5, hmm_scan.SEGMENT])
def test_matrices_of_a_line_in_one_segment_are_not_written(spark, monkeypatch, segment):
    """they took most of the disk. Lines of several segments give the same values."""
    written = {}

    def write(df, label):
        table = materialise(df, label)
        written[label] = written.get(label, 0) + table.count()
        return table

    materialise = hmm_scan.materialise
    monkeypatch.setattr(hmm_scan, "materialise", write)
    model = make_model(spark)
    rows = [(i, [(i * j) % 5 for j in range(n)]) for i, n in enumerate([1, 2, 7, 19, 30])]
    lines = spark.createDataFrame(rows, "id int, ids array<bigint>").coalesce(1)
    scanned = hmm_scan.scan(hmm_scan.cut_lines(lines, 2), model, segment=segment)
    gamma = hmm_scan.positions(scanned, 3, 2).select("id", "pos", "gamma")
    whole = hmm.posterior(lines, model).withColumn("pos", F.col("pos").cast("bigint"))
    close(by_key(gamma), by_key(whole))
    assert written["chunks"] == 31
    assert ("products" in written) == (segment < hmm_scan.SEGMENT)


def test_impossible_and_unseen_tokens(spark):
    model = make_model(spark, b=[[1.0, 0.0, 0.0], [0.5, 0.5, 0.0]])
    rows = [(1, [0, 1, 0, 0, 1]), (2, [0, 2, 0, 1]), (3, [2]), (4, [0, 0, -1])]
    lines = spark.createDataFrame(rows, "id int, ids array<bigint>")
    scanned = hmm_scan.scan(hmm_scan.cut_lines(lines, 2), model)
    got = {r.id: r for r in hmm_scan.forward(scanned, 2).collect()}
    want = {r.id: r for r in hmm.forward(lines, model).collect()}
    for name in (1, 2, 3, 4):
        assert got[name].log_likelihood == pytest.approx(want[name].log_likelihood)
        assert got[name].alpha == pytest.approx(want[name].alpha)
    gamma = {(r.id, r.pos): r.gamma for r in hmm_scan.positions(scanned, 2, 2).collect()}
    assert all(gamma[2, t] == [0.0, 0.0] for t in range(4))
    assert sum(gamma[1, 3]) == pytest.approx(1)


def test_empty_table(spark):
    lines = spark.createDataFrame([], "id int, ids array<bigint>")
    scanned = hmm_scan.scan(hmm_scan.cut_lines(lines), make_model(spark))
    assert hmm_scan.forward(scanned, 3).collect() == []


def test_a_line_of_a_million_tokens(spark):
    """Rows of single tokens: the line is never put together, and equals the kernel's."""
    n, k, v = 1_000_000, 3, 5
    model = make_model(spark, k, v, 7)
    token = F.pmod(F.xxhash64("id"), F.lit(v))
    rows = spark.range(n).select(F.lit("x").alias("name"), F.col("id").alias("pos"), token.alias("token_id"))
    chunks = hmm_scan.cut_tokens(rows, ["name"])
    assert chunks.agg(F.max(F.size("ids")), F.count("*")).first() == (hmm_scan.CHUNK, -(-n // hmm_scan.CHUNK))
    scanned = hmm_scan.scan(chunks, model)
    got = hmm_scan.forward(scanned, k).first()

    ids = np.array([r.token_id for r in rows.orderBy("pos").select("token_id").toLocalIterator()])
    b = np.zeros((v, k))
    for r in model.b.collect():
        b[r.token_id] = r[1:]
    layout = hmm_kernel.Layout(np.array([n]))
    alpha, scale = hmm_kernel.forward(layout, b[ids], model.a, model.pi)
    assert got.tokens == n
    assert got.log_likelihood == pytest.approx(np.log(scale).sum(), rel=1e-12)
    assert got.alpha == pytest.approx(alpha[-1].tolist(), abs=1e-9)
    beta = hmm_kernel.backward(layout, b[ids], model.a, scale)
    first = hmm_scan.backward(scanned, k).first()
    assert first.beta == pytest.approx((beta[0] / beta[0].sum()).tolist(), abs=1e-9)
    gamma = hmm_kernel.posterior(alpha, beta)
    some = hmm_scan.positions(scanned, k).filter("pos % 99991 = 0").collect()
    assert len(some) == 11
    for r in some:
        assert r.gamma == pytest.approx(gamma[r.pos].tolist(), abs=1e-9)
