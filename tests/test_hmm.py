import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import hmm

A = np.array([[0.1, 0.9], [0.5, 0.5]])
B = np.array([[0.7, 0.3], [0.4, 0.6]])
PI = np.array([0.6, 0.4])


def make_model(spark, a=A, b=B, pi=PI):
    k, v = b.shape
    vocab = spark.createDataFrame([(f"t{i}", i) for i in range(v)], "token string, token_id bigint")
    rows = [(i, *map(float, b[:, i])) for i in range(v)]
    table = spark.createDataFrame(rows, "token_id bigint, " + ", ".join(f"p{s} double" for s in range(k)))
    return hmm.Model(np.asarray(pi), np.asarray(a), table, vocab, v)


def make_lines(spark, *lines):
    return spark.createDataFrame(list(enumerate(map(list, lines))), "id bigint, ids array<bigint>")


def b_of(model):
    rows = sorted(map(tuple, model.b.collect()))
    return np.array([r[1:] for r in rows]).T


@pytest.fixture(params=[hmm.BROADCAST_LIMIT, 0], ids=["broadcast", "joined"])
def limit(request):
    return request.param


def enumerate_paths(line, a, b, pi):
    """Probability of every state path, where an unseen token (-1) has none."""
    for path in itertools.product(range(len(pi)), repeat=len(line)):
        p = pi[path[0]]
        for t, (s, tok) in enumerate(zip(path, line)):
            p *= (b[s][tok] if tok >= 0 else 0.0) * (a[path[t - 1]][s] if t else 1.0)
        yield path, p


def test_fixture_likelihood_and_gamma(spark, limit):
    model, lines = make_model(spark), make_lines(spark, (0, 0, 1), (1, 0))
    ll = {r["id"]: r for r in hmm.forward(lines, model, limit).collect()}
    assert ll[0]["log_likelihood"] == pytest.approx(-2.031658, abs=1e-6)
    assert ll[1]["log_likelihood"] == pytest.approx(-1.563509, abs=1e-6)
    assert ll[0]["tokens"] == 3
    got = {(r["id"], r["pos"]): r["gamma"][0] for r in hmm.posterior(lines, model, limit).collect()}
    want = [0.646730, 0.371253, 0.229122]
    assert [got[0, t] for t in range(3)] == pytest.approx(want, abs=1e-6)
    assert [got[1, t] for t in range(2)] == pytest.approx([0.369628, 0.461318], abs=1e-6)


def test_fixture_em_step(spark, limit):
    model, _ = hmm.em_step(make_lines(spark, (0, 0, 1), (1, 0)), make_model(spark), limit)
    assert model.pi == pytest.approx([0.508179, 0.491821], abs=1e-6)
    assert model.a.ravel() == pytest.approx([0.149552, 0.850448, 0.529756, 0.470244], abs=1e-6)
    assert b_of(model).ravel() == pytest.approx([0.711870, 0.288130, 0.520440, 0.479560], abs=1e-6)


def test_fixture_viterbi(spark, limit):
    model, lines = make_model(spark), make_lines(spark, (0, 0, 1))
    got = hmm.viterbi(lines, model, limit=limit).first()
    assert got["path"] == [0, 1, 1] and np.exp(got["score"]) == pytest.approx(0.04536)
    got = hmm.viterbi(lines, model, compat=True, limit=limit).first()
    assert got["path"] == [1, 0, 1] and np.exp(got["score"]) == pytest.approx(0.03024)


def test_against_path_enumeration(spark, limit):
    rng = np.random.default_rng(7)
    k, v = 2, 4
    a, b, pi = rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(v), k), rng.dirichlet(np.ones(k))
    lines = [tuple(rng.integers(0, v, n)) for n in (1, 2, 3, 6, 6, 5, 4, 1)] + [(1, -1, 2)]
    lines = [tuple(int(x) for x in line) for line in lines]
    model, df = make_model(spark, a, b, pi), make_lines(spark, *lines)
    ll = {r["id"]: r["log_likelihood"] for r in hmm.forward(df, model, limit).collect()}
    gamma = {(r["id"], r["pos"]): r["gamma"] for r in hmm.posterior(df, model, limit).collect()}
    best = {r["id"]: r for r in hmm.viterbi(df, model, limit=limit).collect()}
    moves = np.zeros((k, k))
    for i, line in enumerate(lines):
        paths = list(enumerate_paths(line, a, b, pi))
        total = sum(p for _, p in paths)
        if total == 0:
            assert ll[i] == -np.inf
            assert all(gamma[i, t] == [0.0] * k for t in range(len(line)))
            assert best[i]["path"][-1] == 0
            continue
        assert ll[i] == pytest.approx(np.log(total))
        for t in range(len(line)):
            want = [sum(p for path, p in paths if path[t] == s) / total for s in range(k)]
            assert gamma[i, t] == pytest.approx(want)
        for path, p in paths:
            for s, n in zip(path, path[1:]):
                moves[s, n] += p / total
        top_path, top = max(paths, key=lambda x: x[1])
        assert tuple(best[i]["path"]) == top_path
        assert best[i]["score"] == pytest.approx(np.log(top))
    got = {(r["i"], r["j"]): r["expected"] for r in hmm.transitions(df, model, limit).collect()}
    assert [got[i, j] for i in range(k) for j in range(k)] == pytest.approx(moves.ravel())


def test_long_lines_do_not_underflow(spark):
    rng = np.random.default_rng(1)
    a, b = rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(50), 3)
    model = make_model(spark, a, b, np.ones(3) / 3)
    lines = make_lines(spark, tuple(int(x) for x in rng.integers(0, 50, 3000)), (1, 2))
    sums = hmm.posterior(lines, model).select(F.aggregate("gamma", F.lit(0.0), lambda x, y: x + y).alias("s"))
    assert [r["s"] for r in sums.collect()] == pytest.approx([1.0] * 3002)


def test_batches_cut_between_lines(spark, monkeypatch):
    model = make_model(spark)
    lines = make_lines(spark, *[(0, 1) * (i % 5 + 1) for i in range(40)]).coalesce(1)
    whole = hmm.em_step(lines, model)[0]
    monkeypatch.setattr(hmm, "BATCH_TOKENS", 7)
    cut = hmm.em_step(lines, model)[0]
    assert cut.a == pytest.approx(whole.a) and b_of(cut) == pytest.approx(b_of(whole))


def text_lines(spark):
    data = ["The cat sat.", "the dog sat", "a cat ran!", "the dog ran", "...", "  a dog sat "] * 3
    return spark.createDataFrame(list(enumerate(data)), "id bigint, line string")


def test_train_never_loses_likelihood_and_partitioning_does_not_matter(spark):
    lines = hmm.training_lines(text_lines(spark))
    assert lines.count() == 15
    runs = []
    for n in (1, 8):
        model, history = hmm.train(lines.repartition(n), ["id"], states=3, max_iterations=6)
        assert all(b >= a - 1e-9 for a, b in zip(history, history[1:]))
        assert model.a.sum(axis=1) == pytest.approx([1.0] * 3)
        assert b_of(model).sum(axis=1) == pytest.approx([1.0] * 3)
        runs.append((model.a, b_of(model)))
    assert runs[0][0] == pytest.approx(runs[1][0]) and runs[0][1] == pytest.approx(runs[1][1])


def test_converges_and_stops(spark):
    lines = make_lines(spark, (0,), (0,))
    model = make_model(spark, b=np.array([[1.0, 0.0], [1.0, 0.0]]))
    once, _ = hmm.em_step(lines, model)
    assert hmm.converged(once, hmm.em_step(lines, once)[0])
    assert not hmm.converged(make_model(spark), once)


def test_states_never_used_keep_their_rows(spark):
    model = make_model(spark, pi=np.array([1.0, 0.0]), a=np.eye(2))
    new, _ = hmm.em_step(make_lines(spark, (0, 1), (1, 0)), model)
    assert new.a == pytest.approx(np.eye(2))
    assert b_of(new)[1] == pytest.approx(B[1])


def test_init_is_normalised(spark):
    vocab = spark.createDataFrame([("x", 0), ("y", 1), ("z", 2)], "token string, token_id bigint")
    model = hmm.init_model(vocab, 4)
    assert model.a.sum(axis=1) == pytest.approx([1.0] * 4) and model.pi.sum() == pytest.approx(1.0)
    assert b_of(model).sum(axis=1) == pytest.approx([1.0] * 4)
    assert hmm.init_model(vocab, 4, a=np.eye(4)).a == pytest.approx(np.eye(4))


def test_generate_follows_the_model(spark):
    model = make_model(spark)
    got = hmm.generate(spark.range(4000), ["id"], model, 3)
    assert got.count() == 12000
    assert got.filter("pos = 0 and state = 0").count() / 4000 == pytest.approx(PI[0], abs=0.03)
    by = {(r["state"], r["token"]): r["count"] for r in got.groupBy("state", "token").count().collect()}
    assert by[0, "t0"] / (by[0, "t0"] + by[0, "t1"]) == pytest.approx(0.7, abs=0.03)
    pairs = got.alias("x").join(got.alias("y"), F.expr("x.id = y.id and x.pos + 1 = y.pos and x.state = 0"))
    assert pairs.filter("y.state = 1").count() / pairs.count() == pytest.approx(0.9, abs=0.03)
    with pytest.raises(ValueError):
        hmm.generate(spark.range(1), ["id"], model, 0)


def test_predict_moves_before_emitting(spark):
    model = make_model(spark, a=np.array([[0.0, 1.0], [1.0, 0.0]]))
    lines = make_lines(spark, (0,), (0, -1))
    got = hmm.predict(lines, model, 4).orderBy("id", "pos").collect()
    last = {r["id"]: r["path"][-1] for r in hmm.viterbi(lines, model).collect()}
    assert len(got) == 8
    for r in got:
        assert r["state"] == (last[r["id"]] + r["pos"] + 1) % 2
    with pytest.raises(ValueError):
        hmm.predict(lines, model, 0)


def test_normalize(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 0.0)], "k string, v double")
    got = sorted(map(tuple, hmm.normalize(df, ["k"], "v").collect()))
    assert got == [("a", 0.25), ("a", 0.75), ("b", 0.0)]


def test_save_and_load(spark, tmp_path):
    model = make_model(spark)
    hmm.save_model(model, str(tmp_path / "m"))
    back = hmm.load_model(spark, str(tmp_path / "m"))
    assert (back.a == model.a).all() and (back.pi == model.pi).all()
    assert (b_of(back) == B).all() and back.vocab_size == 2


def test_only_tokens_above_the_limit_are_joined(spark):
    line = "b a c a d e a f b"
    lines = spark.createDataFrame([(k, line[: 2 * k + 1]) for k in range(9)], "id long, line string")
    vocab = hmm.line_vocab(lines, ["id"])
    coded, model = hmm.encode_lines(lines, ["id"], vocab), hmm.init_model(vocab, 2)
    want = sorted(hmm.forward(coded, model).collect())
    half = model.vocab_size // 2 * model.states * 8
    assert sorted(hmm.forward(coded, model, half).collect()) == want
    joined = hmm._with_emissions(coded, model, half)[0].select(F.explode("tokens").alias("t"))
    assert 0 < joined.agg(F.min("t")).first()[0] == model.vocab_size // 2
