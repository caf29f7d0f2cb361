import itertools

import numpy as np
import pytest

from corpusloom import plans
from corpusloom.operators import hmm
from corpusloom.plans.tables import Tables


def brute_force(lines, a, b, pi, rounds):
    """``rounds`` EM steps over all state paths."""
    for _ in range(rounds):
        start, moves, emitted = np.zeros_like(pi), np.zeros_like(a), np.zeros_like(b)
        for line in lines:
            paths = list(itertools.product(range(len(pi)), repeat=len(line)))
            weights = []
            for path in paths:
                p = pi[path[0]] * b[path[0], line[0]]
                for t in range(1, len(line)):
                    p *= a[path[t - 1], path[t]] * b[path[t], line[t]]
                weights.append(p)
            total = sum(weights)
            for path, p in zip(paths, weights):
                start[path[0]] += p / total
                for t, s in enumerate(path):
                    emitted[s, line[t]] += p / total
                    if t:
                        moves[path[t - 1], s] += p / total
        a, b, pi = (x / x.sum(-1, keepdims=True) for x in (moves, emitted, start))
    return a, b, pi


def test_training_covers_the_lines_of_documents(spark, tmp_path):
    texts = ["one two\nthree one", "two\n\nfour three"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame([(1, "only here")], "item_id bigint, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    rows = plans.QUERIES["hmm_train"](spark, str(tmp_path)).collect()
    assert len({r["j"] for r in rows if r["kind"] == "b"}) >= 4
    assert {r["kind"] for r in rows} == {"pi", "a", "b"}
    lines = Tables(spark, str(tmp_path)).training_lines()
    vocab = hmm.line_vocab(lines, ["id", "line_no"])
    assert len({r["j"] for r in rows if r["kind"] == "b"}) == vocab.count()


def test_training_equals_em_over_all_paths(spark):
    data = ["one two", "three one", "two", "four three", "one three two"]
    lines = hmm.training_lines(spark.createDataFrame(list(enumerate(data)), "id bigint, line string"))
    vocab = hmm.line_vocab(lines, ["id"])
    encoded = [r["ids"] for r in hmm.encode_lines(lines, ["id"], vocab).collect()]
    first = hmm.init_model(vocab, 2, 42)

    def emissions(model):
        return np.array([r[1:] for r in sorted(map(tuple, model.b.collect()))]).T

    want = brute_force(encoded, first.a, emissions(first), first.pi, 4)
    got, _ = hmm.train(lines, ["id"], states=2, max_iterations=4)
    for x, y in zip((got.a, emissions(got), got.pi), want):
        assert x == pytest.approx(y, abs=1e-6)


def test_one_job_an_iteration_gives_the_model_of_the_tables(spark, monkeypatch):
    data = ["one two", "three one", "two", "four three", "one three two five", "six"]
    lines = hmm.training_lines(spark.createDataFrame(list(enumerate(data)), "id bigint, line string"))
    joined, slow = hmm.train(lines, ["id"], states=2, max_iterations=3, limit=0)

    def no_tables(*given):
        raise AssertionError("a step by tables")

    monkeypatch.setattr(hmm, "em_step", no_tables)
    monkeypatch.setattr(hmm, "converged", no_tables)
    whole, fast = hmm.train(lines, ["id"], states=2, max_iterations=3)
    assert fast == pytest.approx(slow) and len(fast) == 3
    assert whole.a == pytest.approx(joined.a) and whole.pi == pytest.approx(joined.pi)
    rows = [sorted(map(tuple, m.b.collect())) for m in (whole, joined)]
    assert [r[0] for r in rows[0]] == [r[0] for r in rows[1]]
    assert np.array(rows[0]) == pytest.approx(np.array(rows[1]))
