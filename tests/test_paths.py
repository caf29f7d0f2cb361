"""One result whatever the size of a table, and whatever its keys."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import encoding as en
from corpusloom.operators import hmm, hmm_kernel, metrics
from corpusloom.operators.splits import split_rows_exact
from corpusloom.sources import corpus as src

LIMITS = [en.BROADCAST_LIMIT, 0]


@pytest.mark.parametrize("limit", LIMITS)
def test_encoding_with_equal_and_null_keys(spark, limit):
    rows = [(None, "b a", "a"), (None, "a", None), (1, None, "b"), (1, "a a", "zz"), (2, "", "")]
    df = spark.createDataFrame(rows, "id int, source string, target string")
    vocab = spark.createDataFrame([("a", 10), ("b", 11)], "token string, token_id bigint")
    got = en.encode_texts(
        df, ["id"], {"s": "source", "t": "target"}, vocab, lambda c: F.filter(F.split(c, " "), lambda x: x != ""),
        unknown_id=3, broadcast_limit=limit,
    )
    want = [(None, [11, 10], [10]), (None, [10], []), (1, [], [11]), (1, [10, 10], [3]), (2, [], [])]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def two_states(spark):
    vocab = spark.createDataFrame([("x", 0), ("y", 1)], "token string, token_id bigint")
    b = spark.createDataFrame([(0, 0.7, 0.4), (1, 0.3, 0.6)], "token_id bigint, p0 double, p1 double")
    return hmm.Model(np.array([0.6, 0.4]), np.array([[0.1, 0.9], [0.5, 0.5]]), b, vocab, 2)


@pytest.mark.parametrize("schema", ["id int, ids array<bigint>", "ids array<bigint>"])
def test_hmm_steps_agree_on_both_paths(spark, schema):
    rows = [(1, [0, 0, 1]), (1, [1, 0]), (None, [0, 1, 1, 0]), (None, [1]), (2, [])]
    rows = [r if "id int" in schema else r[1:] for r in rows]
    lines, model = spark.createDataFrame(rows, schema), two_states(spark)
    results = []
    for limit in LIMITS:
        forward = sorted(map(str, hmm.forward(lines, model, limit).collect()))
        moves = {(r.i, r.j): r.expected for r in hmm.transitions(lines, model, limit).collect()}
        assert sum(moves.values()) == pytest.approx(2 + 1 + 3)
        step, likelihood = hmm.em_step(lines, model, limit)
        results.append((forward, likelihood, step.a, step.pi, sorted(map(tuple, step.b.collect()))))
    (f1, l1, a1, p1, b1), (f2, l2, a2, p2, b2) = results
    assert len(f1) == len(f2) == 4 and l1 == pytest.approx(l2)
    assert np.allclose(a1, a2) and np.allclose(p1, p2) and np.allclose(b1, b2)


def test_best_path_before_an_unseen_word():
    layout = hmm_kernel.Layout(np.array([2]))
    with np.errstate(divide="ignore"):
        log_e = np.log(np.array([[0.5, 0.5], [0.0, 0.0]]))
        path, score = hmm_kernel.viterbi(
            layout, log_e, np.log(np.array([[0.5, 0.5], [0.5, 0.5]])), np.log(np.array([0.1, 0.9]))
        )
    assert path.tolist() == [0, 0] and score[0] == -np.inf


@pytest.mark.parametrize("limit", LIMITS)
def test_unseen_words_get_their_share(spark, limit):
    model = hmm.with_unseen(two_states(spark), 0.25)
    lines = spark.createDataFrame([(1, [-1]), (2, [0])], "id int, ids array<bigint>")
    got = {r.id: r.log_likelihood for r in hmm.forward(lines, model, limit).collect()}
    assert got[1] == pytest.approx(np.log(0.25))
    assert got[2] == pytest.approx(np.log(0.75 * (0.6 * 0.7 + 0.4 * 0.4)))


def test_convergence_looks_at_every_table(spark):
    from dataclasses import replace

    old = two_states(spark)
    near = replace(old, a=old.a * 1.000001, pi=old.pi * 1.000001)
    assert hmm.converged(near, old)
    assert not hmm.converged(replace(old, a=old.a[::-1]), old)
    assert not hmm.converged(replace(old, pi=old.pi[::-1]), old)
    other = old.b.select("token_id", F.col("p1").alias("p0"), F.col("p0").alias("p1"))
    assert not hmm.converged(replace(old, b=other), old)


def test_three_positions_keep_their_order(spark):
    rows = [("b", 1, 2, 0, 5), ("a", 1, 2, 0, 6), ("c", 0, 9, 9, 9), ("d", 1, 1, 7, 7)]
    df = spark.createDataFrame(rows, "token string, id bigint, x int, y int, z int")
    got = {r.token: r.token_id for r in en.build_vocab(df, ["id", "x", "y", "z"]).collect()}
    assert got == {"c": 0, "d": 1, "b": 2, "a": 3}


def test_unknown_ids_and_targets_are_not_dropped(spark):
    vocab = spark.createDataFrame([("a", 4), ("b", 5)], "token string, token_id bigint")
    rows = spark.createDataFrame([(1, 0, 4), (1, 1, 99), (1, 2, 5)], "id int, pos int, token_id bigint")
    assert en.decode_rows(rows, vocab, ["id"], " ").first().text == "a <unk> b"
    logits = spark.createDataFrame([(1, 0, 0.5, 7), (1, 1, 0.1, 7)], "r int, token int, logit double, target int")
    with pytest.raises(Exception, match="not among the tokens"):
        metrics.masked_nll(logits, ["r"]).collect()


def test_exact_split_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 3), (4, 4)], "id int, v int")
    got = split_rows_exact(df, ["id"]).collect()
    assert sorted(r.v for r in got) == [1, 2, 3, 4]
    assert len({r.split for r in got if r.id is None}) == 1


def test_csv_columns_are_read_by_name(spark, tmp_path):
    (tmp_path / "c.csv").write_text("genre,content\nluc bat,line one\nx,line two\nx,line two\nx,\n")
    got = src.read_corpus(spark, str(tmp_path / "c.csv"), "csv").collect()
    assert sorted((r.genre, r.content) for r in got) == [("luc bat", "line one"), *[("x", "line two")] * 2]
    assert all(r.title is None and r.id for r in got) and len({r.id for r in got}) == 3
    again = src.read_corpus(spark, str(tmp_path / "c.csv"), "csv").repartition(5).collect()
    assert sorted(r.id for r in again) == sorted(r.id for r in got)


def test_many_equal_rows_get_ids_apart(spark, monkeypatch):
    monkeypatch.setattr(src, "COPIES", 10)
    df = spark.range(95).select(F.lit("same").alias("content"))
    ids = [r.id for r in src.with_text_id(df).collect()]
    assert len(ids) == len(set(ids)) == 95


def test_file_lines_feed_the_training(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one two\n\nthree one\ntwo one\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("two two", encoding="utf-8")
    lines = src.read_lines(spark, str(tmp_path))
    rows = sorted((r.file[-5:], r.line_no, r.line) for r in lines.collect())
    assert rows == [
        ("a.txt", 0, "one two"), ("a.txt", 1, ""), ("a.txt", 2, "three one"), ("a.txt", 3, "two one"),
        ("b.txt", 0, "two two"),
    ]
    model, history = hmm.train(
        hmm.training_lines(lines), ["file", "line_no"], states=2, max_iterations=3
    )
    assert model.vocab_size == 4 and history == sorted(history)


def test_a_stored_stream_is_opened(spark, tmp_path):
    stream = spark.range(20).select(F.col("id").alias("pos"), (F.col("id") * 2).alias("token_id"))
    src.write_token_stream(stream, str(tmp_path / "s"))
    back = src.read_token_stream(spark, str(tmp_path / "s"))
    assert sorted(map(tuple, back.collect())) == [(i, 2 * i) for i in range(20)]
