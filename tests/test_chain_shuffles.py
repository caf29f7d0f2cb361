import io
from contextlib import redirect_stdout

import pyarrow as pa

from corpusloom.operators import markov as mk
from corpusloom.operators import word_hashes as wh


def shuffles(df):
    """Columns that rows are dealt by, for each shuffle of the plan."""
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return [line for line in out.getvalue().splitlines() if " Exchange " in line or "- Exchange" in line]


def test_triples_are_shuffled_by_their_pair_only(spark, texts):
    """F8, F10: they were shuffled to be counted and again to meet the total of their pair."""
    key = ["w1", "w2"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        chain = mk.markov2(texts("a b c a b d", "A b, c", None, "a b", "", "a"), "text")
        top = mk.pick_one(mk.markov_argmax(mk.with_probability(chain, key), key), key)
        found = shuffles(top)
        assert found and all("hashpartitioning(w1" in x and "nxt" not in x.split("ENSURE")[0] for x in found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = {(r.w1, r.w2, r.nxt): r.n for r in chain.collect()}
    assert got == {("a", "b", "c"): 2, ("b", "c", "a"): 1, ("c", "a", "b"): 1, ("a", "b", "d"): 1, ("b", "d", "endl"): 1, ("b", "c", "endl"): 1}


def test_words_are_counted_alike_in_parts_and_with_many_words(monkeypatch):
    batch = pa.record_batch([pa.array([["x", "y", "x", "y", "x"], None, [], ["x", "y"], ["x", "y", "x"]])], ["w"])
    for size in (1, 6, 2**20):
        monkeypatch.setattr(wh, "BATCH_WORDS", size)
        got = {}
        for words, row in wh.joined_words([batch, batch.slice(1)]):
            for columns, n in wh.counted_words(words, row, "endl"):
                for *triple, k in zip(*[c.to_pylist() for c in columns], n.to_pylist()):
                    got[tuple(triple)] = got.get(tuple(triple), 0) + k
        assert got == {("x", "y", "x"): 4, ("y", "x", "y"): 1, ("y", "x", "endl"): 3}
