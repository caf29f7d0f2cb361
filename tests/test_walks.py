import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusloom.functions.det import uniform, uniform_value
from corpusloom.operators import decoding as de
from corpusloom.operators import markov as mk
from corpusloom.operators import walks
from corpusloom.operators.indexing import with_index, with_running_total
from corpusloom.plans import markov as plans


def test_no_edge_above_zero_is_lost(spark):
    rows = [("c", "often", 1.0), ("c", "rare", 1e-12), ("c", "never", 0.0), ("d", "only", 1e-300)]
    rows += [("v", f"t{i:05}", 1 / 20000) for i in range(20000)] + [("v", "least", 2.0**-40)]
    edges = spark.createDataFrame(rows, "ctx string, out string, p double")
    made = walks.weighted_transitions(edges, ["ctx"], "out", "p")
    found = {(r.ctx, r.out) for r in made.edges.select("ctx", "out").distinct().collect()}
    assert found == {(c, o) for c, o, p in rows if p > 0}
    ends = made.edges.join(made.contexts, "ctx").groupBy("ctx").agg(
        F.max(F.col("hi") - F.col("count")).alias("over"), F.min("lo").alias("lo")
    )
    assert all(r.over == 0 and r.lo == 0 for r in ends.collect())


def test_draws_follow_the_cumulative_probabilities(spark):
    edges = spark.createDataFrame(
        [(0, "a", 0.2), (0, "b", 0.5), (0, "c", 0.3)], "ctx int, out string, p double"
    )
    made = walks.weighted_transitions(edges, ["ctx"], "out", "p")
    walkers = spark.range(2000).withColumn("ctx", F.lit(0)).join(made.contexts, "ctx")
    table = walks.with_rests(made.last())
    for few in (False, True):
        drawn = walks.advance(
            walkers, table, ["id"], 3, 42, True, {"token": F.col("out")}, few
        ).collect()
        assert len(drawn) == 2000
        for r in drawn:
            u = uniform_value(42, r.id, 3)
            assert r.token == ("a" if u < 0.2 else "b" if u < 0.7 else "c")


def test_few_walkers_leave_the_edges_unshuffled(spark, monkeypatch):
    lines = spark.createDataFrame([(i, f"a b{i % 7} c d{i % 3}") for i in range(60)], "id int, line string")
    chain2 = mk.with_probability(mk.markov2(lines, "line"), ["w1", "w2"])
    writer = mk.LineWriter(mk.markov1(lines, "line"), chain2)
    starts = spark.createDataFrame([(i, "a") for i in range(40)], "id int, word string")

    def rows_and_plan():
        written = writer.write_lines(starts, ["id"], "word")
        rows = sorted(map(tuple, written.collect()))
        return rows, written._jdf.queryExecution().executedPlan().toString()

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few, plan = rows_and_plan()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        monkeypatch.setattr(mk, "few_walkers", lambda walkers: False)
        many, plan = rows_and_plan()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert few == many and len(few) == 40


def test_continuations_end_and_go_on(spark):
    texts = spark.createDataFrame([("a b c d e f g h i j k l m n o p q r s t",)], "t string")
    chain = mk.markov2(texts, "t")
    prompts = spark.createDataFrame([(1, "a b"), (2, "s t"), (3, "x y"), (4, "one")], "id int, text string")
    for cut in (3, 10, 50):
        got = de.sample_continuations(chain, prompts, "id", "text", samples=2, max_new_tokens=12, cut_every=cut)
        rows = {(r.id, r["sample"]): " ".join(r.tokens) for r in got.collect()}
        assert len(rows) == 8 and rows[1, 0] == rows[1, 1] == "c d e f g h i j k l m n"
        assert all(rows[k, s] == "" for k in (2, 3, 4) for s in (0, 1))


def test_sample_top_k_equals_the_normalised_race(spark):
    rows = [(c, t, float((c * 7 + t * 13) % 11)) for c in range(50) for t in range(20)]
    logits = spark.createDataFrame(rows, "context int, token int, logit double")
    kept = de.top_k_filter(logits, ["context"], 5)
    p = de.temperature_softmax(kept, ["context"], 0.7)
    want = sorted(map(tuple, de.categorical_sample(p, ["context"]).collect()))
    fast = de.sample_top_k(logits, ["context"], 5, 0.7)
    assert sorted(map(tuple, fast.collect())) == want
    joins = [x._jdf.queryExecution().optimizedPlan().toString().count("Join ") for x in (fast, de.categorical_sample(p, ["context"]))]
    assert joins[0] < joins[1]


def test_running_totals_beyond_a_bigint(spark):
    big = 2**62
    df = spark.range(8).select("id", F.lit(big).cast("decimal(20,0)").alias("w"))
    got = {r.id: int(r.before) for r in with_running_total(df, ["id"], "w").collect()}
    assert got == {i: i * big for i in range(8)}
    assert [r.idx for r in with_index(df, ["id"]).orderBy("id").collect()] == list(range(8))
    assert with_index(df.limit(0), ["id"]).count() == 0


@pytest.mark.parametrize("keys", [[("a|b", "c"), ("a", "b|c")], [(None, "x"), ("x", None)], [("\\N", "1"), (None, "1")]])
def test_different_keys_draw_apart(spark, keys):
    df = spark.createDataFrame(keys, "k string, l string")
    drawn = [r.u for r in df.select("k", "l", uniform(42, "k", "l").alias("u")).collect()]
    assert drawn[0] != drawn[1]
    assert drawn == [uniform_value(42, *k) for k in keys]


def test_few_walkers_take_a_short_query_for_each_word(spark, monkeypatch):
    texts = spark.createDataFrame([("a b c a b d a b e",), ("a b c d",)], "t string")
    chain = mk.markov2(texts, "t")
    prompts = spark.createDataFrame([(1, "a b"), (2, "x y"), (3, "b c")], "id int, text string")
    joins, one_step = [], de.advance

    def counted(*given, **named):
        moved = one_step(*given, **named)
        joins.append(moved._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return moved

    def rows():
        got = de.sample_continuations(chain, prompts, "id", "text", 30, 9, cut_every=4)
        return sorted((r.id, r["sample"], tuple(r.tokens)) for r in got.collect())

    monkeypatch.setattr(de, "advance", counted)
    few = rows()
    assert set(joins) == {1} and len(few) == 90
    monkeypatch.setattr(de, "few_walkers", lambda walkers: False)
    assert rows() == few


class _Lines:
    def __init__(self, lines):
        self.given = lines

    def lines(self):
        return self.given


def _varied(spark, count=240):
    words = "a b c d e f g h".split()
    text = [" ".join(words[(i * k + k * k // 3) % (2 + i % 7)] for k in range(2 + i % 6)) for i in range(count)]
    text += ["", "A, b!", "solo", "a endl b c", *(f"n{i} o{i} p{i} q{i}" for i in range(count))]
    return spark.createDataFrame(list(enumerate(text)), "id int, line string")


def _record(monkeypatch):
    """Rows indexed for each step."""
    sizes, made = [], mk.uniform_transitions

    def recorded(*given):
        found = made(*given)
        sizes.append(found.edges.count())
        return found

    monkeypatch.setattr(mk, "uniform_transitions", recorded)
    return sizes


def test_lines_index_only_the_contexts_of_walkers(spark, monkeypatch):
    """nothing is indexed for pairs that no walker stands on."""
    sizes = _record(monkeypatch)
    starts = spark.createDataFrame([(0, "n7"), (1, "n8"), (2, "nowhere"), (3, None)], "id int, word string")
    written = plans._writer(_Lines(_varied(spark))).write_lines(starts, ["id"], "word")
    assert {tuple(r) for r in written.collect()} == {(0, "n7 o7 p7 q7"), (1, "n8 o8 p8 q8")}
    assert max(sizes) == 2


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_lines_from_texts_equal_those_of_the_whole_chains(spark, monkeypatch, limit):
    lines = _varied(spark)
    starts = spark.range(300).select("id", F.element_at(F.split(F.lit("a b c n3 A e zz"), " "), (F.col("id") % 7 + 1).cast("int")).alias("word"))
    chain2 = mk.with_probability(mk.markov2(lines, "line"), ["w1", "w2"])
    whole = mk.LineWriter(mk.markov1(lines, "line"), chain2).write_lines(starts, ["id"], "word")
    want = sorted(map(tuple, whole.collect()))
    monkeypatch.setattr(mk, "MANY_WALKERS", limit)
    writer = mk.TextLineWriter(lines, "line")
    assert sorted(map(tuple, writer.write_lines(starts, ["id"], "word").collect())) == want
    assert len(want) > 100
    firsts = {r.word for r in mk.start_words(lines, "line").collect()}
    assert {r.word for r in writer.start_words().collect()} == firsts


def test_a_context_met_again_is_not_counted_again(spark, monkeypatch):
    """walkers that go round in a loop ask for each of its contexts once."""
    asked, met = [], mk.TextLineWriter._met

    def counted(self, contexts, key, shortest):
        if len(key) == 2:
            asked.append(contexts.count())
        return met(self, contexts, key, shortest)

    monkeypatch.setattr(mk.TextLineWriter, "_met", counted)
    lines = spark.createDataFrame([("a b a b a b a b",), ("x y z",)], "line string")
    starts = spark.createDataFrame([(0, "a"), (1, "x")], "id int, word string")
    written = plans._writer(_Lines(lines)).write_lines(starts, ["id"], "word")
    assert [tuple(r) for r in written.collect()] == [(1, "x y z")]
    assert len(asked) == mk.MAX_STEPS and sum(asked) == 4


def test_predict_next_indexes_only_what_its_prompts_meet(spark, monkeypatch):
    """texts that no prompt leads into add no rows to index."""
    sizes, indexed = _record(monkeypatch), []
    prompts = [(1, "n7 o8 zz"), (2, "zz"), (3, "zz, q3"), (4, "N5!"), (5, None), (6, "o9 zz n9")]
    for count in (40, 240):
        tables = _Lines(_varied(spark, count))
        tables.prompts = lambda: spark.createDataFrame(prompts, "id int, text string")
        rows = {r.id: r.line for r in plans.predict_next(tables).collect()}
        assert rows == {1: "o8 p8 q8\n", 2: None, 3: None, 4: "n5 o5 p5 q5\n", 5: None, 6: "n9 o9 p9 q9\n"}
        indexed.append(max(sizes))
        sizes.clear()
    assert indexed[0] == indexed[1] < 20


def test_predict_next_from_texts_takes_no_blank_sequence(spark):
    tables = _Lines(_varied(spark, 10))
    tables.prompts = lambda: spark.createDataFrame([(1, "n7"), (2, " \t")], "id int, text string")
    with pytest.raises(PySparkException, match="must not be blank"):
        plans.predict_next(tables).collect()


def test_predict_next_drops_walkers_before_a_finished_one(spark, monkeypatch):
    """a word before one that gave a line is not walked from any more."""
    lines = _varied(spark)
    rows = [(i, " ".join("abcdefgh"[(i * k) % 8] for k in range(1, 9)) + f" n{i}" * (i % 2)) for i in range(24)]
    prompts = spark.createDataFrame(rows + [(99, "q7 n7 e zz")], "id int, text string")
    chain2 = mk.with_probability(mk.markov2(lines, "line"), ["w1", "w2"])
    whole = mk.LineWriter(mk.markov1(lines, "line"), chain2).predict_next(prompts, "id", "text")
    walked, one_step = [], mk.advance

    def counted(walkers, *given):
        walked.append(walkers.count())
        return one_step(walkers, *given)

    want = {r.id: r.line for r in whole.collect()}
    monkeypatch.setattr(mk, "advance", counted)
    tables = _Lines(lines)
    tables.prompts = lambda: prompts
    assert {r.id: r.line for r in plans.predict_next(tables).collect()} == want
    pruned, walked[:] = sum(walked), []
    words = mk.TextLineWriter(lines, "line")
    starts = prompts.select("id", F.posexplode(F.split("text", " ")).alias("pos", "word"))
    words.write_lines(starts, ["id", "pos"], "word").collect()
    assert pruned < sum(walked)
