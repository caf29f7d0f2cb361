import pytest
from pyspark.sql import functions as F

from corpusloom.functions import tokens as tk
from corpusloom.operators import encoding as en
from corpusloom.operators import splits
from corpusloom.operators.indexing import with_index, with_running_total


@pytest.fixture(params=[en.BROADCAST_LIMIT, 0], ids=["looked_up", "joined"])
def limit(request):
    return request.param


def vocab_of(spark, df):
    rows = tk.token_rows(df, ["id"], "text", tk.pieces)
    return en.with_specials(spark, en.build_vocab(rows, ["id", "pos"], len(en.SPECIALS)))


def test_index_and_running_total(spark):
    # One key holds most rows; the order still spreads over partitions.
    df = spark.range(5000).select(
        F.when(F.col("id") < 4000, 7).otherwise(F.col("id") % 5).alias("k"),
        (F.col("id") * 7919 % 5003).alias("v"),
    )
    got = with_running_total(df, ["k", "v"], "v").collect()
    want = sorted((r["k"], r["v"]) for r in df.collect())
    by_idx = sorted(got, key=lambda r: r["idx"])
    assert [(r["k"], r["v"]) for r in by_idx] == want
    total = 0
    for i, r in enumerate(by_idx):
        assert r["idx"] == i and r["before"] == total
        total += r["v"]
    assert sorted(r["idx"] for r in with_index(df, ["k", "v"]).collect()) == list(range(5000))


def test_index_of_nothing(spark):
    empty = spark.range(0)
    assert with_index(empty, ["id"]).collect() == []


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_vocab_is_in_order_of_first_appearance(spark, texts, kind):
    df = texts("b a b", "c a\n", "d").withColumn("id", F.col("id").cast(kind))
    rows = tk.token_rows(df, ["id"], "text", tk.pieces)
    got = en.build_vocab(rows, ["id", "pos"], first_id=4).orderBy("token_id").collect()
    assert [tuple(r) for r in got] == [("b", 4, 2), ("a", 5, 2), ("c", 6, 1), ("\n", 7, 1), ("d", 8, 1)]


def test_encode_texts(spark, texts, limit):
    vocab = vocab_of(spark, texts("b a", "c"))
    df = texts("a zzz b</s>", "", "c c").withColumn("other", F.lit("b"))
    got = en.encode_texts(
        df, ["id"], {"x": "text", "y": "other"}, vocab, limits={"x": 3}, broadcast_limit=limit
    ).orderBy("id")
    assert [(r["x"], r["y"]) for r in got.collect()] == [([5, 3, 4], [4]), ([], [4]), ([6, 6], [4])]


def test_characters_survive_a_round_trip(spark, texts):
    df = texts("Trăm năm\ntrong", "cõi 😀 người")
    vocab = en.build_char_vocab(df, "text")
    tokens = [r["token"] for r in vocab.orderBy("token_id").collect()]
    assert tokens == sorted(set("Trăm năm\ntrongcõi 😀 người"))
    rows = en.encode_rows(tk.token_rows(df, ["id"], "text", tk.chars), vocab)
    back = en.decode_rows(rows, vocab, ["id"])
    assert sorted(back.collect()) == sorted(df.collect())


@pytest.mark.parametrize("n", [0, 3, 40, 50])
def test_pad_truncate(spark, n):
    df = spark.range(1).select(F.lit(list(range(101, 101 + n))).cast("array<bigint>").alias("ids"))
    ids, mask = en.pad_truncate(F.col("ids"), 42)
    row = df.select(ids.alias("ids"), mask.alias("mask")).first()
    content = list(range(101, 101 + min(n, 40)))
    used = len(content) + 2
    assert row["ids"] == [0, *content, 2] + [1] * (42 - used)
    assert row["mask"] == [1] * used + [0] * (42 - used)


def test_batches(spark):
    df = spark.range(13).withColumn("split", F.when(F.col("id") < 10, "train").otherwise("test"))
    got = en.assign_batches(df, ["id"], 4).groupBy("split", "batch_id").count().collect()
    assert {(r[0], r[1]): r[2] for r in got} == {
        ("train", 0): 4, ("train", 1): 4, ("train", 2): 2, ("test", 0): 3,
    }
    shuffled = en.assign_batches(df, ["id"], 4, shuffle=True).filter("split = 'train'")
    assert sorted(r["count"] for r in shuffled.groupBy("batch_id").count().collect()) == [2, 4, 4]


def test_pad_to_batch(spark):
    df = spark.createDataFrame([(0, [1]), (0, [1, 2, 3]), (1, [4])], "b int, x array<bigint>")
    got = en.pad_to_batch(df, ["b"], "x", en.IGNORED_LABEL).collect()
    assert sorted(r["x"] for r in got) == [[1, -100, -100], [1, 2, 3], [4]]


def test_token_stream(spark):
    df = spark.createDataFrame([(5, [1, 2]), (2, []), (3, [7]), (9, [8, 9])], "id bigint, ids array<bigint>")
    got = en.token_stream(df, "id").orderBy("pos").collect()
    assert [tuple(r) for r in got] == [(0, 7), (1, 1), (2, 2), (3, 8), (4, 9)]


def test_lm_windows(spark):
    stream = spark.range(10).select(F.col("id").alias("pos"), (F.col("id") * 10).alias("token_id"))
    got = en.lm_windows(stream, 10, 3, 200).collect()
    assert len(got) == 200 and {r["start"] for r in got} == set(range(7))
    for r in got:
        assert r["x"] == [10 * (r["start"] + i) for i in range(3)]
        assert r["y"] == [10 * (r["start"] + 1 + i) for i in range(3)]
    with pytest.raises(ValueError):
        en.lm_windows(stream, 3, 3, 1)


def test_exact_split(spark):
    got = splits.split_rows_exact(spark.range(100), ["id"])
    assert {r[0]: r[1] for r in got.groupBy("split").count().collect()} == {
        "train": 80, "valid": 10, "test": 10,
    }


def test_split_keeps_keys_together(spark):
    df = spark.range(3000).select((F.col("id") % 1000).alias("id"), F.col("id").alias("row"))
    got = splits.split_rows(df, ["id"])
    assert got.select("id", "split").distinct().count() == 1000
    sizes = {r[0]: r[1] for r in got.groupBy("split").count().collect()}
    assert 2250 < sizes["train"] < 2550 and min(sizes.values()) > 200
    assert splits.split_select(got, "test").count() == sizes["test"]


def test_samples(spark):
    df = spark.range(1000)
    assert splits.sample_fraction_exact(df, ["id"], 0.12).count() == 120
    assert 80 < splits.sample_fraction(df, ["id"], 0.12).count() < 160
    words = spark.createDataFrame([("a",), ("b",), ("c",)], "word string")
    picks = splits.pick_with_replacement(words, ["word"], df, ["id"]).groupBy("word").count().collect()
    assert len(picks) == 3 and all(280 < r["count"] < 390 for r in picks)


@pytest.mark.parametrize("limit", [en.BROADCAST_LIMIT, 0])
def test_decode_texts_keeps_rows_without_ids(spark, limit):
    rows = [(1, [1, 0]), (2, []), (None, None), (1, [0]), (3, [9, 1])]
    df = spark.createDataFrame(rows, "id int, ids array<bigint>")
    vocab = spark.createDataFrame([("a", 0), ("b", 1)], "token string, token_id bigint")
    got = en.decode_texts(df, ["id"], "ids", vocab, "-", limit).collect()
    want = [(1, "b-a"), (2, ""), (None, ""), (1, "a"), (3, "<unk>-b")]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("unknown", [3, None])
def test_tokens_above_the_limit_are_joined_and_others_looked_up(spark, unknown):
    texts = [(1, "a b c\nd e a"), (1, "f g a"), (2, ""), (3, None), (None, "a b"), (4, "z c g g"), (5, "y")]
    df = spark.createDataFrame(texts, "id long, text string").withColumn("other", F.reverse("text"))
    seen = df.filter("id < 4 OR id IS NULL").select(F.coalesce("id", F.lit(9)).alias("id"), "text")
    vocab = en.build_vocab(tk.token_rows(seen, ["id"], "text", tk.pieces), ["id", "pos"])
    columns = {"ids": "text", "back": "other"}
    coded = [
        sorted(map(str, en.encode_texts(df, ["id"], columns, vocab, unknown_id=unknown, broadcast_limit=limit).collect()))
        for limit in (en.BROADCAST_LIMIT, 90)
    ]
    assert 0 < en._head(vocab, 90) < vocab.count()
    assert coded[0] == coded[1]
