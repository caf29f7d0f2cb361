import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import selection, splits
from corpusloom.operators.indexing import with_number


def drawn(spark, draws):
    return spark.createDataFrame(list(enumerate(draws)), "k bigint, _draw bigint").repartition(3)


@pytest.mark.parametrize("spread", [1, 3, 1 << 20, 1 << 52])
def test_cuts(spark, spread):
    rng = random.Random(spread)
    draws = [rng.randrange(spread) for _ in range(300)]
    ranks = [0, 1, 17, 150, 299, 300]
    found = selection.cuts(drawn(spark, draws), lambda n: ranks)
    ordered = sorted(draws)
    for rank, cut in found[:-1]:
        value = ordered[rank]
        assert cut == selection.Cut(value, ordered.index(value), ordered.count(value))
    assert found[-1] == (300, None)


def test_no_rows(spark):
    assert selection.cuts(drawn(spark, [5]).filter("k < 0"), lambda n: [n]) == [(0, None)]
    empty = spark.range(0)
    assert splits.split_rows_exact(empty, ["id"]).count() == 0
    assert splits.sample_fraction_exact(empty, ["id"], 0.5).count() == 0


@pytest.mark.parametrize("end", [0, 1, 4, 9, 10, 12])
def test_ties_across_the_border(spark, end):
    draws = [7, 7, 3, 7, 9, 3, 9, 9, 7, 1]
    df = drawn(spark, draws)
    ((_, cut),) = selection.cuts(df, lambda n: [end])
    first = {k for _, k in sorted((d, k) for k, d in enumerate(draws))[:end]}
    marked = selection.mark_first(df, df, ["k"], end, cut, "first")
    assert {r["k"] for r in marked.filter("first").collect()} == first and marked.count() == 10
    taken = sorted(r["_draw"] for r in selection.take_first(df, end, cut).collect())
    assert taken == sorted(draws)[:end]


def test_a_key_on_every_row(spark):
    df = spark.range(0, 1000, 1, 5).select(F.lit("same").alias("key"), "id")
    got = splits.sample_fraction_exact(df, ["key"], 0.25)
    assert got.count() == 250 and got.select("id").distinct().count() == 250
    assert splits.split_rows_exact(df, ["key"]).select("split").distinct().count() == 1


def test_null_keys_keep_their_rows(spark):
    df = spark.createDataFrame([(None,), ("a",), ("b",), (None,), ("c",)], "k string")
    rows = splits.split_rows_exact(df, ["k"]).collect()
    assert len(rows) == 5 and len({r["split"] for r in rows if r["k"] is None}) == 1


def test_no_sort_and_no_join(spark, capsys):
    for df in (
        splits.split_rows_exact(spark.range(1000), ["id"]),
        splits.sample_fraction_exact(spark.range(1000), ["id"], 0.1),
    ):
        df.explain("formatted")
        plan = capsys.readouterr().out
        assert "Exchange" not in plan and "Join" not in plan and "Sort" not in plan


def test_with_number(spark):
    rows = with_number(spark.range(0, 100, 1, 7), "n").collect()
    assert sorted(r["n"] for r in rows) == list(range(100))
