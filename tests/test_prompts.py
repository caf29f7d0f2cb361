import pytest

from corpusloom.operators.prompts import build_prompts, clean_corpus

T = "làm thơ với tiêu đề: t</s>"
G = "tuân theo thể thơ: g"
FULL = "l1\nl2\nl3"

CASES = [
    ((True, True, False, False, False), {"title_genre": (T + G, FULL)}),
    (
        (True, True, True, True, True),
        {
            "title_genre_first": (T + G + "</s>câu đầu:l1\n", "l2\nl3"),
            "title_genre_second": (T + G + "</s>hai câu đầu: l1\nl2\n", "l3"),
            "title_genre": (T + G, FULL),
            "augment": (G, FULL),
        },
    ),
    (
        (True, False, True, True, False),
        {
            "title_first": (T + "câu đầu:l1\n", "l2\nl3"),
            "title_second": (T + "hai câu đầu:l1\nl2\n", "l3"),
            "title": ("làm thơ với tiêu đề:t", FULL),
        },
    ),
    (
        (False, True, True, True, True),
        {
            "genre_first": (G + "</s>câu đầu:l1\n", "l2\nl3"),
            "genre_second": (G + "</s>hai câu đầu:l1\nl2\n", "l3"),
            "genre": (G, FULL),
        },
    ),
    (
        (False, False, True, True, False),
        {"first": ("câu đầu:l1\n", "l2\nl3"), "second": ("hai câu đầu:l1\nl2\n", "l3")},
    ),
]


@pytest.mark.parametrize("flags, want", CASES)
def test_variants(spark, flags, want):
    df = spark.createDataFrame([(1, FULL, "g", "t")], "id int, text string, genre string, title string")
    got = build_prompts(df, *flags).collect()
    assert {r["variant"]: (r["source"], r["target"]) for r in got} == want


def test_no_prompt_is_an_error(spark):
    with pytest.raises(ValueError):
        build_prompts(spark.range(1), False, False, False, False)


def test_null_title_and_genre(spark):
    schema = "id int, content string, title string, genre string"
    df = clean_corpus(spark.createDataFrame([(1, " one ", None, None)], schema))
    got = build_prompts(df).first()
    assert got["source"] == "làm thơ với tiêu đề: <unk></s>tuân theo thể thơ: <unk>"
    assert got["target"] == "one"
