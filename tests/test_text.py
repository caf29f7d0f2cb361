import re
import string
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.functions import tokens as tk
from corpusloom.functions.det import uniform, uniform_value

SAMPLES = [
    "a b",
    "a  b",
    "a, b",
    "abc ",
    "",
    " Trăm năm, trong cõi! ",
    "...",
    "a-b c",
    "“x”",
    unicodedata.normalize("NFD", "trăm năm"),
    "　wide\xa0space\x1f \t\x85",
    "x_1 ²½ ٣\n\nend",
    "  ",
]


def evaluate(spark, column, values=SAMPLES):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r["v"] for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_strip_and_whitespace_class(spark):
    everything = [chr(c) + "x" + chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    assert evaluate(spark, tx.strip(F.col("t")), everything) == [s.strip() for s in everything]
    split = F.regexp_replace("t", f"[{tx.SPACE_CLASS}]", "")
    assert evaluate(spark, split, everything) == ["".join(s.split()) for s in everything]


def test_words(spark):
    want = [
        "".join(c for c in s.strip().lower() if c not in string.punctuation).split() for s in SAMPLES
    ]
    assert evaluate(spark, tk.words(F.col("t"))) == want
    assert want[5] == ["trăm", "năm", "trong", "cõi"]


@pytest.mark.parametrize("newline", [True, False])
def test_runs(spark, newline):
    want = [
        [t for t in re.split(r"(\W+)", s + "\n" * newline) if t not in ("", " ")] for s in SAMPLES
    ]
    assert evaluate(spark, tk.runs(F.col("t"), newline)) == want


def test_word_count_and_chars(spark):
    assert evaluate(spark, tk.word_count(F.col("t"))) == [len(re.findall(r"\w+", s)) for s in SAMPLES]
    values = ["a😀b", "", "x\ny"]
    assert evaluate(spark, tk.chars(F.col("t")), values) == [list(v) for v in values]


def test_pieces_keep_markers(spark):
    got = evaluate(spark, tk.pieces(F.col("t")), ["a!</s>b\nc<unk> < d", ""])
    assert got == [["a", "!", "</s>", "b", "\n", "c", "<unk>", "<", "d"], []]


def test_normalise_line(spark):
    values = ["  A, b. ", ". .", "..."]
    assert evaluate(spark, tx.normalise_line(F.col("t")), values) == ["a b", " ", ""]


def test_clean_content(spark):
    values = ["  a . b ? c ! d , e ' f do n't I 'm it 's we 've you 're  ", None]
    got = evaluate(spark, tx.clean_content(F.col("t")), values)
    assert got == ["a. b? c! d, e'f don't I'm it's we've you're", None]


def test_null_genre_and_title(spark):
    values = [None, " Lục  Bát!! ", " a . "]
    assert evaluate(spark, tx.clean_genre(F.col("t")), values) == ["<unk>", "Lục  Bát!!", "a."]
    assert evaluate(spark, tx.clean_title(F.col("t")), values) == ["<unk>", "lục bát !!", "a ."]


def test_line_parts(spark):
    values = ["l1\nl2\nl3", "l1", "", "l1\n", "l1\nl2\n\n"]
    for k in (1, 2):
        assert evaluate(spark, tx.head_lines(F.col("t"), k), values) == [
            "\n".join(v.split("\n")[:k]) for v in values
        ]
        assert evaluate(spark, tx.tail_lines(F.col("t"), k), values) == [
            "\n".join(v.split("\n")[k:]) for v in values
        ]


def test_truncate_and_newlines(spark):
    values = ["é" * 300, "a\nb\n"]
    assert evaluate(spark, tx.truncate_chars(F.col("t")), values) == ["é" * 256, "a\nb\n"]
    assert evaluate(spark, tx.newline_to_period(F.col("t")), values)[1] == "a.b."


def test_uniform(spark):
    got = evaluate(spark, uniform(42, "i", F.lit("é")), ["x"] * 2000)
    assert got == [uniform_value(42, i, "é") for i in range(2000)]
    assert 0.47 < sum(got) / 2000 < 0.53 and len(set(got)) == 2000
