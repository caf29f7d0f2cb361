import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.operators.subwords import MARKERS, Subwords, merged

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def words(spark):
    return Subwords.load(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library():
    made = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = False
    return made


TEXTS = [
    "", None, " ", "\n", "\n\n a\n", "  two  blanks   and\ttabs \t\n end ", "don't we'll 'S 's", "làm thơ với tiêu đề: x</s>",
    "a</s>b <unk> <s><pad>!</s>?<", "日本語 テキスト ½²", "  x\u0085y\x1c z", "é ĩ", "🙂🙃" * 5, "\r\n \r\n",
    "x" * 3000, "ab" * 5000, "</s>  </s> \n\n  </s>", "<<//s>>", "12345 6789", " 　\n　", "def f(x):\n    return  x  # ok",
]


def expected(library, words, text):
    """The library's ids of what stands between the markers, and the markers."""
    out, rest = [], text or ""
    while rest:
        places = [(rest.find(m), m) for m in MARKERS if m in rest]
        at, marker = min(places, default=(len(rest), None))
        out += library.encode(rest[:at], add_special_tokens=False).ids
        if marker is None:
            break
        out.append(words.markers[marker])
        rest = rest[at + len(marker) :]
    return out


def encoded(spark, words, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").repartition(2)
    return words.encode(df, ["id"], {"ids": "text"}, **options)


def test_ids_equal_those_of_the_library_and_decode(spark, words, library):
    rng = random.Random(3)
    alphabet = ["a", "B", "é", "1", " ", "  ", "\n", "\t", "'s", "</s>", "!", "?!", "ß", "<", "word", " the"]
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(400)]
    rows = {r.id: r.ids for r in encoded(spark, words, texts).collect()}
    for k, text in enumerate(texts):
        assert rows[k] == expected(library, words, text), text
    back = words.decode(encoded(spark, words, texts), ["id"]).collect()
    assert {r.id: r.text for r in back} == {k: t or "" for k, t in enumerate(texts)}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(categories=["L"]), min_size=1, max_size=30))
def test_merging_equals_the_library(words, library, piece):
    assert merged(piece.encode(), words.ranks) == library.encode(piece, add_special_tokens=False).ids


def test_limits_keep_the_leading_ids(spark, words, library):
    rows = {r.id: r.ids for r in encoded(spark, words, TEXTS, limits={"ids": 7}).collect()}
    for k, text in enumerate(TEXTS):
        assert rows[k] == expected(library, words, text)[:7]


def test_unknown_ids_and_null_arrays(spark, words):
    df = spark.createDataFrame([(1, [0, 10**6]), (2, None), (3, [])], "id int, ids array<bigint>")
    assert [tuple(r) for r in words.decode(df, ["id"]).orderBy("id").collect()] == [
        (1, "!<unk>"), (2, None), (3, ""),
    ]


def test_pairs_are_marked_and_padded(spark, words):
    prompts = spark.createDataFrame(
        [(1, "v", "one two\n", "three " * 500), (1, None, "", "")],
        "id bigint, variant string, source string, target string",
    )
    full, empty = words.encode_pairs(prompts, 8, 20).orderBy("variant", ascending=False).collect()
    bos, pad, eos = (words.markers[m] for m in ("<s>", "<pad>", "</s>"))
    assert full.input_ids[0] == bos and full.input_ids[-1] == pad and len(full.input_ids) == 8
    assert sum(full.attention_mask) == 8 - full.input_ids.count(pad)
    assert len(full.labels) == 20 and full.labels[-1] == eos
    assert empty.labels == [bos, eos] and empty.input_ids == [bos, eos] + [pad] * 6
