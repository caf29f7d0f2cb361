import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpusloom.llm.packing import CAPACITY, Encoder, Packer, pack

ODD = [
    "", None, " \n ", "Don't STOP; we'll see, it's 12345 o'clock!'s", "naïve Œuvre Straße ÀÉÎ",
    "a b\u0085c\x1cd", "été Σίσυφος ΟΔΟΣ İstanbul", "日本語 テキスト <|endoftext|> ½²",
    "x" * 5000, "the quick brown fox " * 1500, "''''s 'S 'LL don't", "\t\x0b\x0c\r",
]


ODD += [
    "hello <|endoftext|> world", "<|startoftext|><|endoftext|>", "A<|endoftext|>B é<|ENDOFTEXT|>'s", "<|endoftext",
    "|> x", "don<|endoftext|>'t '<|startoftext|>s12<|endoftext|>3", "é<|ENDOFTEXT|>", "<|<|endoftext|>|> <|EndOfText|>",
]

ENCODER = Encoder()
#: The tokenizer as its file has it; nothing in the module sets anything on it.
UNTOUCHED = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def whole(text):
    return [*UNTOUCHED.encode(text or "", add_special_tokens=False).ids, 1]


def test_encoder_equals_the_tokenizer():
    ids, begins = Encoder(limit=1500).encode(pa.chunked_array([ODD]))
    for i, text in enumerate(ODD):
        assert ids[begins[i] : begins[i + 1]].tolist() == whole(text)[:-1], text


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_encoder_on_any_text(text):
    ids, _ = ENCODER.encode(pa.chunked_array([[text]]))
    assert ids.tolist() == whole(text)[:-1]


PIECES = ["<|endoftext|>", "<|startoftext|>", "<|", "|>", "<|ENDOFTEXT|>", "a", "É", "'s", " ", "\n", "12", "\u0301", "!"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES) | st.text(max_size=3), max_size=10), min_size=1, max_size=4))
def test_encoder_with_special_tokens_written_out(texts):
    texts = ["".join(t) for t in texts]
    ids, begins = ENCODER.encode(pa.chunked_array([texts]))
    for i, text in enumerate(texts):
        assert ids[begins[i] : begins[i + 1]].tolist() == whole(text)[:-1]


def check(rows, texts):
    """Every id in one piece, sequences gapless and without padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for key, text in texts.items():
        ids, at = np.array(whole(text), dtype="<u4"), 0
        for r in sorted(pieces.pop(key), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert not pieces
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= CAPACITY and at & (at - 1) == 0


def test_pack_keeps_every_id(spark):
    texts = dict(enumerate(ODD + [f"word{i} " * (i * 7 % 900) for i in range(150)]))
    docs = spark.createDataFrame(
        [(k, v, "x", 1) for k, v in texts.items()], "doc_id long, text string, start string, key int"
    )
    check(pack(docs.repartition(3)).collect(), texts)
    assert pack(docs.limit(0)).collect() == []


def test_pack_returns_ids_and_takes_repeats_and_null_keys(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    rows = pack(docs.coalesce(1), with_ids=True).collect()
    assert sum(r.length for r in rows) == 3 * len(whole("a b"))
    got = [i for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)) for i in r.ids]
    assert sorted(got) == sorted(whole("a b") * 3)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 15), max_size=120), st.integers(2, 30))
def test_packer_places_everything_and_tracks_levels(sizes, most):
    packer, done = Packer(16, most), []
    for row, size in enumerate(sizes):
        done += packer.place(((row, size), 0, np.arange(size)))
        assert packer.open == packer.counts.sum() <= most
        for level, windows in packer.levels.items():
            assert packer.counts[level] == len(windows)
            assert all(sum(len(p[2]) for p in w) == level for w in windows)
    done += packer.close()
    got = defaultdict(list)
    for window in done:
        total = sum(len(p[2]) for p in window)
        assert total == 16 or total & (total - 1) == 0
        for (row, _), start, ids in window:
            got[row] += ids.tolist()
            assert ids[0] == start
    assert {k: sorted(v) for k, v in got.items()} == {
        row: list(range(size)) for row, size in enumerate(sizes)
    }


@pytest.mark.parametrize("size", [3, 8, 13])
def test_packer_takes_the_smallest_sum_of_squares(size):
    rng = np.random.default_rng(size)
    packer = Packer(16, 10**6)
    for row, n in enumerate(rng.integers(1, 16, 300)):
        before = packer.counts.copy()
        options = []
        for level in [0, *np.flatnonzero(before[:16])]:
            if level + n <= 16:
                after = before.copy()
                after[level] -= level > 0
                after[level + n] += level + n < 16
                options.append(int((after**2).sum()))
        packer.place(((row, n), 0, np.arange(n)))
        assert int((packer.counts**2).sum()) == min(options)
