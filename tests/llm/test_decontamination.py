import hashlib
import random
import re

import numpy as np
import pytest

from corpusloom.llm import decontamination as dc
from corpusloom.llm.queries import op3_decontamination
from tests.llm.conftest import ROWS

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain(text, tests, window=10):
    own = words(text)
    hit, items = set(), set()
    for item, other in tests:
        theirs = words(other)
        size = min(window, len(theirs))
        for i in range(len(theirs) - size + 1 if size else 0):
            for at in range(len(own) - size + 1):
                if own[at : at + size] == theirs[i : i + size]:
                    hit |= set(range(at, at + size))
                    items.add("" if item is None else str(item))
    return len(own), len(hit), sorted(items)


def random_rows(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "Dé", "e1", "f"]
    tests = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 9, 10, 11, 25])))) for k in range(9)]
    tests += [(3, tests[3][1]), (None, "nobody has this one but it is here"), (11, None), (12, "")]
    docs = []
    for k in range(60):
        parts = [" ".join(rng.choices(vocabulary + ["zz"], k=rng.randint(0, 40))) for _ in range(2)]
        if rng.random() < 0.5:
            parts.insert(1, rng.choice(tests[:9])[1].upper())
        docs.append((k, rng.choice([", ", "\n", " "]).join(parts)))
    docs += [(60, None), (61, ""), (62, "nobody has this one but it is here"), (62, "a b c")]
    return docs, tests


@pytest.mark.parametrize("block", [dc.TEST_BYTES, 300])
@pytest.mark.parametrize("seed", [1, 2])
def test_scan_equals_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(dc, "TEST_BYTES", block)  # 300: several passes over the documents
    docs, tests = random_rows(seed)
    got = dc.scan(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3),
        spark.createDataFrame(tests, "item_id bigint, text string"),
    )
    found = sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got.collect())
    assert found == sorted((k, *plain(t, tests)) for k, t in docs)


def test_longest_match_and_its_place(spark):
    test = " ".join(f"t{i}" for i in range(40))
    text = "x y " + " ".join(f"T{i}" for i in range(5, 32)) + " z " + " ".join(f"t{i}" for i in range(12))
    got = dc.scan(
        spark.createDataFrame([(1, text), (2, "x")], "doc_id int, text string"),
        spark.createDataFrame([("q", test)], "item_id string, text string"),
    ).orderBy("doc_id").collect()
    assert (got[0].longest_words, got[0].longest_at, got[0].longest_item) == (27, 2, "q")
    assert (got[1].longest_words, got[1].longest_item) == (0, None)


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(4)
    codes = np.concatenate([rng.integers(0, 4, 500), np.zeros(10, dtype=int)]).astype(np.int64)
    array = dc.suffix_array(codes, 10)
    keys = []
    for at in array:
        key = codes[at : at + 10].tolist()
        keys.append(key[: key.index(0)] if 0 in key else key)
    assert sorted(array.tolist()) == np.flatnonzero(codes).tolist()
    assert all(a == b or a < b or a[: len(b)] == b for a, b in zip(keys, keys[1:], strict=False))


def test_digest_of_the_query(spark, sf):
    rows = op3_decontamination(spark, sf).filter("contaminated").collect()
    tests = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in rows[:10]:
        n, hit, items = plain(texts[r.doc_id], tests)
        assert (r.n_words, r.n_hit, r.n_items) == (n, hit, len(items))
        assert r.items_sha256 == hashlib.sha256(",".join(items).encode()).hexdigest()


def test_odd_rows_pass_and_clean_ones_stay(spark, odd, documents):
    tests = spark.createDataFrame([(1, "same text twice over"), (2, None)], "item_id int, text string")
    rows = dc.scan(odd, tests).collect()
    assert len(rows) == len(ROWS) and {r.doc_id for r in rows if r.n_hit} == {6, 7}
    kept = dc.remove_contaminated(documents, tests)
    assert kept.columns == documents.columns and kept.count() == len(ROWS) - 2
    assert dc.remove_contaminated(documents.limit(0), tests).count() == 0
    assert dc.remove_contaminated(documents, tests.limit(0)).count() == len(ROWS)
