import random
import re

import pytest

from corpusloom.llm import repeats

BLANKS = re.compile(r"[^\x20\x09-\x0d]+")


def brute(rows, window):
    """(key, text) rows to (key, n_words, n_removed, kept): every window looked up."""
    first, texts = {}, []
    for key, text in rows:
        words = BLANKS.findall(text or "")
        texts.append((key, words))
        for i in range(len(words) - window + 1):
            place = (key is None, key or 0, i)
            run = tuple(words[i : i + window])
            first[run] = min(first.get(run, place), place)
    out = []
    for key, words in texts:
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] != (key is None, key or 0, i):
                gone.update(range(i, i + window))
        out.append((key, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out, key=str)


def check(spark, rows, window=20, anchor=8, parts=3):
    table = spark.createDataFrame(
        [(k, t, *"abcdefg") for k, t in rows],
        "doc_id bigint, text string, key string, body string, spans string, start string, "
        "source string, _key string, n_words string",
    )
    done = repeats.drop_repeats(table.repartition(parts), window=window, anchor=anchor)
    found = done.collect()
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in found), key=str)
    assert got == brute(rows, window)
    assert {(r.key, r.body, r.spans, r.start, r.source) for r in found} <= {tuple("abcde")}
    words = {}
    for k, t in rows:
        words.setdefault(k, []).append(BLANKS.findall(t or ""))
    for r in found:
        for s in r.repeats:
            # The words do stand at the source the span names, which is earlier.
            assert (s.source is None, s.source or 0, s.source_start) < (r.doc_id is None, r.doc_id or 0, s.start)
            own = [w[s.start : s.start + s.words] for w in words[r.doc_id]]
            there = [w[s.source_start : s.source_start + s.words] for w in words[s.source]]
            assert s.words >= window and any(a in there for a in own)
    return found


@pytest.mark.parametrize("batch", [3, 10_000])
def test_equals_every_window_looked_up(spark, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rng = random.Random(batch)
        rows = []
        for k in range(60):
            words = [rng.choice("abc") for _ in range(rng.randrange(0, 40))]
            if rows and rng.random() < 0.5:
                words += BLANKS.findall(rng.choice(rows)[1])[rng.randrange(5) :]
            rows.append((k, " ".join(words)))
        check(spark, rows, window=5, anchor=2)
        check(spark, rows, window=5, anchor=5)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_passages_copies_and_edits(spark):
    rng = random.Random(2)

    def prose(n):
        return [f"w{rng.randrange(4000)}" for _ in range(n)]

    passage, base = prose(60), prose(300)
    rows = [(100 + k, " ".join(prose(30) + passage + prose(rng.randrange(40)))) for k in range(30)]
    for k in range(30):
        words = list(base)
        words[rng.randrange(300)] = "changed"
        rows.append((k, " \n".join(words)))
    rows += [(200 + k, " ".join(base[k : k + 25])) for k in range(5)]
    found = check(spark, rows)
    gone = sum(r.n_removed for r in found)
    assert gone > 30 * 250 + 29 * 60
    longest = max(s.words for r in found for s in r.repeats)
    assert longest > 100  # paths are joined along their source


def test_odd_rows(spark):
    long = "word " * 3000 + " ".join(f"x{i}" for i in range(60_000))
    copy = " ".join(f"y{i}" for i in range(50))
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b "), (4, copy), (5, long), (6, long), (None, copy), (None, "z " + copy),
        (7, copy), (7, copy), (8, "a " + copy), (8, copy + " b"), (9, " é " * 30), (10, "short text"), (11, "short text"),
    ]
    check(spark, rows)


def test_empty_table(spark):
    table = spark.createDataFrame([], "doc_id string, text string")
    done = repeats.drop_repeats(table)
    assert done.collect() == []
    assert done.columns == ["doc_id", "text", "n_words", "n_removed", "repeats"]


def test_string_keys_order_as_spark_does(spark):
    text = " ".join(f"q{i}" for i in range(25))
    table = spark.createDataFrame([("b", text), ("a", text), ("é", text)], "doc_id string, text string")
    left = {r.doc_id: r.n_removed for r in repeats.drop_repeats(table).collect()}
    assert left == {"a": 0, "b": 25, "é": 25}
