"""Trained operators: toxicity, quality, licences; and the linear model below them."""

import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import licenses, quality_model, toxicity
from corpusloom.llm.linear import Rows, fit_logistic, sigmoid
from corpusloom.llm.queries import op1_licenses, op5_quality, op9_toxicity
from tests.llm.conftest import ROWS


def held_out_accuracy(spark, query, label, folder):
    rows = query(spark, folder)
    assert rows.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert rows.count() == docs.count()
    assert rows.filter("score < 0 or score > 1 or predicted <> int(score >= 0.5)").count() == 0
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = rows.join(labels, "doc_id").filter("held_out")
    return held.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]


def test_toxicity_on_held_out_rows(spark, sf):
    assert held_out_accuracy(spark, op9_toxicity, "toxic", sf) > 0.93


def test_quality_on_held_out_rows(spark, sf):
    assert held_out_accuracy(spark, op5_quality, "quality", sf) > 0.97


def test_held_out_rows_are_those_of_the_hash(spark, sf):
    import zlib

    for query, parts, part in ((op9_toxicity, 5, 0), (op5_quality, 3, 1)):
        for r in query(spark, sf).limit(50).collect():
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == part)


@pytest.mark.parametrize("module", [toxicity, quality_model])
def test_models_on_odd_rows_and_without_labels(spark, odd, module):
    label = "toxic" if module is toxicity else "quality"
    labels = spark.createDataFrame(
        [(1, 0), (5, 1), (6, 0), (6, 0), (8, 1), (99, 1), (None, 1), (9, None)], f"doc_id bigint, {label} int"
    )
    for known in (labels, labels.filter(f"{label} = 1"), labels.limit(0)):
        model = module.train(odd, known)
        rows = module.score(odd, model).collect()
        assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
        assert rows[0].key == "x"
    assert module.score(odd.limit(0), model).count() == 0


def test_training_does_not_depend_on_how_rows_are_dealt(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    one = quality_model.train(docs.repartition(7), labels).weights
    assert np.allclose(one, quality_model.train(docs.coalesce(1), labels).weights)


def test_logistic_regression_finds_the_signal():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 5))
    truth = np.array([2.0, -1.0, 0.0, 0.0, 0.5])
    y = (rng.random(4000) < sigmoid(x @ truth - 0.3)).astype(float)
    row, column = np.divmod(np.arange(20000), 5)
    w, b = fit_logistic(Rows(row, column, x.ravel(), 4000, 5), y, l1=1e-5, l2=1e-5)
    assert np.allclose(w, truth, atol=0.2) and abs(b + 0.3) < 0.15


def test_preferences_are_those_of_the_better_rows():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 3))
    strength = x @ [1.5, 0.0, -1.0]
    a, b = x[:1500], x[1500:]
    wins = rng.random(1500) < sigmoid(strength[:1500] - strength[1500:])
    w = quality_model.fit_preferences(np.where(wins[:, None], a, b), np.where(wins[:, None], b, a))
    assert np.allclose(w, [1.5, 0, -1.0], atol=0.25)


def test_label_model_discounts_voters_that_copy_each_other():
    rng = np.random.default_rng(2)
    n = 4000
    truth = rng.random(n) < 0.4
    good = np.stack([rng.random(n) < np.where(truth, 0.7, 0.05) for _ in range(3)], axis=1)
    noise = rng.random(n) < np.where(truth, 0.3, 0.2)
    votes = np.concatenate([good, np.stack([noise] * 6, axis=1)], axis=1)
    model = toxicity.LabelModel(trust=0.6)
    post = model.fit(votes, truth.astype(int), np.ones(n))
    copies = [j for j in range(3, 9) if model.parent[j] in range(3, 9)]
    assert len(copies) >= 5  # a copied vote hangs on the one it copies
    silent = ~good.any(1) & noise
    assert post[silent].mean() < 0.5 < post[good.sum(1) >= 2].mean()


NOTICES = {
    "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    "Some prose before it. Released under the MIT License.": "mit",
    "this work is LICENSED under the GNU general public license, version 3": "gpl-3.0",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "Licensed under CC BY 4.0.": "cc-by",
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met:": "bsd",
    "The driver's license was issued under the old version of the rules.": None,
    "He was granted permission to use the public library.": None,
    "Of the software and the work under which this is.": None,
}


def test_licence_families(spark, odd):
    prose = ["The quick brown fox jumps over the lazy dog in the public garden."] * 3
    prose += ["A general of the army was free to use any means.", "Work of this version is under review."]
    model = licenses.fit(prose)
    rows = [(k, f"First line.\n{text}\nLast é line.") for k, text in enumerate(NOTICES)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string"), model)
    for r in got.collect():
        text, want = list(NOTICES.items())[r.doc_id]
        assert [x.family for x in r.licenses] == ([want] if want else []), text
        for x in r.licenses:
            assert r.text[x.start : x.end] == text and x.line == 1 and x.similarity >= 0.6
    assert licenses.scan(odd, model).count() == len(ROWS)
    assert licenses.scan(odd.limit(0), model).count() == 0
    assert licenses.train(odd.limit(0)).temperature > 0


def test_wrapped_and_neighbouring_notices(spark):
    prose = ["The quick brown fox jumps over the lazy dog in the public garden."] * 3
    model = licenses.fit(prose)
    rows, want = [], []
    for family, notices in licenses.TEMPLATES.items():
        for notice in notices:
            for sign in ("", "# ", " * ", "// "):
                lines = [sign + line for line in textwrap.wrap(notice, 72)]
                rows.append("\n".join(["Prose é of a kind.", *lines, "The end of it."]))
                want.append([family])
    rows.append("Licensed under the MIT license. Licensed under the BSD 3-Clause License.")
    want.append(["mit", "bsd"])
    rows.append("Permission is hereby granted, free of charge, to any person\n\nobtaining a dog.")
    want.append([])
    got = licenses.scan(spark.createDataFrame(list(enumerate(rows)), "k int, text string"), model)
    for r in got.collect():
        # A line of a long notice may be a notice by itself.
        assert sorted({x.family for x in r.licenses}) == sorted(want[r.k]), r.text
        for x in r.licenses:
            assert r.text[: x.start].count("\n") == x.line
            assert r.text[x.start - 1 : x.start] in ("", "\n", " ") and x.end <= len(r.text)
    mit = next(r for r in got.collect() if "Permission is hereby" in r.text and "# " in r.text)
    assert [(x.line, r.text[x.end :]) for r in [mit] for x in r.licenses] == [(1, "\nThe end of it.")]


def test_licence_query_finds_all_notices_of_the_table(spark, sf):
    known = {
        "GNU General Public License, version 3": "gpl-3.0", "MIT License": "mit",
        "CC BY-NC 4.0": "cc-by-nc", "Apache License, Version 2.0": "apache-2.0",
        "All rights reserved": "proprietary",
    }
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op1_licenses(spark, sf).collect():
        want = ",".join(sorted(name for part, name in known.items() if part in texts[r.doc_id]))
        assert r.families == want


def test_quality_is_fitted_on_every_labelled_row(spark):
    # Far more rows of a class than any sample would hold; one rare kind settles the mean.
    n = 10000
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("some plain words "), "id"))
        .otherwise(F.concat(F.lit("a|b|c ### "), "id"))
        .alias("text"),
    )
    labels = docs.select("doc_id", (F.col("doc_id") % 2 == 0).cast("int").alias("quality"))
    model = quality_model.train(docs, labels)
    x = quality_model.measures(docs.toArrow()["text"])
    assert np.allclose(model.mean, x.mean(0), rtol=1e-12, atol=1e-12)
    strength = np.sort(model.strength(x))
    assert model.threshold == pytest.approx(strength[n // 2 - 1 : n // 2 + 1].mean())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "0")
    try:
        assert np.allclose(quality_model.train(docs, labels).weights, model.weights)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
