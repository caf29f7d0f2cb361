"""Licence notices in texts: a trained classifier of paragraphs, confirmed by templates.

A paragraph is a line, a sentence of a line that names several families, or a run of
neighbouring lines that are dense in word pairs of the templates: a notice that is wrapped,
with comment signs or without. Its features are the word n-grams, up to three words, that occur in
the templates of any family; the trained softmax regression over the families and an
unknown class sees nothing else, so prose has next to no features. Its probabilities are
calibrated by a temperature on held-out rows. A paragraph predicted as a family is reported
only if it shares enough of a template of that family.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.store import drawn, sample_share
from corpusloom.llm.words import ALNUM, LOWER, Words, blocks, text_bytes

#: Public notices of the families, as projects quote them.
TEMPLATES: dict[str, list[str]] = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at",
        "SPDX-License-Identifier: Apache-2.0",
        "Released under the Apache 2.0 license.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation; either version 2 of "
        "the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the "
        "GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "agpl-3.0": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work.",
        "Released under CC0 1.0 Universal public domain dedication.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies.",
        "Released under the ISC License.",
    ],
    "proprietary": [
        "All rights reserved.",
        "This document is confidential and proprietary and may not be reproduced or distributed "
        "without the prior written permission of the owner.",
    ],
}

FAMILIES = list(TEMPLATES)
UNKNOWN = len(FAMILIES)
GRAMS = 3
#: Paragraphs of the corpus that stand for the unknown class in training, at most, and
#: variants that are made of each template.
NEGATIVES, VARIANTS = 4000, 40
#: A family is predicted at this probability, and confirmed at this share of a template.
PROBABILITY, SIMILARITY = 0.5, 0.6
#: Word pairs of templates for each word of a line from which it is dense, and the words of a
#: run of lines that are judged together, at most, for each word of the longest template.
DENSE, LONGEST = 0.4, 1.5


def words_in(text: str) -> list[bytes]:
    data, begins = text_bytes(pa.array([text]))
    found = Words(data, begins, ALNUM, LOWER)
    return [found.data[a:b].tobytes() for a, b in zip(found.starts, found.ends, strict=True)]


def grams(words: list[bytes]) -> set[bytes]:
    return {
        b" ".join(words[i : i + n]) for n in range(1, GRAMS + 1) for i in range(len(words) - n + 1)
    }


def pairs(words: list[bytes]) -> set[bytes]:
    return {b" ".join(words[i : i + 2]) for i in range(len(words) - 1)}


@dataclass
class Model:
    column: dict[bytes, int]
    weights: np.ndarray  # features by classes
    bias: np.ndarray
    temperature: float
    words: frozenset
    templates: list[tuple[int, frozenset]]

    def probabilities(self, features: list[int]) -> np.ndarray:
        logit = (self.weights[features].sum(0) + self.bias) / self.temperature
        raised = np.exp(logit - logit.max())
        return raised / raised.sum()

    def similarity(self, family: int, words: list[bytes]) -> float:
        """Largest share of a template's word pairs that the paragraph has."""
        own = pairs(words)
        return max(len(own & t) / len(t) for f, t in self.templates if f == family)

    def judge(self, words: list[bytes]) -> tuple[int, float, float]:
        """Family (or unknown), its probability, and how much of a template confirms it."""
        features = [self.column[g] for g in grams(words) if g in self.column]
        p = self.probabilities(features)
        best = int(np.argmax(p))
        if best == UNKNOWN or p[best] < PROBABILITY:
            return UNKNOWN, float(p[UNKNOWN]), 0.0
        share = self.similarity(best, words)
        return (best if share >= SIMILARITY else UNKNOWN), float(p[best]), share


def _variants(rng, words: list[bytes], prose: list[list[bytes]]) -> list[bytes]:
    """A template as it may turn up: cut, with lost words, inside other text."""
    out = [w for w in words if rng.random() > 0.05]
    if len(out) > 14 and rng.random() < 0.5:
        start = rng.integers(0, len(out) - 12)
        out = out[start : start + rng.integers(12, len(out) - start + 1)]
    if prose and rng.random() < 0.5:
        other = prose[rng.integers(len(prose))][:40]
        cut = rng.integers(0, len(other) + 1)
        out = [*other[:cut], *out, *other[cut:]]
    return out


def fit(prose: list[str], rounds: int = 300) -> Model:
    """Trains on variants of the templates against paragraphs of ordinary text.

    Paragraphs that hold most of a template are not ordinary and are left out.
    """
    rng = np.random.default_rng(11)
    templates = [(f, words_in(t)) for f, name in enumerate(FAMILIES) for t in TEMPLATES[name]]
    known = [(f, frozenset(pairs(w))) for f, w in templates]
    column = {g: k for k, g in enumerate(sorted(set().union(*(grams(w) for _, w in templates))))}
    plain = [w for w in map(words_in, prose) if not any(len(pairs(w) & t) >= 0.5 * len(t) for _, t in known)]
    rows = [(UNKNOWN, w) for w in plain]
    rows += [(f, _variants(rng, w, plain)) for f, w in templates for _ in range(VARIANTS)]
    rows += [(f, w) for f, w in templates]
    # Parts that several families share tell nothing by themselves.
    every = [w for _, w in templates]
    for _ in range(VARIANTS * 4):
        words = every[rng.integers(len(every))]
        start = rng.integers(0, len(words))
        rows.append((UNKNOWN, words[start : start + 2]))
    x = np.zeros((len(rows), len(column)), dtype=np.float32)
    for r, (_, words) in enumerate(rows):
        x[r, [column[g] for g in grams(words) if g in column]] = 1
    y = np.array([f for f, _ in rows])
    held = np.arange(len(rows)) % 5 == 0
    truth = np.eye(UNKNOWN + 1, dtype=np.float32)[y]
    weight = (1 / np.bincount(y[~held], minlength=UNKNOWN + 1).clip(1))[y] ** 0.5
    weight = (weight / weight[~held].sum()).astype(np.float32)[:, None]
    w = np.zeros((len(column), UNKNOWN + 1), dtype=np.float32)
    b = np.zeros(UNKNOWN + 1, dtype=np.float32)
    seen, step = x[~held], np.float32(4.0)
    for _ in range(rounds):
        logit = seen @ w + b
        p = np.exp(logit - logit.max(1, keepdims=True))
        error = (p / p.sum(1, keepdims=True) - truth[~held]) * weight[~held]
        moved = w - step * (seen.T @ error)
        w = np.sign(moved) * np.maximum(np.abs(moved) - step * np.float32(2e-5), 0)
        b = b - step * error.sum(0)
    logit = x[held] @ w + b

    def loss(temperature: float) -> float:
        scaled = logit / temperature
        scaled = scaled - scaled.max(1, keepdims=True)
        log_p = scaled - np.log(np.exp(scaled).sum(1, keepdims=True))
        return float(-log_p[np.arange(len(log_p)), y[held]].mean())

    temperature = min(np.geomspace(0.1, 10, 41), key=loss)
    vocabulary = frozenset(word for words in every for word in words)
    return Model(column, w, b, float(temperature), vocabulary, known)


def train(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Fits on a bounded sample of the corpus's own paragraphs: one line, of at most 400
    characters, from each of ``NEGATIVES`` documents at most, chosen by the hash of the key.
    Equal lines count once, so repeated rows do not swell the sample."""
    share = sample_share(docs.count(), NEGATIVES)
    line = F.element_at(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), 1)
    chosen = docs.filter(drawn(share, key)).select(F.substring(line, 1, 400).alias("line")).distinct()
    return fit(sorted(r["line"] for r in chosen.collect()))


SPAN = "array<struct<family:string,line:int,start:int,end:int,probability:double,similarity:double>>"


class _Paragraphs:
    """Lines of a block of texts, what a model judges of them, and which are dense."""

    def __init__(self, known: Model, data: np.ndarray, begins: np.ndarray):
        self.known, self.data = known, data
        words = self.words = Words(data, begins, ALNUM, LOWER)
        self.codes, self.distinct = words.codes()
        lined = np.ones(256, dtype=bool)
        lined[10] = False
        lines = self.lines = Words(data, begins, lined)
        self.row = np.repeat(np.arange(len(begins) - 1), lines.counts)
        self.first = np.searchsorted(words.starts, lines.starts)
        self.last = np.searchsorted(words.starts, lines.ends)
        place = {word: i for i, word in enumerate(sorted(known.words))}
        told = np.array([place.get(w, -1) for w in self.distinct], dtype=np.int64)[self.codes]
        self.told = np.concatenate([[0], np.cumsum(told >= 0)])
        every = [pair.split(b" ") for _, template in known.templates for pair in template]
        wanted = np.unique([place[a] * len(place) + place[b] for a, b in every])
        hit = np.zeros(len(told) + 1, dtype=bool)
        if len(told) > 1:
            hit[:-2] = np.isin(told[:-1] * len(place) + told[1:], wanted)
            hit[:-2] &= (told[:-1] >= 0) & (told[1:] >= 0)
        ends = words.first[1:] - 1
        hit[ends[ends >= 0]] = False
        before = np.concatenate([[0], np.cumsum(hit)])
        entered = hit[self.first - 1] & (self.first > 0)
        hits = before[self.last] - before[self.first] + entered
        self.dense = (hits > 0) & (hits >= DENSE * (self.last - self.first))
        self.longest = LONGEST * max(len(template) + 1 for _, template in known.templates)

    def judge(self, first: int, last: int) -> tuple[int, float, float]:
        return self.known.judge([self.distinct[c] for c in self.codes[first:last]])

    def sentences(self, line: int) -> list[tuple]:
        """Notices in sentences of a line, if they are of several families."""
        start, end = int(self.lines.starts[line]), int(self.lines.ends[line])
        part = self.data[start:end]
        stops = np.flatnonzero((part[:-1] == ord(".")) & (part[1:] == ord(" "))) + 1
        found = []
        for a, b in zip([0, *(stops + 1).tolist()], [*stops.tolist(), end - start], strict=True):
            first, last = np.searchsorted(self.words.starts, [start + a, start + b])
            if self.told[last] - self.told[first] >= 2:
                family, *shares = self.judge(first, last)
                if family != UNKNOWN:
                    found.append((line, start + a, start + b, family, *shares))
        return found if len({x[3] for x in found}) > 1 else []

    def wrapped(self, lines: list[int]) -> list[tuple]:
        """Notices that go over several of a run of neighbouring dense lines.

        From each line on, the run of lines that shares most of a template is taken, the
        shortest of equal ones; the next one begins behind it.
        """
        found, k = [], 0
        while k < len(lines) - 1:
            best = None
            for j in range(k + 1, len(lines)):
                first, last = self.first[lines[k]], self.last[lines[j]]
                if last - first > self.longest:
                    break
                family, probability, share = self.judge(first, last)
                if family != UNKNOWN and (best is None or share > best[0]):
                    best = share, j, family, probability
            if best is None:
                k += 1
                continue
            share, j, family, probability = best
            span = int(self.lines.starts[lines[k]]), int(self.lines.ends[lines[j]])
            found.append((lines[k], *span, family, probability, share))
            k = j + 1
        return found

    def notices(self) -> list[tuple]:
        """``(line, start, end, family, probability, similarity)`` in bytes, in order."""
        found, open_lines = [], self.dense.copy()
        for k in np.flatnonzero(self.told[self.last] - self.told[self.first] >= 2).tolist():
            family, *shares = self.judge(self.first[k], self.last[k])
            whole = [(k, int(self.lines.starts[k]), int(self.lines.ends[k]), family, *shares)]
            own = self.sentences(k) if family != UNKNOWN or self.dense[k] else []
            own = own or (whole if family != UNKNOWN else [])
            found += own
            open_lines[k] &= not own
        rest = np.flatnonzero(open_lines)
        near = np.diff(rest) == 1
        near &= self.row[rest[1:]] == self.row[rest[:-1]]
        near &= self.lines.starts[rest[1:]] - self.lines.ends[rest[:-1]] == 1
        for run in np.split(rest, np.flatnonzero(~near) + 1):
            found += self.wrapped(run.tolist())
        return sorted(found, key=lambda x: x[1])


def scan(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``licenses``: the notices in each whole text, in order.

    A notice has its family, first line (from 0), place in code points (end exclusive),
    calibrated probability and share of the best template. It is a line; or the sentences of a
    line that are of several families; or neighbouring lines, without a blank one between,
    none of which is a notice by itself. A null or empty text has none, and so has a line
    without words of the templates; what is judged unknown or confirmed by no template is
    not reported. Of templates that share equally the first counts, and of runs of lines the
    shortest. Very long texts cost time in proportion to their length. Rows, other columns,
    nulls and repeats come back as they are; a column ``licenses`` is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    state = docs.drop("licenses").withColumn("licenses", F.lit(None).cast(SPAN))
    index = len(state.columns) - 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, text):
            data, begins = text_bytes(table[text])
            paragraphs = _Paragraphs(sent.value, data, begins)
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            breaks = np.concatenate([[0], np.cumsum(data == 10)])
            out: list[list] = [[] for _ in range(table.num_rows)]
            for line, start, end, family, probability, share in paragraphs.notices():
                row = paragraphs.row[line]
                begin = begins[row]
                out[row].append(
                    {
                        "family": FAMILIES[family],
                        "line": int(breaks[start] - breaks[begin]),
                        "start": int(points[start] - points[begin]),
                        "end": int(points[end] - points[begin]),
                        "probability": probability,
                        "similarity": share,
                    }
                )
            field = table.schema.field(index)
            table = table.set_column(index, field, pa.array(out, type=field.type))
            yield from table.to_batches()

    return state.mapInArrow(work, state.schema)
