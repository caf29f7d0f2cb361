"""Toxicity of texts: weak supervision, then a linear classifier.

Many voters look at a bounded sample of labelled rows: one for each word or word beginning
that the labels single out, fixed lexicons, and patterns. A generative model of the votes
with a latent class estimates how often each voter fires in either class and, along a
tree, how voters depend on each other; its posteriors are the labels that a sparse logistic
regression on words and word beginnings is trained on. Only the regression scores texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.linear import Rows, fit_logistic, sigmoid
from corpusloom.llm.store import drawn, drop_table, sample_share, written
from corpusloom.llm.words import ALNUM, LOWER, Words, blocks, text_bytes

#: Labelled rows of each class that a model is fitted on, at most.
SAMPLE_ROWS = 4000
#: Features that a model has, at most, and those of them that vote.
FEATURES, VOTERS = 4000, 60
#: Lengths of word beginnings, in characters.
BEGINNINGS = (4, 5, 6)

#: Fixed lexicons of the voters.
LEXICONS = {
    "insults": "idiot moron stupid loser scum trash worthless pathetic disgusting clown dumb fool",
    "threats": "kill die hurt destroy shoot burn hang",
    "contempt": "hate shut ugly filthy vermin garbage coward liar disgrace",
}
#: Patterns of the voters.
PATTERNS = {
    "masked": regex.compile(r"\b[a-z]+[*@#$]{1,3}[a-z]+\b"),
    "shouting": regex.compile(r"(?:\b[A-Z]{4,}\b[^a-z]*){3}"),
    "exclaimed": regex.compile(r"!!"),
    "addressed": regex.compile(r"(?i)\byou(?:'re| are)? (?:an? |all |such )?(?:\w+ )?(?:idiot|moron|loser|fool|liar)"),
}


def features_of(word: bytes) -> list[bytes]:
    """The word and its beginnings."""
    if len(word) <= BEGINNINGS[0]:
        return [b"=" + word]
    text = word.decode()
    return [b"=" + word, *(text[:n].encode() for n in BEGINNINGS if len(text) > n)]


def document_features(table: pa.Table, text: str) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(row, feature) of a block, each once for every distinct word, and the features."""
    words = Words(*text_bytes(table[text]), ALNUM, LOWER)
    codes, distinct = words.codes()
    row = np.repeat(np.arange(table.num_rows), words.counts)
    pairs = np.unique(row * max(len(distinct), 1) + codes)
    row, code = np.divmod(pairs, max(len(distinct), 1))
    numbers: dict[bytes, int] = {}
    found = [
        [numbers.setdefault(f, len(numbers)) for f in features_of(word)] for word in distinct
    ]
    count = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    flat = np.array([n for own in found for n in own], dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    size = count[code]
    before = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(before[-1]) - np.repeat(before[:-1] - begin[code], size)
    return np.repeat(row, size), flat[at], list(numbers)


def label_sample(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int
) -> DataFrame:
    """``(text, label)`` of at most ``rows`` labelled documents of each class.

    Rows are chosen by the hash of the key, below a threshold that follows from the number
    of labels, so the same tables give the same sample and nothing is sorted for it.
    Repeated labels of a key count once (the larger), null ones not at all.
    """
    known = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max(label).alias("_label"))
    )
    sizes = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    share = F.lit(1.0)
    for value, count in sizes.items():
        share = F.when(F.col("_label") == value, sample_share(count, rows)).otherwise(share)
    chosen = known.filter(drawn(share, "_key"))
    return docs.join(F.broadcast(chosen), F.col(key) == F.col("_key")).select(
        F.coalesce(F.col(text), F.lit("")).alias("text"), F.col("_label").alias("label")
    )


def _counted(sample: DataFrame) -> DataFrame:
    """``(feature, toxic, clean)``: documents of each class that have a feature."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, "text"):
            row, feature, names = document_features(table, "text")
            row, feature = np.divmod(np.unique(row * max(len(names), 1) + feature), max(len(names), 1))
            toxic = table["label"].to_numpy()[row] == 1
            yield pa.record_batch(
                [
                    pa.array(names, type=pa.binary()),
                    pa.array(np.bincount(feature[toxic], minlength=len(names)), type=pa.int64()),
                    pa.array(np.bincount(feature[~toxic], minlength=len(names)), type=pa.int64()),
                ],
                ["feature", "toxic", "clean"],
            )

    found = sample.mapInArrow(work, "feature binary, toxic bigint, clean bigint")
    return found.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _vectors(sample: DataFrame, chosen: list[bytes]) -> pa.Table:
    """``(label, features, counts, fired)`` of each sampled row; fired: lexicons, patterns."""
    place = {name: k for k, name in enumerate(chosen)}
    lexicons = [frozenset(words.encode().split()) for words in LEXICONS.values()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, "text"):
            row, feature, names = document_features(table, "text")
            known = np.array([place.get(n, -1) for n in names], dtype=np.int64)[feature]
            found = [dict() for _ in range(table.num_rows)]
            fired = [[False] * (len(lexicons) + len(PATTERNS)) for _ in found]
            for r, k in zip(row[known >= 0].tolist(), known[known >= 0].tolist(), strict=True):
                found[r][k] = found[r].get(k, 0) + 1
            for k, words in enumerate(lexicons):
                own = np.array([n[:1] == b"=" and n[1:] in words for n in names], dtype=bool)
                for r in np.unique(row[own[feature]]).tolist():
                    fired[r][k] = True
            for r, text in enumerate(table["text"].to_pylist()):
                for k, pattern in enumerate(PATTERNS.values(), len(lexicons)):
                    fired[r][k] = pattern.search(text) is not None
            yield pa.record_batch(
                [
                    pa.array(table["label"].to_pylist(), type=pa.int64()),
                    pa.array([list(f) for f in found], type=pa.list_(pa.int64())),
                    pa.array([list(f.values()) for f in found], type=pa.list_(pa.int64())),
                    pa.array(fired, type=pa.list_(pa.bool_())),
                ],
                ["label", "features", "counts", "fired"],
            )

    schema = "label bigint, features array<bigint>, counts array<bigint>, fired array<boolean>"
    return sample.mapInArrow(work, schema).toArrow()


class LabelModel:
    """A latent class behind binary votes that depend on each other along a tree.

    ``rate[c, p, j]``: how often voter j fires in class c when its parent is silent (p = 0)
    or fires (p = 1). Expectation maximisation starts from the labels, which stay in as a
    prior of ``trust``; the tree joins the voters of the largest mutual information given
    the class, so a word and its beginnings are not counted as separate evidence.
    """

    def __init__(self, trust: float = 0.9, rounds: int = 15):
        self.trust, self.rounds = trust, rounds

    @staticmethod
    def _tree(votes: np.ndarray, post: np.ndarray) -> np.ndarray:
        n, m = votes.shape
        information = np.zeros((m, m))
        for share in (post, 1 - post):
            total = share.sum() + 1
            one = (votes * share[:, None]).sum(0) + 0.5
            both = (votes * share[:, None]).T @ votes + 0.25
            for a, b, cell in (
                (one, one, both),
                (one, total - one, one[:, None] - both + 0.25),
                (total - one, one, one[None, :] - both + 0.25),
                (total - one, total - one, total - one[:, None] - one[None, :] + both),
            ):
                cell = np.maximum(cell, 1e-9) / total
                expected = a[:, None] * b[None, :] / total**2
                information += total / (n + 2) * cell * np.log(cell / np.maximum(expected, 1e-12))
        parent, best = np.zeros(m, dtype=int), information[0].copy()
        inside = np.zeros(m, dtype=bool)
        inside[0] = True
        for _ in range(m - 1):
            nearest = int(np.argmax(np.where(inside, -np.inf, best)))
            inside[nearest] = True
            better = ~inside & (information[nearest] > best)
            parent[better], best[better] = nearest, information[nearest][better]
        return parent

    def fit(self, votes: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The posterior of the class for each row."""
        votes = votes.astype(float)
        prior = np.where(labels == 1, self.trust, 1 - self.trust)
        post = prior
        if votes.shape[1] == 0:
            return post
        self.parent = self._tree(votes, post)
        above = votes[:, self.parent].copy()
        above[:, 0] = 0
        for _ in range(self.rounds):
            self.rate = np.zeros((2, 2, votes.shape[1]))
            for c, share in enumerate((1 - post, post)):
                for p, state in enumerate((1 - above, above)):
                    mass = state * (share * weight)[:, None]
                    # A silent voter says little: the pull is towards its own overall rate.
                    overall = (votes * weight[:, None]).sum(0) / weight.sum()
                    self.rate[c, p] = ((mass * votes).sum(0) + 2 * overall) / (mass.sum(0) + 2)
            self.rate = np.clip(self.rate, 1e-6, 1 - 1e-6)
            logit = np.log(prior / (1 - prior))
            for p, state in enumerate((1 - above, above)):
                fire = np.log(self.rate[1, p] / self.rate[0, p])
                rest = np.log((1 - self.rate[1, p]) / (1 - self.rate[0, p]))
                logit = logit + (state * votes) @ fire + (state * (1 - votes)) @ rest
            post = sigmoid(logit)
        return post


@dataclass
class Model:
    weights: dict[bytes, float]
    intercept: float


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows: int = SAMPLE_ROWS,
) -> Model:
    """Fits the model on at most ``rows`` labelled rows of each class of ``labels``.

    Give only the rows that may be learnt from. Without any of one class the model knows
    nothing but the share of the classes.
    """
    sample, path = written(label_sample(docs, labels, key, text, label, rows), "toxicity-sample")
    share = labels.agg(F.avg(F.col(label).cast("double"))).first()[0]
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if share is None or len(sizes) < 2:
        drop_table(docs.sparkSession, path)
        share = min(max(share or 0.0, 1e-3), 1 - 1e-3)
        return Model({}, float(np.log(share / (1 - share))))
    n1, n0 = sizes[1], sizes[0]
    rate1, rate0 = (F.col("toxic") + 0.5) / (n1 + 1), (F.col("clean") + 0.5) / (n0 + 1)
    spread = F.sqrt(rate1 * (1 - rate1) / n1 + rate0 * (1 - rate0) / n0)
    counted = (
        _counted(sample)
        .filter(F.col("toxic") + F.col("clean") >= 3)
        .withColumn("z", (rate1 - rate0) / F.greatest(spread, F.lit(1e-9)))
        .filter(F.abs("z") > 1.6)
        .orderBy(F.desc(F.abs("z")), "feature")
        .limit(FEATURES)
        .collect()
    )
    chosen = [bytes(r["feature"]) for r in counted]
    got = _vectors(sample, chosen)
    drop_table(docs.sparkSession, path)

    rows_, columns, values = [], [], []
    for r, (own, counts) in enumerate(
        zip(got["features"].to_pylist(), got["counts"].to_pylist(), strict=True)
    ):
        rows_ += [r] * len(own)
        columns += own
        values += counts
    x = Rows(rows_, columns, values, got.num_rows, len(chosen))
    truth = got["label"].to_numpy()
    weight = np.where(truth == 1, share / n1, (1 - share) / n0)

    z = np.array([r["z"] for r in counted])
    precise = np.array([r["toxic"] / n1 > 3 * r["clean"] / n0 for r in counted], dtype=bool)
    voters = np.flatnonzero(precise & (z > 0))[:VOTERS]
    votes = np.zeros((got.num_rows, len(voters)), dtype=bool)
    column_of = np.full(len(chosen) + 1, -1)
    column_of[voters] = np.arange(len(voters))
    voting = column_of[x.column] >= 0
    votes[x.row[voting], column_of[x.column[voting]]] = True
    other = np.array(got["fired"].to_pylist(), dtype=bool).reshape(got.num_rows, -1)
    votes = np.concatenate([votes, other], axis=1)
    votes = votes[:, votes.any(0) & ~votes.all(0)]
    post = LabelModel().fit(votes, truth, weight * got.num_rows)

    w, b = fit_logistic(x, post, weight)
    kept = {name: float(v) for name, v in zip(chosen, w, strict=True) if v}
    return Model(kept, b)


def score(docs: DataFrame, model: Model, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with the probability that a text is toxic, from its whole words.

    Null and empty texts have no features and score by the intercept alone. A column of
    that name is replaced; all others, nulls and repeated rows pass through.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop(column)
    state = kept.withColumn(column, F.lit(None).cast("double"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sent.value.weights
        for table in blocks(batches, text):
            words = Words(*text_bytes(table[text]), ALNUM, LOWER)
            codes, distinct = words.codes()
            own = np.fromiter(
                (sum(weights.get(f, 0.0) for f in features_of(word)) for word in distinct),
                dtype=np.float64,
                count=len(distinct),
            )
            row = np.repeat(np.arange(table.num_rows), words.counts)
            speaks = own[codes] != 0
            pairs = np.unique(row[speaks] * max(len(distinct), 1) + codes[speaks])
            row, code = np.divmod(pairs, max(len(distinct), 1))
            total = np.bincount(row, own[code], table.num_rows) + sent.value.intercept
            index = table.schema.get_field_index(column)
            field = table.schema.field(column)
            table = table.set_column(index, field, pa.array(sigmoid(total)))
            yield from table.to_batches()

    return state.mapInArrow(work, state.schema)
