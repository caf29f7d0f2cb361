"""Hidden Markov model over token lines: Baum-Welch, Viterbi, sampling.

Lines are rows with an ``ids`` array. Emissions are a table with one row per token and
one column per state; start and transition probabilities are a few numbers per state and
stay on the driver. Within a task the recursions run as array code over batches of whole
lines; only sums leave it.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import tokens as tk
from corpusloom.functions.det import uniform, uniform_value
from corpusloom.functions.text import normalise_line
from corpusloom.operators import hmm_kernel as kernel
from corpusloom.operators.encoding import build_vocab, encode_texts
from corpusloom.operators.walks import advance, weighted_transitions, with_rests
from corpusloom.session import materialise

# The recursions travel to the tasks with the job, so executors need no installation.
cloudpickle.register_pickle_by_value(kernel)

#: Emissions up to this size go to the tasks as one array; the rest of a larger table is joined.
BROADCAST_LIMIT = 64 * 2**20
#: Tokens worked on at once; a longer line stays whole.
BATCH_TOKENS = 2**17
#: About so many tokens share one join: the more, the fewer rows are sent for tokens met again.
JOIN_TOKENS = 2**19

PI, MOVES, LEAVING, LINES, EMIT = range(5)


@dataclass
class Model:
    """``pi``: K numbers; ``a``: K x K; ``b``: rows ``(token_id, p0 … p{K-1})``."""

    pi: np.ndarray
    a: np.ndarray
    b: DataFrame
    vocab: DataFrame
    vocab_size: int
    #: probability of a token that the vocabulary does not have, in every state
    unseen: float = 0.0

    @property
    def states(self) -> int:
        return len(self.pi)

    def emission_columns(self) -> list[str]:
        return [f"p{s}" for s in range(self.states)]


def training_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Normalised lines; those with nothing left are dropped."""
    return lines.withColumn(line_col, normalise_line(F.col(line_col))).filter(
        F.col(line_col) != ""
    )


def line_vocab(lines: DataFrame, keys: list[str], line_col: str = "line") -> DataFrame:
    """Run tokens of the lines numbered by first appearance."""
    rows = tk.token_rows(lines, keys, line_col, tk.runs)
    return build_vocab(rows, [*keys, "pos"])


def encode_lines(
    lines: DataFrame,
    keys: list[str],
    vocab: DataFrame,
    line_col: str = "line",
    newline: bool = True,
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """``(keys, ids)``; a token outside the vocabulary becomes -1."""
    return encode_texts(
        lines,
        keys,
        {"ids": line_col},
        vocab,
        lambda c: tk.runs(c, newline),
        unknown_id=-1,
        broadcast_limit=limit,
    )


def init_model(
    vocab: DataFrame, states: int = 8, seed: int = 42, a=None, pi=None
) -> Model:
    """Rows drawn from Dirichlet(1, …, 1): normalised ``-ln(u)``. ``b`` is always drawn."""

    def dirichlet(*keys):
        row = np.array([-np.log(uniform_value(seed, *keys, s)) for s in range(states)])
        return row / row.sum()

    pi = dirichlet("pi") if pi is None else np.asarray(pi, dtype=float)
    a = np.array([dirichlet("a", i) for i in range(states)]) if a is None else np.asarray(a, float)
    raw = vocab.select(
        "token_id",
        *[
            (-F.log(uniform(seed, F.lit("b"), F.lit(s), "token"))).alias(f"p{s}")
            for s in range(states)
        ],
    )
    b, size = _normalise_columns(raw, states)
    return Model(pi, a, b, vocab, size)


def _normalise_columns(raw: DataFrame, states: int) -> tuple[DataFrame, int]:
    # Decimals add up alike in any order, so the model does not depend on the partitions.
    sums = [F.sum(F.col(f"p{s}").cast("decimal(28,18)")).alias(f"p{s}") for s in range(states)]
    totals = raw.agg(*sums, (F.max("token_id") + 1).alias("size")).first()
    columns = [(F.col(f"p{s}") / float(totals[f"p{s}"])).alias(f"p{s}") for s in range(states)]
    return raw.select("token_id", *columns), totals["size"]


def with_unseen(model: Model, share: float) -> Model:
    """The model with ``share`` of every state's mass for tokens it has not seen."""
    scaled = [(F.col(c) * (1 - share)).alias(c) for c in model.emission_columns()]
    return replace(model, b=model.b.select("token_id", *scaled), unseen=share)


def normalize(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """Divide ``value`` by its sum within ``key``, unless that is zero."""
    totals = df.groupBy(*key).agg(F.sum(value).alias("_total"))
    scaled = F.when(F.col("_total") == 0, F.col(value)).otherwise(F.col(value) / F.col("_total"))
    return df.join(totals, key).withColumn(value, scaled).drop("_total")


def emission_rows(model: Model) -> DataFrame:
    """Long form ``(state, token, p)``."""
    pairs = F.array(
        *[
            F.struct(F.lit(s).alias("state"), F.col(f"p{s}").alias("p"))
            for s in range(model.states)
        ]
    )
    named = model.b.join(model.vocab.select("token_id", "token"), "token_id")
    return named.select("token", F.inline(pairs)).select("state", "token", "p")


def safe_emission(tokens: DataFrame, emissions: DataFrame, states: int) -> DataFrame:
    """``(token, state, p)`` for distinct tokens; 0 for one the model has not seen."""
    wanted = tokens.select("token").distinct().withColumn(
        "state", F.explode(F.sequence(F.lit(0), F.lit(states - 1)))
    )
    return wanted.join(emissions, ["token", "state"], "left").select(
        "token", "state", F.coalesce("p", F.lit(0.0)).alias("p")
    )


# ---------------------------------------------------------------- per-line recursions


def _with_emissions(lines: DataFrame, model: Model, limit: int):
    """A table and a function that gives its batches of lines with their emission rows.

    Emissions within ``limit`` travel to the tasks as an array: all of a small table, the
    lowest ids of a larger one. Ids follow first appearance, so those are nearly all that
    is met often. Of the others only what a batch of lines needs is joined to it, each
    distinct token of the batch once, so the table never has to fit anywhere whole.
    """
    columns = model.emission_columns()
    states, unseen = model.states, model.unseen
    head = min(limit // (states * 8), model.vocab_size)
    table = np.zeros((head + 1, states))
    table[-1] = unseen
    if head:
        rows = model.b.filter(F.col("token_id") < head).select("token_id", *columns).toPandas()
        table[rows["token_id"].to_numpy()] = rows[columns].to_numpy()
    shared = lines.sparkSession.sparkContext.broadcast(table)
    if head == model.vocab_size:

        def whole(batches):
            for batch in kernel.cut_batches(batches, BATCH_TOKENS):
                # Row -1, the last one, is for unseen tokens.
                yield batch, shared.value[kernel.list_parts(batch, "ids")[1]]

        return lines, whole

    # Consecutive lines share a batch; their numbers are written, so that they stay the same
    # when a lost task runs again.
    numbered = materialise(lines.withColumn("_batch", F.monotonically_increasing_id()), "numbered")
    mean = numbered.agg(F.avg(F.size("ids"))).first()[0] or 1
    bits = max(int(np.log2(JOIN_TOKENS / max(mean, 1))), 0)
    numbered = numbered.withColumn("_batch", F.shiftright("_batch", bits))
    joined_ids = F.array_distinct(F.filter("ids", lambda i: i >= head))
    needed = numbered.select("_batch", F.explode(joined_ids).alias("token_id")).distinct()
    known = needed.join(model.b.filter(F.col("token_id") >= head), "token_id").groupBy("_batch").agg(
        F.sort_array(F.collect_list(F.struct("token_id", F.array(*columns).alias("e")))).alias("known")
    )
    packed = numbered.groupBy("_batch").agg(F.collect_list(F.struct(*lines.columns)).alias("lines"))
    joined = packed.join(known, "_batch", "left").select(
        "lines", F.col("known.token_id").alias("tokens"), F.flatten("known.e").alias("e")
    )

    def joined_batches(batches):
        for packs in batches:
            for pack in (packs.slice(i, 1) for i in range(packs.num_rows)):
                tokens, numbers = (pack.column(c).flatten() for c in (1, 2))
                every = pa.RecordBatch.from_struct_array(pack.column(0).flatten())
                for batch in kernel.cut_batches([every], BATCH_TOKENS):
                    ids = kernel.list_parts(batch, "ids")[1]
                    yield batch, kernel.looked_up(ids, shared.value, tokens, numbers)

    return joined, joined_batches


def _per_line(lines: DataFrame, model: Model, schema: str, compute, limit: int) -> DataFrame:
    """Run ``compute(layout, emissions)`` on batches and append its columns to the keys."""
    lines = lines.filter(F.size("ids") > 0)
    keys = [c for c in lines.columns if c != "ids"]
    key_schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in lines.schema if f.name in keys]
    lines, with_emissions = _with_emissions(lines, model, limit)

    def run(batches):
        for batch, emitted in with_emissions(batches):
            layout = kernel.Layout(kernel.list_parts(batch, "ids")[0])
            e = layout.scatter(emitted)
            kept = [batch.column(batch.schema.get_field_index(k)) for k in keys]
            added = compute(layout, e)
            yield pa.RecordBatch.from_arrays(kept + list(added.values()), keys + list(added))

    return lines.mapInArrow(run, ", ".join([*key_schema, schema]))


def forward(lines: DataFrame, model: Model, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``(keys, tokens, log_likelihood, alpha)``; ``alpha`` filters the last position."""
    a, pi = model.a, model.pi

    def compute(layout, e):
        alpha, scale = kernel.forward(layout, e, a, pi)
        ends = np.cumsum(layout.lengths) - 1
        last = layout.gather(alpha)[ends]
        return {
            "tokens": pa.array(layout.lengths.astype(np.int64)),
            "log_likelihood": pa.array(kernel.log_likelihood(layout, scale)),
            "alpha": kernel.list_column(np.full(len(last), len(pi)), last.ravel()),
        }

    schema = "tokens bigint, log_likelihood double, alpha array<double>"
    return _per_line(lines, model, schema, compute, limit)


def backward(lines: DataFrame, model: Model, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``(keys, beta)``: backward values at the first position, scaled to sum to one."""
    a, pi = model.a, model.pi

    def compute(layout, e):
        _, scale = kernel.forward(layout, e, a, pi)
        beta = kernel.backward(layout, e, a, scale)
        first = layout.gather(beta)[np.cumsum(layout.lengths) - layout.lengths]
        sums = first.sum(axis=1, keepdims=True)
        first = first / np.where(sums > 0, sums, 1.0)
        return {"beta": kernel.list_column(np.full(len(first), len(pi)), first.ravel())}

    return _per_line(lines, model, "beta array<double>", compute, limit)


def posterior(lines: DataFrame, model: Model, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``(keys, pos, gamma)``: state probabilities of every position."""
    a, pi, k = model.a, model.pi, model.states

    def compute(layout, e):
        alpha, scale = kernel.forward(layout, e, a, pi)
        gamma = kernel.posterior(alpha, kernel.backward(layout, e, a, scale))
        return {"flat": kernel.list_column(layout.lengths * k, layout.gather(gamma).ravel())}

    keys = [c for c in lines.columns if c != "ids"]
    per_line = _per_line(lines, model, "flat array<double>", compute, limit)
    at = F.sequence(F.lit(0), (F.size("flat") / k).cast("int") - 1)
    rows = F.transform(at, lambda t: F.slice("flat", t * k + 1, k))
    return per_line.select(*keys, F.posexplode(rows).alias("pos", "gamma"))


def transitions(lines: DataFrame, model: Model, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``(i, j, expected)``: posterior transition counts over all lines."""
    stats = e_step(lines, model, limit).filter(F.col("kind") == MOVES)
    cells = F.array(
        *[
            F.struct(F.lit(j).alias("j"), F.col(f"p{j}").alias("expected"))
            for j in range(model.states)
        ]
    )
    return stats.select(F.col("key").cast("int").alias("i"), F.inline(cells))


def viterbi(
    lines: DataFrame, model: Model, compat: bool = False, limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """``(keys, path, score)``: best state sequence and its log probability.

    ``compat`` reads the transition matrix transposed. Logarithms are rounded to twelve
    decimals, so that paths of equal probability tie alike wherever they are computed.
    """

    def log(p):
        with np.errstate(divide="ignore"):
            return np.round(np.log(p), 12)

    log_a, log_pi = log(model.a.T if compat else model.a), log(model.pi)

    def compute(layout, e):
        path, score = kernel.viterbi(layout, log(e), log_a, log_pi)
        return {"path": kernel.list_column(layout.lengths, layout.gather(path)), "score": pa.array(score)}

    return _per_line(lines, model, "path array<int>, score double", compute, limit)


# ------------------------------------------------------------------------- estimation


def e_step(lines: DataFrame, model: Model, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Expected counts ``(kind, key, p0 …)`` summed over all lines.

    A task hands on one row per distinct token of many batches and a few rows per state;
    Spark adds them up, first within each task.
    """
    full = lines.select("ids").filter(F.size("ids") > 0)
    return _sums(*_with_emissions(full, model, limit), model)


def _sums(lines: DataFrame, with_emissions, model: Model) -> DataFrame:
    a, pi, k = model.a, model.pi, model.states
    columns = model.emission_columns()

    def rows(kinds, keys, values):
        return pa.RecordBatch.from_arrays(
            [pa.array(kinds.astype(np.int32)), pa.array(keys.astype(np.int64))]
            + [pa.array(np.ascontiguousarray(values[:, s])) for s in range(k)],
            ["kind", "key", *columns],
        )

    def run(batches):
        merged = kernel.TokenSums(k)
        for batch, emitted in with_emissions(batches):
            lengths, ids = kernel.list_parts(batch, "ids")
            layout = kernel.Layout(lengths)
            gamma, moves, scale = kernel.expectations(layout, layout.scatter(emitted), a, pi)
            line_stats = np.zeros((1, k))
            line_stats[0, 0] = kernel.log_likelihood(layout, scale).sum()
            first = gamma[layout.block(0)].sum(axis=0, keepdims=True)
            last = gamma[layout.place[np.cumsum(lengths) - 1]].sum(axis=0, keepdims=True)
            leaving = gamma.sum(axis=0, keepdims=True) - last
            yield rows(
                np.repeat([PI, MOVES, LEAVING, LINES], [1, k, 1, 1]),
                np.concatenate([[0], np.arange(k), [0, 0]]),
                np.vstack([first, moves, leaving, line_stats]),
            )
            for tokens, emit in merged.add(layout.scatter(ids), gamma):
                yield rows(np.full(len(tokens), EMIT), tokens, emit)
        for tokens, emit in merged.rest():
            yield rows(np.full(len(tokens), EMIT), tokens, emit)

    schema = "kind int, key bigint, " + ", ".join(f"{c} double" for c in columns)
    partial = lines.mapInArrow(run, schema)
    return partial.groupBy("kind", "key").agg(*[F.sum(c).alias(c) for c in columns])


def em_step(
    lines: DataFrame, model: Model, limit: int = BROADCAST_LIMIT
) -> tuple[Model, float]:
    """One Baum-Welch step: the new model and the log-likelihood under the old one.

    The sums are written to the shared folder, which ends the lineage of the step.
    """
    k, columns = model.states, model.emission_columns()
    sums = materialise(e_step(lines, model, limit), "em")
    small = {
        (r["kind"], r["key"]): np.array([r[c] for c in columns])
        for r in sums.filter(F.col("kind") != EMIT).collect()
    }
    pi, a = _new_start_and_moves(small, model)
    emitted = sums.filter(F.col("kind") == EMIT).select(F.col("key").alias("token_id"), *columns)
    totals = emitted.agg(*[F.sum(c).alias(c) for c in columns]).first()
    unused = [c for c in columns if not totals[c]]
    if unused:
        old = model.b.select("token_id", *[F.col(c).alias(f"old_{c}") for c in unused])
        emitted = emitted.join(old, "token_id")
    b = emitted.select(
        "token_id",
        *[
            (F.col(f"old_{c}") if c in unused else F.col(c) / totals[c]).alias(c)
            for c in columns
        ],
    )
    return replace(model, pi=pi, a=a, b=b), float(small[LINES, 0][0])


def _new_start_and_moves(small: dict, model: Model) -> tuple[np.ndarray, np.ndarray]:
    pi = small[PI, 0]
    a = model.a.copy()
    for i in range(model.states):
        if small[LEAVING, 0][i] > 0:
            a[i] = small[MOVES, i] / small[LEAVING, 0][i]
    return pi / pi.sum() if pi.any() else pi, a


def _train_whole(lines: DataFrame, model: Model, iterations: int) -> tuple[Model, list[float]]:
    """Training while the emissions are one array: an iteration is one job.

    Every token of ``lines`` must be in the vocabulary. The array goes to the tasks, the
    sums of its tokens come back, and the test of convergence needs no job of its own.
    """
    spark, k, columns = lines.sparkSession, model.states, model.emission_columns()
    lines = lines.select("ids").filter(F.size("ids") > 0)
    table = np.zeros((model.vocab_size, k))
    drawn = model.b.select("token_id", *columns).toArrow()
    table[drawn["token_id"].to_numpy()] = np.column_stack([drawn[c].to_numpy() for c in columns])
    seen, history = drawn["token_id"].to_numpy(), []
    while len(history) < iterations:
        shared = spark.sparkContext.broadcast(table)

        def whole(batches):
            for batch in kernel.cut_batches(batches, BATCH_TOKENS):
                yield batch, shared.value[kernel.list_parts(batch, "ids")[1]]  # noqa: B023

        sums = _sums(lines, whole, model).toArrow()
        shared.unpersist()
        kind, key = sums["kind"].to_numpy(), sums["key"].to_numpy()
        values = np.column_stack([sums[c].to_numpy() for c in columns])
        few = np.flatnonzero(kind != EMIT)
        small = {(int(kind[i]), int(key[i])): values[i] for i in few}
        pi, a = _new_start_and_moves(small, model)
        seen, emitted = key[kind == EMIT], values[kind == EMIT]
        totals = emitted.sum(axis=0)
        new = np.zeros_like(table)
        new[seen] = np.where(totals > 0, emitted / np.where(totals > 0, totals, 1.0), table[seen])
        history.append(float(small[LINES, 0][0]))
        # The tolerances of close_to are those of allclose.
        near = [np.allclose(x, y) for x, y in ((a, model.a), (pi, model.pi), (new[seen], table[seen]))]
        model, table = replace(model, pi=pi, a=a), new
        if all(near):
            break
    ids = np.sort(seen)
    arrays = [pa.array(ids), *(pa.array(np.ascontiguousarray(table[ids, s])) for s in range(k))]
    found = pa.Table.from_arrays(arrays, ["token_id", *columns])
    schema = "token_id bigint, " + ", ".join(f"{c} double" for c in columns)
    return replace(model, b=materialise(spark.createDataFrame(found, schema), "em")), history


def close_to(new: Column, old: Column) -> Column:
    """The relative and absolute tolerances of the convergence test."""
    return F.abs(new - old) <= 1e-8 + 1e-5 * F.abs(old)


def converged(new: Model, old: Model) -> bool:
    """Whether every parameter is within tolerance of its old value."""
    return converged_tables(new, old).first()["converged"]


def converged_tables(new: Model, old: Model) -> DataFrame:
    """One row, ``converged``: whether start, moves and emissions all are within tolerance."""
    small = bool(np.allclose(new.a, old.a) and np.allclose(new.pi, old.pi))
    columns = new.emission_columns()
    before = old.b.select("token_id", *[F.col(c).alias(f"old_{c}") for c in columns])
    checks = [close_to(F.col(c), F.col(f"old_{c}")) for c in columns]
    return new.b.join(before, "token_id").agg(
        (F.bool_and(F.array_min(F.array(*checks))) & F.lit(small)).alias("converged")
    )


def train(
    lines: DataFrame,
    keys: list[str],
    line_col: str = "line",
    states: int = 8,
    max_iterations: int = 50,
    seed: int = 42,
    a=None,
    pi=None,
    limit: int = BROADCAST_LIMIT,
) -> tuple[Model, list[float]]:
    """Baum-Welch until converged or ``max_iterations``; also the log-likelihoods.

    Lines are tokenised and encoded once and written; each iteration is one job over
    them while the emissions fit ``limit``, and a few jobs beyond.
    """
    vocab = materialise(line_vocab(lines, keys, line_col), "vocab")
    encoded = materialise(encode_lines(lines, keys, vocab, line_col, limit=limit), "lines")
    model = init_model(vocab, states, seed, a, pi)
    history: list[float] = []
    if model.vocab_size and 8 * states * model.vocab_size <= limit:
        return _train_whole(encoded, model, max_iterations)
    while len(history) < max_iterations:
        old = model
        model, log_likelihood = em_step(encoded, old, limit)
        history.append(log_likelihood)
        if converged(model, old):
            break
    return model, history


# ----------------------------------------------------------------------------- sampling


def _state_walk(first: Column, a: np.ndarray, n: int, draw) -> Column:
    """``n`` states: ``first``, then moves by ``draw(t)`` against cumulative rows of ``a``."""
    rows = F.lit(np.cumsum(a, axis=1).tolist())
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(n - 1)) if n > 1 else F.array().cast("array<int>"),
        F.array(first),
        lambda walked, t: F.concat(
            walked, F.array(_pick(F.get(rows, F.element_at(walked, -1)), draw(t)))
        ),
    )


def _pick(cumulative: Column, u: Column) -> Column:
    passed = F.size(F.filter(cumulative, lambda c: c <= u))
    return F.least(passed, F.size(cumulative) - 1)


def _emit(states: DataFrame, keys: list[str], model: Model, seed: int) -> DataFrame:
    """One token for each ``(keys, pos, state)`` by equi-join on the emission slots."""
    table = weighted_transitions(emission_rows(model), ["state"], "token", "p")
    walkers = states.join(table.contexts, "state")
    drawn = advance(
        walkers, with_rests(table.last()), [*keys, "pos"], -1, seed, True, {"token": F.col("out")}
    )
    return drawn.select(*keys, "pos", "state", "token")


def generate(sequences: DataFrame, keys: list[str], model: Model, n: int, seed: int = 42) -> DataFrame:
    """``(keys, pos, state, token)``: ``n`` tokens per row of ``sequences``, emit then move."""
    if n < 1:
        raise ValueError("n must be at least 1")
    first = _pick(F.lit(np.cumsum(model.pi).tolist()), uniform(seed, *keys, F.lit("start")))
    walk = _state_walk(first, model.a, n, lambda t: uniform(seed, *keys, F.lit("move"), t))
    states = sequences.select(*keys, F.posexplode(walk).alias("pos", "state"))
    return _emit(states, keys, model, seed)


def predict(
    lines: DataFrame, model: Model, n: int, seed: int = 42, compat: bool = False
) -> DataFrame:
    """``(keys, pos, state, token)``: ``n`` tokens after each line, move then emit.

    ``lines`` has ``ids`` without an appended newline; the walk leaves from the last
    state of the best path.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    keys = [c for c in lines.columns if c != "ids"]
    ends = viterbi(lines, model, compat).select(*keys, F.element_at("path", -1).alias("state"))
    draws = lambda t: uniform(seed, *keys, F.lit("move"), t)
    rows = F.lit(np.cumsum(model.a, axis=1).tolist())
    first = _pick(F.get(rows, F.col("state")), draws(F.lit(0)))
    walk = _state_walk(first, model.a, n, draws)
    states = ends.select(*keys, F.posexplode(walk).alias("pos", "state"))
    return _emit(states, keys, model, seed)


# -------------------------------------------------------------------------- persistence


def save_model(model: Model, path: str) -> None:
    """Write ``pi``, ``a``, ``b`` and the vocabulary as tables under ``path``."""
    spark = model.b.sparkSession
    k = model.states
    pi = [(i, float(model.pi[i])) for i in range(k)]
    a = [(i, j, float(model.a[i, j])) for i in range(k) for j in range(k)]
    spark.createDataFrame(pi, "state int, p double").write.mode("overwrite").parquet(f"{path}/pi")
    spark.createDataFrame(a, "i int, j int, p double").write.mode("overwrite").parquet(f"{path}/a")
    model.b.write.mode("overwrite").parquet(f"{path}/b")
    model.vocab.select("token", "token_id").write.mode("overwrite").parquet(f"{path}/vocab")


def load_model(spark: SparkSession, path: str) -> Model:
    pi = {r["state"]: r["p"] for r in spark.read.parquet(f"{path}/pi").collect()}
    k = len(pi)
    a = np.zeros((k, k))
    for r in spark.read.parquet(f"{path}/a").collect():
        a[r["i"], r["j"]] = r["p"]
    b = spark.read.parquet(f"{path}/b")
    size = b.agg(F.max("token_id") + 1).first()[0]
    vocab = spark.read.parquet(f"{path}/vocab")
    return Model(np.array([pi[s] for s in range(k)]), a, b, vocab, size)
