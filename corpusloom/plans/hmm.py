"""Hidden Markov model queries: eight states, parameters drawn by hash."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import hmm, hmm_scan
from corpusloom.plans import sql
from corpusloom.plans.encoding import LINE_VOCAB
from corpusloom.plans.registry import query
from corpusloom.session import materialise, new_table_path

STATES = 8
KEYS = ["id", "line_no"]


def vocab(t):
    return materialise(hmm.line_vocab(t.training_lines(), KEYS), "vocab")


def model(t, seed: int = 42) -> hmm.Model:
    return hmm.init_model(vocab(t), STATES, seed)


def model_and_lines(t):
    m = model(t)
    return m, hmm.encode_lines(t.training_lines(), KEYS, m.vocab)


# The checking SQL folds over the emission vectors of a line with list functions. Vectors
# are lists of K numbers; ``acols`` is the transition matrix as a list of columns, ``a`` as a
# list of rows.


def drawn(name: str, seed: int = 42) -> str:
    """``{name}_b(token, state, p)``, ``{name}_a(i, j, p)``, ``{name}_pi(state, p)``."""
    states = f"(SELECT unnest(range({STATES})) AS state)"
    b = sql.uniform("'b'", "state", "token", seed=seed)
    a = sql.uniform("'a'", "i.state", "j.state", seed=seed)
    pi = sql.uniform("'pi'", "state", seed=seed)
    return f"""{name}_b AS MATERIALIZED (SELECT token, token_id, state, r / sum(r) OVER (PARTITION BY state) AS p
      FROM (SELECT token, token_id, state, -ln({b}) AS r FROM vocab, {states})),
    {name}_a AS MATERIALIZED (SELECT i, j, r / sum(r) OVER (PARTITION BY i) AS p
      FROM (SELECT i.state AS i, j.state AS j, -ln({a}) AS r FROM {states} i, {states} j)),
    {name}_pi AS MATERIALIZED (SELECT state, r / sum(r) OVER () AS p
      FROM (SELECT state, -ln({pi}) AS r FROM {states}))"""


MODEL = f"{LINE_VOCAB}, {drawn('m')}"

VECTORS = f"""{MODEL},
  e AS MATERIALIZED (SELECT token, list(p ORDER BY state) AS e FROM m_b GROUP BY token),
  rows AS MATERIALIZED (SELECT list(r ORDER BY i) AS a FROM
    (SELECT i, list(p ORDER BY j) AS r FROM m_a GROUP BY i)),
  cols AS MATERIALIZED (SELECT list(c ORDER BY j) AS acols FROM
    (SELECT j, list(p ORDER BY i) AS c FROM m_a GROUP BY j)),
  start AS MATERIALIZED (SELECT list(p ORDER BY state) AS pi FROM m_pi),
  line_es AS MATERIALIZED (SELECT id, line_no, list(e ORDER BY pos) AS es
    FROM vocab_tok JOIN e USING (token) GROUP BY id, line_no)"""

K = STATES


def scaled(vector: str) -> str:
    return f"list_transform([{vector}], lambda v: list_transform(v, lambda p: p / list_sum(v)))[1]"


FIRST = "list_transform(pi, lambda p, j: p * es[1][j])"
JOINT = f"list_transform(acols, lambda c, j: list_dot_product(acc[1:{K}], c) * e[j])"
BACK = "list_transform(a, lambda r: list_dot_product(r, list_transform(e, lambda p, j: p * acc[j])))"
UNIT = "[" + ", ".join([f"{1 / K}::DOUBLE"] * K) + "]"


def with_log(vector: str, rest: str) -> str:
    """The scaled vector followed by the running log-likelihood."""
    return (
        f"list_transform([{vector}], lambda v: list_concat("
        f"list_transform(v, lambda p: p / list_sum(v)), [{rest} + ln(list_sum(v))]))[1]"
    )


LOG_LIKELIHOOD = (
    f"list_reduce(es[2:], lambda acc, e: {with_log(JOINT, f'acc[{K + 1}]')},"
    f" {with_log(FIRST, '0.0::DOUBLE')})"
)


BLOCK = 64


def scan_sql(name: str, inputs: str, first: str, step: str) -> str:
    """``{name}(id, line_no, r, v)``: ``v_0 = first``, ``v_r = step(acc = v_{{r-1}}, e = inputs[r])``.

    Keeping every vector while folding copies the list at each step. So one fold keeps
    every 64th vector, and a second one starts from those and keeps all of its block.
    """
    tail = f"acc[{K + 1}:]"
    kept = f"list_concat(v, {tail}, CASE WHEN i % {BLOCK} = {BLOCK - 1} THEN v ELSE [] END)"
    return f"""{name}_bounds AS MATERIALIZED (SELECT id, line_no, ins, first,
      list_reduce(ins, lambda acc, e, i: list_transform([{step}], lambda v: {kept})[1], first) AS f
    FROM (SELECT id, line_no, {inputs} AS ins, {first} AS first
      FROM line_es, cols, start, rows), cols, rows),
  {name}_blocks AS (SELECT id, line_no, k, ins[greatest(k * {BLOCK}, 1) : k * {BLOCK} + {BLOCK - 1}] AS part,
      CASE WHEN k = 0 THEN list_concat(first, first)
        ELSE f[k * {K} + 1 : k * {K} + {K}] END AS begin
    FROM (SELECT *, unnest(range(len(ins) // {BLOCK} + 1)) AS k FROM {name}_bounds)),
  {name}_kept AS MATERIALIZED (SELECT id, line_no, k, (list_reduce(part,
      lambda acc, e: list_transform([{step}], lambda v: list_concat(v, {tail}, v))[1], begin))[{K + 1}:] AS h
    FROM {name}_blocks, cols, rows),
  {name} AS (SELECT id, line_no, k * {BLOCK} + o AS r, h[o * {K} + 1 : o * {K} + {K}] AS v
    FROM (SELECT *, unnest(range(len(h) // {K})) AS o FROM {name}_kept))"""


FORWARD = f"""{VECTORS}, folded AS (
    SELECT id, line_no, len(es) AS tokens, {LOG_LIKELIHOOD} AS f FROM line_es, cols, start)"""


def state_columns(vector: str, name: str, digits: int = 6) -> str:
    return ", ".join(f"round({vector}[{s + 1}], {digits}) AS {name}{s}" for s in range(K))


def vector_columns(vector: str, name: str):
    return [F.round(F.get(vector, F.lit(s)), 6).alias(f"{name}{s}") for s in range(K)]


@query(
    "hmm_init",
    f"WITH {MODEL} SELECT state::INT AS state, token, round(p, 9) AS p FROM m_b",
)
def hmm_init(t):
    rows = hmm.emission_rows(model(t))
    return rows.withColumn("p", F.round("p", 9))


@query(
    "hmm_forward",
    f"""WITH {FORWARD} SELECT id, line_no, tokens, round(f[{K + 1}] / tokens, 9) AS log_likelihood,
      {state_columns('f', 'alpha')} FROM folded""",
)
def hmm_forward(t):
    m, lines = model_and_lines(t)
    return hmm.forward(lines, m).select(
        *KEYS,
        "tokens",
        F.round(F.col("log_likelihood") / F.col("tokens"), 9).alias("log_likelihood"),
        *vector_columns("alpha", "alpha"),
    )


@query(
    "hmm_backward",
    f"""WITH {VECTORS}, folded AS (SELECT id, line_no,
        list_reduce(list_reverse(es[2:]), lambda acc, e: {scaled(BACK)}, {UNIT}) AS b
      FROM line_es, rows) SELECT id, line_no, {state_columns('b', 'beta')} FROM folded""",
)
def hmm_backward(t):
    m, lines = model_and_lines(t)
    return hmm.backward(lines, m).select(*KEYS, *vector_columns("beta", "beta"))


# Both directions with every vector kept, and what each position needs of the next one.
POSTERIOR = f"""{VECTORS},
  {scan_sql('fwd', 'es[2:]', scaled(FIRST), scaled(JOINT))},
  {scan_sql('bwd', 'list_reverse(es[2:])', UNIT, scaled(BACK))},
  sizes_of AS (SELECT id, line_no, len(es) AS n FROM line_es),
  steps AS MATERIALIZED (SELECT f.id, f.line_no, f.r AS pos, n, f.v AS alpha, b.v AS beta
    FROM fwd f JOIN sizes_of s ON f.id = s.id AND f.line_no = s.line_no
    JOIN bwd b ON b.id = f.id AND b.line_no = f.line_no AND b.r = n - 1 - f.r),
  gammas AS MATERIALIZED (SELECT id, line_no, pos, n,
    {scaled('list_transform(alpha, lambda x, j: x * beta[j])')} AS gamma FROM steps)"""

GAMMA_LONG = f"""gamma_long AS (SELECT id, line_no, pos, n, state, gamma[state + 1] AS g
    FROM gammas, (SELECT unnest(range({K})) AS state))"""

# alpha_i a_ij e_j beta_j divided by its sum over i and j, added up per i as K sums over j.
XI = f"""ahead AS (SELECT p.id, p.line_no, p.pos, p.alpha,
      list_transform(e.e, lambda x, j: x * nx.beta[j]) AS nxt
    FROM steps p JOIN steps nx ON nx.id = p.id AND nx.line_no = p.line_no AND nx.pos = p.pos + 1
    JOIN vocab_tok t ON t.id = p.id AND t.line_no = p.line_no AND t.pos = p.pos + 1
    JOIN e USING (token)),
  norm AS (SELECT alpha, nxt, list_sum(list_transform(a, lambda r, i: alpha[i] * list_dot_product(r, nxt))) AS z
    FROM ahead, rows),
  xi AS (SELECT i, j, p * x AS expected FROM m_a JOIN (
    SELECT i, unnest(range({K})) AS j, unnest(xs) AS x FROM (
      SELECT i, [{', '.join(f'sum(alpha[i + 1] * nxt[{j + 1}] / z)' for j in range(K))}] AS xs
      FROM norm, (SELECT unnest(range({K})) AS i) GROUP BY i)) USING (i, j))"""


@query(
    "hmm_gamma",
    f"""WITH {POSTERIOR} SELECT id, line_no, pos::INT AS pos, {state_columns('gamma', 'gamma')}
      FROM gammas""",
)
def hmm_gamma(t):
    m, lines = model_and_lines(t)
    return hmm.posterior(lines, m).select(*KEYS, "pos", *vector_columns("gamma", "gamma"))


@query(
    "hmm_xi",
    f"WITH {POSTERIOR}, {XI} SELECT i::INT AS i, j::INT AS j, round(expected, 4) AS expected FROM xi",
)
def hmm_xi(t):
    m, lines = model_and_lines(t)
    return hmm.transitions(lines, m).withColumn("expected", F.round("expected", 4))


#: Short chunks, so that the lines of the test tables have many.
CUT = 16


def scanned(t):
    m, lines = model_and_lines(t)
    return hmm_scan.scan(hmm_scan.cut_lines(lines, CUT), m)


@query(
    "hmm_forward_all",
    f"""WITH {VECTORS}, {scan_sql('fwd', 'es[2:]', scaled(FIRST), scaled(JOINT))}
      SELECT id, line_no, r AS pos, {state_columns('v', 'alpha')} FROM fwd""",
)
def hmm_forward_all(t):
    """Forward values of every position, lines cut into chunks that a tree puts together."""
    rows = hmm_scan.positions(scanned(t), STATES, CUT)
    return rows.select(*KEYS, "pos", *vector_columns("alpha", "alpha"))


@query(
    "hmm_backward_all",
    f"""WITH {VECTORS}, {scan_sql('bwd', 'list_reverse(es[2:])', UNIT, scaled(BACK))}
      SELECT b.id, b.line_no, len(es) - 1 - r AS pos, {state_columns('v', 'beta')}
      FROM bwd b JOIN line_es l ON b.id = l.id AND b.line_no = l.line_no""",
)
def hmm_backward_all(t):
    """Backward values of every position, scaled to sum to one, by the same tree."""
    rows = hmm_scan.positions(scanned(t), STATES, CUT)
    return rows.select(*KEYS, "pos", *vector_columns("beta", "beta"))


def parameter_rows(m: hmm.Model):
    """``(kind, i, j, p)`` with the emissions by token id."""
    spark = m.b.sparkSession
    k = m.states
    small = [("pi", i, 0, float(m.pi[i])) for i in range(k)]
    small += [("a", i, j, float(m.a[i, j])) for i in range(k) for j in range(k)]
    cells = F.array(
        *[F.struct(F.lit(s).cast("bigint").alias("i"), F.col(f"p{s}").alias("p")) for s in range(k)]
    )
    b = m.b.select("token_id", F.inline(cells)).select(
        F.lit("b").alias("kind"), "i", F.col("token_id").alias("j"), "p"
    )
    rows = spark.createDataFrame(small, "kind string, i bigint, j bigint, p double").union(b)
    return rows.withColumn("p", F.round("p", 8))


def parameters_sql(pi: str, a: str, b: str) -> str:
    return f"""SELECT 'pi' AS kind, state AS i, 0::BIGINT AS j, round(p, 8) AS p FROM {pi}
      UNION ALL SELECT 'a', i, j, round(p, 8) FROM {a}
      UNION ALL SELECT 'b', state, token_id, round(p, 8) FROM {b}"""


EM = f"""{POSTERIOR}, {GAMMA_LONG}, {XI},
  new_pi AS (SELECT state, s / sum(s) OVER () AS p
    FROM (SELECT state, sum(g) AS s FROM gamma_long WHERE pos = 0 GROUP BY state)),
  leaving AS (SELECT state AS i, sum(g) AS s FROM gamma_long WHERE pos < n - 1 GROUP BY state),
  new_a AS (SELECT i, j, expected / s AS p FROM xi JOIN leaving USING (i)),
  new_b AS (SELECT state, token_id, s / sum(s) OVER (PARTITION BY state) AS p
    FROM (SELECT state, token_id, sum(g) AS s
      FROM gamma_long JOIN vocab_tok USING (id, line_no, pos) JOIN vocab USING (token)
      GROUP BY state, token_id))"""


@query("hmm_em_step", f"WITH {EM} {parameters_sql('new_pi', 'new_a', 'new_b')}")
def hmm_em_step(t):
    m, lines = model_and_lines(t)
    return parameter_rows(hmm.em_step(lines, m)[0])


@query(
    "hmm_converged",
    f"""WITH {LINE_VOCAB}, {drawn('x', 42)}, {drawn('y', 43)},
      b AS (SELECT x.p AS old, y.p AS other FROM x_b x JOIN y_b y USING (token, state)),
      a AS (SELECT x.p AS old, y.p AS other FROM x_a x JOIN y_a y USING (i, j)),
      pi AS (SELECT x.p AS old, y.p AS other FROM x_pi x JOIN y_pi y USING (state)),
      tables AS (SELECT 'b' AS part, * FROM b UNION ALL SELECT 'a', * FROM a UNION ALL SELECT 'pi', * FROM pi),
      cases AS (SELECT unnest(['other', 'near', 'other a', 'other pi', 'other b']) AS against)
      SELECT against, bool_and(abs(new - old) <= 1e-8 + 1e-5 * abs(old)) AS converged
      FROM (SELECT against, old, CASE WHEN against = 'other' OR against = 'other ' || part THEN other
              WHEN against = 'near' THEN old * 1.000009 ELSE old END AS new
            FROM tables, cases) GROUP BY against""",
)
def hmm_converged(t):
    words = vocab(t)
    old, other = (hmm.init_model(words, STATES, seed) for seed in (42, 43))
    near = [(F.col(c) * 1.000009).alias(c) for c in old.emission_columns()]
    cases = {
        "other": other,
        "near": replace(
            old, pi=old.pi * 1.000009, a=old.a * 1.000009, b=old.b.select("token_id", *near)
        ),
        "other a": replace(old, a=other.a),
        "other pi": replace(old, pi=other.pi),
        "other b": replace(old, b=other.b),
    }
    rows = [
        hmm.converged_tables(new, old).select(F.lit(name).alias("against"), "converged")
        for name, new in cases.items()
    ]
    return reduce(DataFrame.unionByName, rows)


@query("hmm_train")
def hmm_train(t):
    """Trained on all lines of documents to the end: until converged, or for 50 iterations."""
    trained, _ = hmm.train(t.training_lines(), KEYS, states=STATES)
    return parameter_rows(trained)


def _saved(t):
    path = new_table_path(t.spark, "model")
    hmm.save_model(model(t), path)
    return path


@query("model_save", f"WITH {MODEL} {parameters_sql('m_pi', 'm_a', 'm_b')}")
def model_save(t):
    return parameter_rows(hmm.load_model(t.spark, _saved(t)))


@query(
    "model_load",
    f"WITH {MODEL} SELECT state::INT AS state, token, round(p, 9) AS p FROM m_b",
)
def model_load(t):
    rows = hmm.emission_rows(hmm.load_model(t.spark, _saved(t)))
    return rows.withColumn("p", F.round("p", 9))


@query(
    "normalize",
    f"""WITH {sql.LOGITS}, v AS (SELECT context, token, greatest(logit, 0) AS v FROM logits)
      SELECT context, token, round(CASE WHEN sum(v) OVER c = 0 THEN v ELSE v / sum(v) OVER c END, 9) AS p
      FROM v WINDOW c AS (PARTITION BY context)""",
)
def normalize(t):
    v = t.logits().select("context", "token", F.greatest("logit", F.lit(0.0)).alias("p"))
    return hmm.normalize(v, ["context"], "p").withColumn("p", F.round("p", 9))


TURN_RUNS = sql.runs("text", newline=False)


@query(
    "safe_emission",
    f"""WITH {MODEL}, seen AS (SELECT DISTINCT unnest({TURN_RUNS}) AS token FROM conversations)
      SELECT token, s.state::INT AS state, round(coalesce(p, 0.0::DOUBLE), 9) AS p
      FROM (SELECT * FROM seen, (SELECT unnest(range({K})) AS state)) s
      LEFT JOIN m_b USING (token, state)""",
)
def safe_emission(t):
    m = model(t)
    tokens = t.conversations().select(
        F.explode(hmm.tk.runs(F.col("text"), newline=False)).alias("token")
    )
    found = hmm.safe_emission(tokens, hmm.emission_rows(m), STATES)
    return found.withColumn("p", F.round("p", 9))


def viterbi_sql(es: str, matrix: str) -> str:
    """The K scores of the best paths through the log vectors ``es``, by last state."""
    option = f"list_transform({matrix}, lambda c: list_transform(c, lambda p, i: acc[i] + p))"
    step = (
        f"list_transform([{option}], lambda o: "
        f"list_transform(o, lambda s, j: list_max(s) + e[j]))[1]"
    )
    first = f"list_transform(lpi, lambda p, j: p + {es}[1][j])"
    return f"list_reduce({es}[2:], lambda acc, e: {step}, {first})"


LOGS = f"""log_cols AS (SELECT list(c ORDER BY j) AS lat FROM
    (SELECT j, list(round(ln(p), 12) ORDER BY i) AS c FROM m_a GROUP BY j)),
  log_rows AS (SELECT list(r ORDER BY i) AS lrows FROM
    (SELECT i, list(round(ln(p), 12) ORDER BY j) AS r FROM m_a GROUP BY i)),
  log_start AS (SELECT list(round(ln(p), 12) ORDER BY state) AS lpi FROM m_pi),
  log_es AS MATERIALIZED (SELECT id, line_no,
    list_transform(es, lambda v: list_transform(v, lambda p: round(ln(p), 12))) AS les FROM line_es)"""


def path_sql(source: str, keys: str, matrix: str) -> str:
    """Score and whole path of the lines of ``source(keys, les)``.

    The fold keeps, behind the K scores, the best state before each state of each position.
    """
    option = f"list_transform({matrix}, lambda c, j: list_transform(c, lambda p, i: acc[i] + p + e[j]))"
    step = (
        f"list_transform([{option}], lambda o: list_concat(list_transform(o, lambda s: list_max(s)),"
        f" acc[{K + 1}:], list_transform(o, lambda s: (list_position(s, list_max(s)) - 1)::DOUBLE)))[1]"
    )
    back = f"(f[{K} + (e[1] - 1) * {K} + acc[1] + 1])::BIGINT"
    steps = "list_transform(range(n - 1, 0, -1), lambda r: [r])"
    last = f"[(list_position(f[1:{K}], list_max(f[1:{K}])) - 1)::BIGINT]"
    return f"""kept AS MATERIALIZED (SELECT {keys}, len(les) AS n, list_reduce(les[2:], lambda acc, e: {step},
        list_transform(lpi, lambda p, j: p + les[1][j])) AS f
      FROM {source}, log_cols, log_rows, log_start)
      SELECT {keys}, CASE WHEN isfinite(list_max(f[1:{K}])) THEN round(list_max(f[1:{K}]) / n, 9) END AS score,
        array_to_string(list_reduce({steps}, lambda acc, e: list_prepend({back}, acc), {last}), ',') AS path
      FROM kept"""


def path_columns(found, keys):
    score = F.round(F.col("score") / F.size("path"), 9)
    return found.select(
        *keys,
        F.when(F.col("score") > float("-inf"), score).alias("score"),
        F.array_join("path", ",").alias("path"),
    )


@query(
    "hmm_viterbi",
    f"WITH {VECTORS}, {LOGS}, {path_sql('log_es', 'id, line_no', 'lat')}",
)
def hmm_viterbi(t):
    m, lines = model_and_lines(t)
    return path_columns(hmm.viterbi(lines, m), KEYS)


# Texts the vocabulary does not come from: no state emits an unseen word.
HELD_OUT = f"""held_es AS MATERIALIZED (SELECT conv_id, turn, list(coalesce(e, none) ORDER BY pos) AS es
    FROM (SELECT conv_id, turn, unnest(range(len(w))) AS pos, unnest(w) AS token
      FROM (SELECT conv_id, turn, {sql.runs('text')} AS w FROM conversations))
    LEFT JOIN e USING (token), unseen GROUP BY conv_id, turn),
  held_logs AS MATERIALIZED (SELECT conv_id, turn,
    list_transform(es, lambda v: list_transform(v, lambda p: CASE WHEN p = 0 THEN '-infinity'::DOUBLE
      ELSE round(ln(p), 12) END)) AS les FROM held_es)"""


def held_out_lines(t, m):
    turns = t.conversations().withColumnRenamed("text", "line")
    return hmm.encode_lines(turns, ["conv_id", "turn"], m.vocab)


@query(
    "hmm_viterbi_compat",
    f"""WITH {VECTORS}, {LOGS}, unseen AS (SELECT list_transform(range({K}), lambda s: 0.0::DOUBLE) AS none),
      {HELD_OUT}, {path_sql('held_logs', 'conv_id, turn', 'lrows')}""",
)
def hmm_viterbi_compat(t):
    m = model(t)
    return path_columns(hmm.viterbi(held_out_lines(t, m), m, compat=True), ["conv_id", "turn"])


@query(
    "hmm_em_step_joined",
    f"WITH {EM} {parameters_sql('new_pi', 'new_a', 'new_b')}",
)
def hmm_em_step_joined(t):
    """The step with the emissions joined to the tokens, as for a large vocabulary."""
    m, lines = model_and_lines(t)
    return parameter_rows(hmm.em_step(lines, m, limit=0)[0])


GENERATED = 256


def cumulative(values: str) -> str:
    return f"sum(p) OVER ({values} ROWS UNBOUNDED PRECEDING)"


EMISSION_AXIS = f"""axis AS MATERIALIZED (SELECT state, token, sum(p) OVER (PARTITION BY state
      ORDER BY token ROWS UNBOUNDED PRECEDING) - p AS lo FROM m_b WHERE p > 0),
  moves AS MATERIALIZED (SELECT i, list(c ORDER BY j) AS c FROM
    (SELECT i, j, {cumulative('PARTITION BY i ORDER BY j')} AS c FROM m_a) GROUP BY i)"""


def picked(cumulated: str, u: str) -> str:
    return f"least(len(list_filter({cumulated}, lambda c: c <= {u})), {K - 1})"


def emitted_sql(keys: str) -> str:
    """Tokens for ``walk(keys, pos, state)``: an as-of join on the cumulative probabilities."""
    columns = keys.split(", ")
    at = sql.uniform(*[f"k.{c}" for c in columns], "k.pos", -1)
    return f"""draws AS (SELECT {', '.join('k.' + c for c in columns)}, pos, state, {at} AS x
        FROM walk k)
      SELECT {', '.join('d.' + c for c in columns)}, d.pos::INT AS pos, d.state::INT AS state, a.token
      FROM draws d ASOF JOIN axis a ON d.state = a.state AND d.x >= a.lo"""


@query(
    "hmm_generate",
    f"""WITH RECURSIVE {MODEL}, {EMISSION_AXIS},
      begin AS (SELECT list(c ORDER BY state) AS c FROM
        (SELECT state, {cumulative('ORDER BY state')} AS c FROM m_pi)),
      walk AS (
        SELECT item_id AS id, 0 AS pos, {picked('c', sql.uniform('item_id', "'start'"))} AS state
        FROM benchmark, begin
        UNION ALL
        SELECT id, pos + 1, {picked('c', sql.uniform('id', "'move'", 'pos + 1'))}
        FROM walk JOIN moves ON i = state WHERE pos < {GENERATED - 1}),
      {emitted_sql('id')}""",
)
def hmm_generate(t):
    return hmm.generate(t.prompts().select("id"), ["id"], model(t), GENERATED)


PREDICTED = 16


@query(
    "hmm_predict",
    f"""WITH RECURSIVE {VECTORS}, {LOGS.replace('log_es AS', 'unused_log_es AS')}, {EMISSION_AXIS},
      unseen AS (SELECT list_transform(range({K}), lambda s: '-infinity'::DOUBLE) AS none),
      prompt_es AS MATERIALIZED (SELECT id, list(coalesce(list_transform(e, lambda p: round(ln(p), 12)), none)
          ORDER BY pos) AS les
        FROM (SELECT item_id AS id, unnest(range(len(w))) AS pos, unnest(w) AS token
          FROM (SELECT item_id, {sql.runs('text', newline=False)} AS w FROM benchmark))
        LEFT JOIN e USING (token), unseen GROUP BY id),
      ends AS MATERIALIZED (SELECT id, list_position(f[1:{K}], list_max(f[1:{K}])) - 1 AS state
        FROM (SELECT id, {viterbi_sql('les', 'lat')} AS f
          FROM prompt_es, log_cols, log_start)),
      walk AS (
        SELECT id, 0 AS pos, {picked('c', sql.uniform('id', "'move'", 0))} AS state
        FROM ends JOIN moves ON i = state
        UNION ALL
        SELECT id, pos + 1, {picked('c', sql.uniform('id', "'move'", 'pos + 1'))}
        FROM walk JOIN moves ON i = state WHERE pos < {PREDICTED - 1}),
      {emitted_sql('id')}""",
)
def hmm_predict(t):
    m = model(t)
    prompts = t.prompts().withColumnRenamed("text", "line")
    lines = hmm.encode_lines(prompts, ["id"], m.vocab, newline=False)
    return hmm.predict(lines, m, PREDICTED)


@query(
    "hmm_perplexity",
    f"""WITH {FORWARD} SELECT round(avg(exp(-f[{K + 1}] / tokens)), 6) AS mean_perplexity FROM folded""",
)
def hmm_perplexity(t):
    m, lines = model_and_lines(t)
    per_line = F.exp(-F.col("log_likelihood") / F.col("tokens"))
    return hmm.forward(lines, m).agg(F.round(F.avg(per_line), 6).alias("mean_perplexity"))


SMOOTH = f"""size_of AS (SELECT 1.0::DOUBLE / (count(*) + 1) AS u FROM vocab),
  unseen AS (SELECT list_transform(range({K}), lambda s: u) AS none FROM size_of)"""


@query(
    "hmm_perplexity_held_out",
    f"""WITH {VECTORS}, {SMOOTH}, {HELD_OUT.replace('coalesce(e, none)', 'coalesce(list_transform(e, lambda p: p * (1 - none[1])), none)')},
      folded AS (SELECT conv_id, turn, len(es) AS tokens, {LOG_LIKELIHOOD} AS f FROM held_es, cols, start)
      SELECT conv_id, turn, tokens, round(ln(exp(-f[{K + 1}] / tokens)), 6) AS log_perplexity FROM folded""",
)
def hmm_perplexity_held_out(t):
    m = model(t)
    smooth = hmm.with_unseen(m, 1 / (m.vocab_size + 1))
    found = hmm.forward(held_out_lines(t, m), smooth)
    return found.select(
        "conv_id",
        "turn",
        "tokens",
        F.round(-F.col("log_likelihood") / F.col("tokens"), 6).alias("log_perplexity"),
    )
