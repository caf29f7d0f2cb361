"""Markov chain and decoding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.functions import tokens as tk
from corpusloom.operators import decoding as de
from corpusloom.operators import markov as mk
from corpusloom.operators import metrics as me
from corpusloom.operators.encoding import encode_texts
from corpusloom.plans import sql
from corpusloom.plans.encoding import PIECE_VOCAB, STARTS, encoded_sql, piece_vocab
from corpusloom.plans.registry import query
from corpusloom.session import materialise

DOC1 = sql.chain1("documents", "text")
DOC2 = sql.chain2("documents", "text")


@query("start_words", f"WITH {STARTS} SELECT word FROM starts")
def start_words(t):
    return mk.start_words(t.documents(), "content")


@query("markov1", f"WITH {DOC1} SELECT w1, nxt, n FROM c1")
def markov1(t):
    return mk.markov1(t.documents(), "content")


@query("markov2", f"WITH {DOC2} SELECT w1, w2, nxt, n FROM c2")
def markov2(t):
    return mk.markov2(t.documents(), "content")


@query(
    "to_probability",
    f"WITH {DOC1} SELECT w1, nxt, n, total::BIGINT AS total, q / 1000.0 AS prob FROM p1",
)
def to_probability(t):
    return mk.with_probability(mk.markov1(t.documents(), "content"), ["w1"]).drop("is_top")


@query(
    "markov_argmax",
    f"""WITH {DOC2} SELECT w1, w2, nxt, n, total::BIGINT AS total, q / 1000.0 AS prob
      FROM p2 WHERE place = 1""",
)
def markov_argmax(t):
    key = ["w1", "w2"]
    return mk.markov_argmax(
        mk.with_probability(mk.markov2(t.documents(), "content"), key), key
    )


@query(
    "markov_argmax_one",
    f"""WITH {DOC2} SELECT w1, w2, arg_min(nxt, (u, nxt)) AS nxt
      FROM (SELECT *, {sql.uniform('w1', 'w2', 'nxt')} AS u FROM p2 WHERE place = 1)
      GROUP BY w1, w2""",
)
def markov_argmax_one(t):
    return mk.pick_one(markov_argmax(t), ["w1", "w2"])


@query(
    "markov_pick",
    f"""WITH {DOC1} SELECT w1, arg_min(nxt, (u, nxt)) AS nxt
      FROM (SELECT *, {sql.uniform('w1', 'nxt')} AS u FROM c1) GROUP BY w1""",
)
def markov_pick(t):
    return mk.pick_one(mk.markov1(t.documents(), "content"), ["w1"])


# Generation reads the lines, not the whole texts, as verses: long texts rarely end
# within the step limit.
LINE_CHAINS = f"""{sql.LINES}, {sql.chain1('lines', 'line')},
  {sql.chain2('lines', 'line').replace('w AS (', 'w_again AS (', 1)},
  e1 AS MATERIALIZED (SELECT w1, nxt, row_number() OVER (ORDER BY w1, nxt) - 1 AS slot FROM c1),
  s1 AS MATERIALIZED (SELECT w1, min(slot) AS start, count(*) AS m FROM e1 GROUP BY w1),
  e2 AS MATERIALIZED (SELECT w1, w2, nxt, row_number() OVER (ORDER BY w1, w2, nxt) - 1 AS slot
    FROM p2 WHERE place = 1),
  s2 AS MATERIALIZED (SELECT w1, w2, min(slot) AS start, count(*) AS m FROM e2 GROUP BY w1, w2),
  line_starts AS MATERIALIZED (SELECT DISTINCT w[1] AS word FROM w WHERE len(w) > 0)"""


def walk_sql(starts: str, keys: str) -> str:
    """Lines written from ``starts(keys, word)``, one recursion per word."""
    columns = keys.split(", ")
    joined = ", ".join(f"k.{c}" for c in columns)
    own = [f"k.{c}" for c in columns]
    pick1 = f"s1.start + floor({sql.uniform(*own, 0)} * s1.m)::BIGINT"
    pick2 = f"s2.start + floor({sql.uniform(*own, 'k.step + 1')} * s2.m)::BIGINT"
    return f"""walk AS (
      SELECT {joined}, 0 AS step, [k.word, e1.nxt] AS words, k.word AS w1, e1.nxt AS w2, false AS done
      FROM {starts} k JOIN s1 ON s1.w1 = k.word JOIN e1 ON e1.slot = {pick1}
      UNION ALL
      SELECT {joined}, k.step + 1, CASE WHEN e2.nxt = 'endl' THEN k.words
          ELSE list_append(k.words, e2.nxt) END, k.w2, e2.nxt, e2.nxt = 'endl'
      FROM walk k JOIN s2 ON s2.w1 = k.w1 AND s2.w2 = k.w2 JOIN e2 ON e2.slot = {pick2}
      WHERE NOT k.done AND k.step < 8),
    written AS (SELECT {keys}, array_to_string(words, ' ') AS line FROM walk WHERE done)"""


def _writer(t):
    return mk.TextLineWriter(t.lines(), "line")


@query(
    "write_line",
    f"WITH RECURSIVE {LINE_CHAINS}, {walk_sql('line_starts', 'word')} SELECT word, line FROM written",
)
def write_line(t):
    writer = _writer(t)
    return writer.write_lines(writer.start_words(), ["word"], "word")


PLAYS, PLAY_LENGTH = 150, 150


@query(
    "write_play",
    f"""WITH RECURSIVE {LINE_CHAINS},
      hints AS MATERIALIZED (SELECT play, hint,
          floor({sql.uniform('play', 'hint')} * (SELECT count(*) FROM line_starts))::BIGINT AS i
        FROM (SELECT i // {PLAY_LENGTH} AS play, i % {PLAY_LENGTH} AS hint
          FROM (SELECT unnest(range({PLAYS * PLAY_LENGTH})) AS i))),
      indexed AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS i FROM line_starts),
      picked AS MATERIALIZED (SELECT play, hint, word FROM hints JOIN indexed USING (i)),
      {walk_sql('picked', 'play, hint')}
      SELECT play, coalesce(string_agg(line || chr(10), '' ORDER BY hint), '') AS text
      FROM (SELECT DISTINCT play FROM hints) LEFT JOIN written USING (play) GROUP BY play""",
)
def write_play(t):
    writer = _writer(t)
    return writer.write_play(writer.start_words(), PLAYS, PLAY_LENGTH)


@query(
    "predict_next",
    f"""WITH RECURSIVE {LINE_CHAINS},
      prompt_words AS MATERIALIZED (SELECT id, unnest(range(len(w))) AS pos, unnest(w) AS word
        FROM (SELECT item_id AS id, {sql.words('text')} AS w FROM benchmark)),
      {walk_sql('prompt_words', 'id, pos')}
      SELECT item_id AS id, arg_max(line, pos) || chr(10) AS line
      FROM benchmark LEFT JOIN written ON item_id = id GROUP BY item_id""",
)
def predict_next(t):
    return _writer(t).predict_next(t.prompts(), "id", "text")


GENERATED_TEXT = f"""{LINE_CHAINS},
      hints AS MATERIALIZED (SELECT play, hint,
          floor({sql.uniform('play', 'hint')} * (SELECT count(*) FROM line_starts))::BIGINT AS i
        FROM (SELECT i // 150 AS play, i % 150 AS hint FROM (SELECT unnest(range(22500)) AS i))),
      indexed AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS i FROM line_starts),
      picked AS MATERIALIZED (SELECT play, hint, word FROM hints JOIN indexed USING (i)),
      {walk_sql('picked', 'play, hint')},
      plays AS (SELECT play, coalesce(string_agg(line || chr(10), '' ORDER BY hint), '') AS text
        FROM (SELECT DISTINCT play FROM hints) LEFT JOIN written USING (play) GROUP BY play),
      gw AS MATERIALIZED (SELECT play, {sql.words("replace(text, chr(10), '.')")} AS w FROM plays
        WHERE replace(text, chr(10), '.') <> ' '),
      triples AS (SELECT play, unnest(w[:len(w) - 1]) AS w1, unnest(w[2:]) AS w2,
        unnest(list_append(w[3:], 'endl')) AS nxt FROM gw WHERE len(w) >= 3),
      totals AS (SELECT w1, w2, sum(n) AS total FROM c2 GROUP BY w1, w2),
      scored AS (SELECT play, exp(-avg(ln((coalesce(n, 0) + 1)
          / (coalesce(total, 0) + (SELECT count(DISTINCT nxt) FROM c2))))) AS perplexity
        FROM triples LEFT JOIN c2 USING (w1, w2, nxt) LEFT JOIN totals USING (w1, w2) GROUP BY play),
      ngrams AS (SELECT unnest([2, 3, 4]) AS n),
      grams AS (SELECT n, array_to_string(w[i : i + n - 1], ' ') AS g
        FROM gw, ngrams, unnest(range(1, len(w) - n + 2)) AS t(i)),
      repeated AS (SELECT n, 1 - count(DISTINCT g) / count(*)::DOUBLE AS r FROM grams GROUP BY n)"""


@query(
    "generated_report",
    f"""WITH RECURSIVE {GENERATED_TEXT}
      SELECT metric, round(value, 6) AS value FROM (
        SELECT 'perplexity' AS metric, avg(perplexity) AS value FROM scored
        UNION ALL SELECT 'words', sum(len(w))::DOUBLE FROM gw
        UNION ALL SELECT 'repetition_' || n, r FROM repeated
        UNION ALL SELECT 'diversity', product(1 - r) FROM repeated)""",
)
def generated_report(t):
    """Plays written by the chains, made into texts and measured."""
    lines, writer = t.lines(), _writer(t)
    plays = writer.write_play(writer.start_words(), PLAYS, PLAY_LENGTH)
    texts = plays.withColumn("text", tx.newline_to_period(F.col("text"))).filter("text <> ' '")
    texts = materialise(texts, "plays")
    repetition = materialise(me.ngram_repetition(texts, "text"), "repetition")
    single = {f"repetition_{n}": repetition.filter(F.col("n") == n).select("repetition") for n in me.NGRAM_SIZES}
    report = me.metric_report(
        perplexity=me.mean_perplexity(me.text_perplexity(texts, "play", "text", lines, "line")),
        words=texts.agg(F.sum(F.size(tk.words(F.col("text")))).alias("words")),
        **single,
        diversity=me.diversity(repetition),
    )
    return report.withColumn("value", F.round("value", 6))


# ------------------------------------------------------------------------------ decoding

SOFTMAX = """peaks AS (SELECT context, max(logit / {t}) AS m FROM {source} GROUP BY context),
  shifted AS (SELECT *, exp(logit / {t} - m) AS w FROM {source} JOIN peaks USING (context)),
  softmax AS (SELECT *, w / sum(w) OVER (PARTITION BY context) AS p FROM shifted)"""

TOP_K = """top_k AS (SELECT * FROM (SELECT *, rank() OVER (
    PARTITION BY context ORDER BY logit DESC) AS place FROM logits) WHERE place <= 8)"""


@query(
    "temperature_softmax",
    f"""WITH {sql.LOGITS}, {SOFTMAX.format(t='0.8::DOUBLE', source='logits')}
      SELECT context, token, round(p, 9) AS p FROM softmax""",
)
def temperature_softmax(t):
    p = de.temperature_softmax(t.logits(), ["context"], 0.8)
    return p.select("context", "token", F.round("p", 9).alias("p"))


@query(
    "top_k_filter",
    f"WITH {sql.LOGITS}, {TOP_K} SELECT context, token, round(logit, 9) AS logit FROM top_k",
)
def top_k_filter(t):
    kept = de.top_k_filter(t.logits(), ["context"], 8)
    return kept.select("context", "token", F.round("logit", 9).alias("logit"))


@query(
    "categorical_sample",
    f"""WITH {sql.LOGITS}, {TOP_K}, {SOFTMAX.format(t='0.8::DOUBLE', source='top_k')}
      SELECT context, arg_min(token, -ln({sql.uniform('context', 'token')}) / p) AS token
      FROM softmax GROUP BY context""",
)
def categorical_sample(t):
    return de.sample_top_k(t.logits(), ["context"], 8, 0.8)


@query(
    "context_crop",
    f"""WITH {PIECE_VOCAB}, {encoded_sql('conversations', 'conv_id, turn', 'text', 'coded')}
      SELECT conv_id, turn, array_to_string(ids[greatest(len(ids) - 15, 1):], ',') AS ids
      FROM coded""",
)
def context_crop(t):
    coded = encode_texts(
        t.conversations(), ["conv_id", "turn"], {"ids": "text"}, piece_vocab(t)
    )
    return coded.withColumn("ids", F.array_join(de.context_crop(F.col("ids"), 16), ","))


SAMPLES, NEW_TOKENS, TEMPERATURE, KEEP = 10, 500, 0.8, 200

CONTINUE = f"""{DOC2},
  logits AS (SELECT w1, w2, nxt, ln(n) AS logit FROM p2),
  kept AS (SELECT * FROM (SELECT *, rank() OVER (
    PARTITION BY w1, w2 ORDER BY logit DESC) AS place FROM logits) WHERE place <= 200),
  weights AS (SELECT w1, w2, nxt, exp(logit / 0.8::DOUBLE) AS p FROM kept),
  shares AS (SELECT w1, w2, nxt, p / sum(p) OVER (PARTITION BY w1, w2) AS p FROM weights),
  edges AS MATERIALIZED (SELECT w1, w2, nxt, sum(p) OVER o - p AS lo,
      CASE WHEN lead(nxt) OVER n IS NULL THEN 1.0::DOUBLE ELSE sum(p) OVER o END AS hi
    FROM shares WINDOW n AS (PARTITION BY w1, w2 ORDER BY nxt),
      o AS (PARTITION BY w1, w2 ORDER BY nxt ROWS UNBOUNDED PRECEDING)),
  starts AS MATERIALIZED (SELECT item_id AS id, w[len(w) - 1] AS w1, w[len(w)] AS w2,
      unnest(range({SAMPLES}))::INT AS sample
    FROM (SELECT item_id, {sql.words('text')} AS w FROM benchmark)),
  walk AS (
    SELECT id, sample, 0 AS step, w1, w2, []::VARCHAR[] AS tokens FROM starts
    UNION ALL
    SELECT k.id, k.sample, k.step + 1, k.w2, e.nxt, list_append(k.tokens, e.nxt)
    FROM walk k JOIN edges e ON e.w1 = k.w1 AND e.w2 = k.w2
    WHERE k.step < 500 AND e.nxt <> 'endl'
      AND {sql.uniform('k.id', 'k.sample', 'k.step')} >= e.lo
      AND {sql.uniform('k.id', 'k.sample', 'k.step')} < e.hi)"""


@query(
    "sample_continuations",
    f"""WITH RECURSIVE {CONTINUE}
      SELECT id, sample, array_to_string(arg_max(tokens, step), ' ') AS tokens
      FROM walk GROUP BY id, sample""",
)
def sample_continuations(t):
    chain = materialise(mk.markov2(t.documents(), "content"), "chain")
    walked = de.sample_continuations(
        chain, t.prompts(), "id", "text", SAMPLES, NEW_TOKENS, TEMPERATURE, KEEP
    )
    return walked.select("id", "sample", F.array_join("tokens", " ").alias("tokens"))
