"""Prompt, vocabulary, encoding, batching, split and sampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import tokens as tk
from corpusloom.functions.tokens import EOS
from corpusloom.operators import encoding as en
from corpusloom.operators import splits
from corpusloom.operators.markov import start_words
from corpusloom.operators.prompts import Wording, build_prompts, clean_corpus
from corpusloom.plans import sql
from corpusloom.plans.registry import query
from corpusloom.session import materialise, new_table_path
from corpusloom.sources.corpus import read_token_stream, write_token_stream

W = Wording()


def prompt_sql(*variants: str) -> str:
    """``UNION ALL`` of the prompt forms, spelt out one by one."""
    first = f"{sql.head_lines('text', 1)} || {sql.NL}"
    second = f"{sql.head_lines('text', 2)} || {sql.NL}"
    title = f"'{W.title}' || title || '{EOS}'"
    genre = f"'{W.genre}' || genre || '{EOS}'"
    forms = {
        "title_genre_first": (f"{title} || {genre} || '{W.first}' || {first}", sql.tail_lines("text", 1)),
        "title_genre_second": (f"{title} || {genre} || 'hai câu đầu: ' || {second}", sql.tail_lines("text", 2)),
        "title_genre": (f"{title} || '{W.genre}' || genre", "text"),
        "augment": (f"'{W.genre}' || genre", "text"),
        "title_first": (f"{title} || '{W.first}' || {first}", sql.tail_lines("text", 1)),
        "title_second": (f"{title} || 'hai câu đầu:' || {second}", sql.tail_lines("text", 2)),
        "title": ("'làm thơ với tiêu đề:' || title", "text"),
        "genre_first": (f"{genre} || '{W.first}' || {first}", sql.tail_lines("text", 1)),
        "genre_second": (f"{genre} || 'hai câu đầu:' || {second}", sql.tail_lines("text", 2)),
        "genre": (f"'{W.genre}' || genre", "text"),
        "first": (f"'{W.first}' || {first}", sql.tail_lines("text", 1)),
        "second": (f"'hai câu đầu:' || {second}", sql.tail_lines("text", 2)),
    }
    return " UNION ALL ".join(
        f"SELECT id, '{v}' AS variant, {forms[v][0]} AS source, {forms[v][1]} AS target FROM cleaned"
        for v in variants
    )


@query(
    "prompts_title_genre",
    f"WITH {sql.CLEANED} "
    + prompt_sql("title_genre_first", "title_genre_second", "title_genre", "augment"),
)
def prompts_title_genre(t):
    return build_prompts(clean_corpus(t.corpus()), True, True, True, True, augment=True)


@query(
    "prompts_title",
    f"WITH {sql.CLEANED} " + prompt_sql("title_first", "title_second", "title"),
)
def prompts_title(t):
    return build_prompts(clean_corpus(t.corpus()), True, False, True, True)


@query(
    "prompts_genre",
    f"WITH {sql.CLEANED} " + prompt_sql("genre_first", "genre_second", "genre"),
)
def prompts_genre(t):
    return build_prompts(clean_corpus(t.corpus()), False, True, True, True)


@query("prompts_lines", f"WITH {sql.CLEANED} " + prompt_sql("first", "second"))
def prompts_lines(t):
    return build_prompts(clean_corpus(t.corpus()), False, False, True, True)


def vocab_sql(source: str, keys: str, tokens: str, name: str = "vocab", first_id: int = 0) -> str:
    order = ", ".join(f"first.{k}" for k in [*keys.split(", "), "pos"])
    struct = ", ".join(f"{k} := {k}" for k in [*keys.split(", "), "pos"])
    return f"""{name}_tok AS (
      SELECT {keys}, unnest(range(len(w))) AS pos, unnest(w) AS token
      FROM (SELECT {keys}, {tokens} AS w FROM {source})),
    {name} AS (SELECT token, n, {first_id} - 1 + row_number() OVER (ORDER BY {order}) AS token_id
      FROM (SELECT token, count(*) AS n, min(struct_pack({struct})) AS first
        FROM {name}_tok GROUP BY token))"""


LINE_VOCAB = f"{sql.TRAINING}, {vocab_sql('training', 'id, line_no', sql.runs('line'))}"


@query("build_vocab", f"WITH {LINE_VOCAB} SELECT token, token_id, n FROM vocab")
def build_vocab(t):
    rows = tk.token_rows(t.training_lines(), ["id", "line_no"], "line", tk.runs)
    return en.build_vocab(rows, ["id", "line_no", "pos"])


PIECE_VOCAB = f"""piece_docs AS (SELECT doc_id AS id, text FROM documents),
    {vocab_sql('piece_docs', 'id', sql.pieces('text'), 'seen', 4)},
    specials AS (SELECT unnest(['<s>', '<pad>', '</s>', '<unk>']) AS token,
      unnest(range(4)) AS token_id),
    pieces AS (SELECT token, token_id FROM specials
      UNION ALL SELECT token, token_id FROM seen WHERE token NOT IN (SELECT token FROM specials))"""



def encoded_sql(source: str, keys: str, column: str, name: str, limit: int | None = None) -> str:
    tokens = sql.pieces(column)
    cut = f"({tokens})[:{limit}]" if limit else tokens
    return f"""{name} AS (SELECT {keys}, coalesce(ids, []) AS ids FROM {source} LEFT JOIN (
      SELECT {keys}, list(coalesce(token_id, 3) ORDER BY pos) AS ids
      FROM (SELECT {keys}, unnest(range(len(w))) AS pos, unnest(w) AS token
        FROM (SELECT {keys}, {cut} AS w FROM {source})) LEFT JOIN pieces USING (token)
      GROUP BY {keys}) USING ({keys}))"""


def piece_vocab(t):
    rows = tk.token_rows(t.documents(), ["id"], "content", tk.pieces)
    return en.with_specials(
        t.spark, en.build_vocab(rows, ["id", "pos"], first_id=len(en.SPECIALS))
    )


@query(
    "encode_tokens",
    f"""WITH {PIECE_VOCAB}, tok AS (
      SELECT conv_id, turn, unnest(range(len(w)))::INT AS pos, unnest(w) AS token
      FROM (SELECT conv_id, turn, {sql.pieces('text')} AS w FROM conversations))
      SELECT conv_id, turn, pos, coalesce(token_id, 3) AS token_id
      FROM tok LEFT JOIN pieces USING (token)""",
)
def encode_tokens(t):
    rows = tk.token_rows(t.conversations(), ["conv_id", "turn"], "text", tk.pieces)
    return en.encode_rows(rows, piece_vocab(t), en.UNKNOWN_ID)


@query(
    "vocab_encode",
    f"""WITH {PIECE_VOCAB}, {encoded_sql('conversations', 'conv_id, turn', 'text', 'coded')}
      SELECT conv_id, turn, array_to_string(ids, ',') AS ids FROM coded""",
)
def vocab_encode(t):
    coded = en.encode_texts(
        t.conversations(), ["conv_id", "turn"], {"ids": "text"}, piece_vocab(t)
    )
    return coded.withColumn("ids", F.array_join("ids", ","))


ALL_PROMPTS = f"""{sql.CLEANED}, {PIECE_VOCAB}, prompts AS (
    {prompt_sql("title_genre_first", "title_genre_second", "title_genre", "augment")})"""


def padded_sql(length: int) -> str:
    return f"""padded AS (SELECT *, list_concat([0], ids[:{length - 2}], [2]) AS marked FROM coded),
      filled AS (SELECT id, variant, len(marked) AS used,
        list_concat(marked, list_transform(range({length} - len(marked)), lambda x: 1)) AS ids
      FROM padded)"""


def all_prompts(t):
    return build_prompts(clean_corpus(t.corpus()), True, True, True, True, augment=True)


def padded_prompts(t, column, length):
    """The prompt rows with one side encoded: ids and mask of ``length``."""
    ids = en.encode_texts(
        all_prompts(t), ["id", "variant"], {"ids": column}, piece_vocab(t), limits={"ids": length}
    )
    padded, mask = en.pad_truncate(F.col("ids"), length)
    return ids.select("id", "variant", padded.alias("ids"), mask.alias("mask"))


@query(
    "pad_truncate_source",
    f"""WITH {ALL_PROMPTS}, {encoded_sql('prompts', 'id, variant', 'source', 'coded')},
      {padded_sql(42)}
      SELECT id, variant, array_to_string(ids, ',') AS input_ids,
        array_to_string(list_transform(range(1, 43), lambda i: (i <= used)::INT), ',') AS attention_mask
      FROM filled""",
)
def pad_truncate_source(t):
    return padded_prompts(t, "source", 42).select(
        "id",
        "variant",
        F.array_join("ids", ",").alias("input_ids"),
        F.array_join("mask", ",").alias("attention_mask"),
    )


@query(
    "pad_truncate_target",
    f"""WITH {ALL_PROMPTS}, {encoded_sql('prompts', 'id, variant', 'target', 'coded')},
      {padded_sql(384)} SELECT id, variant, array_to_string(ids, ',') AS labels FROM filled""",
)
def pad_truncate_target(t):
    return padded_prompts(t, "target", 384).select(
        "id", "variant", F.array_join("ids", ",").alias("labels")
    )


@query(
    "encode_pairs",
    f"""WITH {ALL_PROMPTS}, {encoded_sql('prompts', 'id, variant', 'source', 'src')},
      {encoded_sql('prompts', 'id, variant', 'target', 'tgt')},
      coded AS (SELECT id, variant, list_concat([0], src.ids[:40], [2]) AS s,
        list_concat([0], tgt.ids[:382], [2]) AS t FROM src JOIN tgt USING (id, variant))
      SELECT id, variant, array_to_string(s, ',') || repeat(',1', 42 - len(s)) AS input_ids,
        len(s)::INT AS used, array_to_string(t, ',') || repeat(',1', 384 - len(t)) AS labels FROM coded""",
)
def encode_pairs(t):
    used = F.aggregate("attention_mask", F.lit(0), lambda total, m: total + m)
    return en.encode_pairs(all_prompts(t), piece_vocab(t)).select(
        "id",
        "variant",
        F.array_join("input_ids", ",").alias("input_ids"),
        used.alias("used"),
        F.array_join("labels", ",").alias("labels"),
    )


def split_sql(u: str) -> str:
    return f"CASE WHEN {u} < 0.1 THEN 'test' WHEN {u} < 0.1 + 0.1 THEN 'valid' ELSE 'train' END"


SPLIT = f"split_docs AS (SELECT doc_id AS id, {split_sql(sql.uniform('doc_id'))} AS split, text FROM documents)"


@query("train_valid_test_split", f"WITH {SPLIT} SELECT id, split FROM split_docs")
def train_valid_test_split(t):
    return splits.split_rows(t.documents().select("id"), ["id"])


@query(
    "train_valid_test_split_by_row",
    f"""WITH {sql.CLEANED}, p AS ({prompt_sql("title_genre_first", "title_genre")})
      SELECT id, variant, {split_sql(sql.uniform('id', 'variant'))} AS split FROM p""",
)
def train_valid_test_split_by_row(t):
    prompts = build_prompts(clean_corpus(t.corpus()), with_first=True)
    return splits.split_rows(prompts.select("id", "variant"), ["id", "variant"])


@query(
    "train_valid_test_split_exact",
    f"""WITH d AS (SELECT doc_id AS id, count(*) OVER () AS n,
        row_number() OVER (ORDER BY {sql.uniform('doc_id')}, doc_id) - 1 AS i FROM documents),
      s AS (SELECT *, (n + 9) // 10 AS n_test FROM d)
      SELECT id, CASE WHEN i < n_test THEN 'test'
        WHEN i < n_test + (n - n_test + 8) // 9 THEN 'valid' ELSE 'train' END AS split FROM s""",
)
def train_valid_test_split_exact(t):
    return splits.split_rows_exact(t.documents().select("id"), ["id"])


@query("split_select", f"WITH {SPLIT} SELECT id, text FROM split_docs WHERE split = 'valid'")
def split_select(t):
    docs = t.documents().select("id", F.col("content").alias("text"))
    return splits.split_select(splits.split_rows(docs, ["id"]), "valid").drop("split")


@query(
    "sample_fraction",
    f"SELECT doc_id AS id, text FROM documents WHERE {sql.uniform('doc_id')} < 0.12",
)
def sample_fraction(t):
    docs = t.documents().select("id", F.col("content").alias("text"))
    return splits.sample_fraction(docs, ["id"], 0.12)


@query(
    "sample_fraction_exact",
    f"""SELECT id FROM (SELECT doc_id AS id, count(*) OVER () AS n,
        row_number() OVER (ORDER BY {sql.uniform('doc_id')}, doc_id) - 1 AS i FROM documents)
      WHERE i < round_even(0.12 * n, 0)""",
)
def sample_fraction_exact(t):
    return splits.sample_fraction_exact(t.documents().select("id"), ["id"], 0.12)


STARTS = f"""starts AS (SELECT DISTINCT w[1] AS word
    FROM (SELECT {sql.words('text')} AS w FROM documents) WHERE len(w) > 0),
  start_index AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS i,
    count(*) OVER () AS n FROM starts)"""


@query(
    "pick_with_replacement",
    f"""WITH {STARTS}, picks AS (SELECT doc_id AS id,
        floor({sql.uniform('doc_id')} * (SELECT count(*) FROM starts))::BIGINT AS i FROM documents)
      SELECT id, word FROM picks JOIN start_index USING (i)""",
)
def pick_with_replacement(t):
    docs = t.documents()
    words = start_words(docs, "content")
    return splits.pick_with_replacement(words, ["word"], docs.select("id"), ["id"])


BATCHED = f"""{SPLIT}, batched AS (SELECT id, split, text,
    (row_number() OVER (PARTITION BY split ORDER BY id) - 1) // 8 AS batch_id FROM split_docs)"""


@query("assign_batches", f"WITH {BATCHED} SELECT id, split, batch_id FROM batched")
def assign_batches(t):
    docs = splits.split_rows(t.documents().select("id"), ["id"])
    return en.assign_batches(docs, ["id"], 8)


@query(
    "assign_batches_shuffled",
    f"""WITH {SPLIT} SELECT id, split, (row_number() OVER (
        PARTITION BY split ORDER BY {sql.uniform('id')}, id) - 1) // 8 AS batch_id FROM split_docs""",
)
def assign_batches_shuffled(t):
    docs = splits.split_rows(t.documents().select("id"), ["id"])
    return en.assign_batches(docs, ["id"], 8, shuffle=True)


@query(
    "pad_to_batch",
    f"""WITH {BATCHED}, {PIECE_VOCAB}, {encoded_sql('batched', 'id', 'text', 'coded')},
      longest AS (SELECT *, max(len(ids)) OVER (PARTITION BY split, batch_id) AS m
        FROM coded JOIN batched USING (id))
      SELECT id, split, batch_id, array_to_string(
        list_concat(ids, list_transform(range(m - len(ids)), lambda x: -100)), ',') AS labels
      FROM longest""",
)
def pad_to_batch(t):
    docs = t.documents()
    batched = en.assign_batches(splits.split_rows(docs.select("id"), ["id"]), ["id"], 8)
    coded = en.encode_texts(docs, ["id"], {"labels": "content"}, piece_vocab(t))
    padded = en.pad_to_batch(
        batched.join(coded, "id"), ["split", "batch_id"], "labels", en.IGNORED_LABEL
    )
    return padded.select("id", "split", "batch_id", F.array_join("labels", ",").alias("labels"))


STREAM = f"""{PIECE_VOCAB}, stream AS (
    SELECT row_number() OVER (ORDER BY id, pos) - 1 AS pos, token_id
    FROM seen_tok JOIN pieces USING (token))"""


def stream(t):
    docs = t.documents()
    coded = en.encode_texts(docs, ["id"], {"ids": "content"}, piece_vocab(t))
    return en.token_stream(coded, "id")


@query("token_stream_scan", f"WITH {STREAM} SELECT pos, token_id FROM stream")
def token_stream_scan(t):
    path = new_table_path(t.spark, "stream")
    write_token_stream(stream(t), path)
    return read_token_stream(t.spark, path)


@query(
    "lm_windows",
    f"""WITH {STREAM}, flat AS (SELECT list(token_id ORDER BY pos) AS ids FROM stream),
      starts AS (SELECT doc_id AS window_id, floor({sql.uniform('doc_id')}
        * ((SELECT count(*) FROM stream) - 64))::BIGINT AS start
        FROM (SELECT unnest(range((SELECT count(*) FROM documents))) AS doc_id)),
      picked AS (SELECT window_id, start, pos - start AS place, token_id
        FROM (SELECT *, unnest(range(start, start + 65)) AS pos FROM starts) JOIN stream USING (pos))
      SELECT window_id, start,
        string_agg(token_id, ',' ORDER BY place) FILTER (WHERE place < 64) AS x,
        string_agg(token_id, ',' ORDER BY place) FILTER (WHERE place > 0) AS y
      FROM picked GROUP BY window_id, start""",
)
def lm_windows(t):
    rows = materialise(stream(t), "stream")
    windows = en.lm_windows(rows, rows.count(), 64, t.read("documents").count())
    return windows.select(
        "window_id", "start", F.array_join("x", ",").alias("x"), F.array_join("y", ",").alias("y")
    )
