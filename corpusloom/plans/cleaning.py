"""Sources, cleaning and tokenising queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.functions import tokens as tk
from corpusloom.operators import encoding as en
from corpusloom.operators import splits
from corpusloom.operators.prompts import clean_corpus
from corpusloom.plans import sql
from corpusloom.plans.registry import query
from corpusloom.session import new_table_path
from corpusloom.sources.corpus import read_corpus


@query(
    "corpus_scan",
    f"WITH {sql.CORPUS} SELECT id::VARCHAR AS id, content, title, url, genre FROM corpus",
)
def corpus_scan(t):
    """The corpus as a file whose columns stand in another order, through the reader."""
    path = new_table_path(t.spark, "corpus")
    corpus = t.corpus().select("genre", "content", "url", "id", "title")
    corpus.write.options(header="true", escape='"').csv(path)
    return read_corpus(t.spark, path, "csv")


@query(
    "line_scan",
    f"WITH {sql.LINES} SELECT id, line_no, {sql.strip('line')} AS line FROM lines",
)
def line_scan(t):
    return t.lines().withColumn("line", tx.strip(F.col("line")))


@query(
    "clean_content",
    f"WITH {sql.CORPUS} SELECT id, {sql.clean('content')} AS text FROM corpus",
)
def clean_content(t):
    return t.documents().select("id", tx.clean_content(F.col("content")).alias("text"))


@query(
    "clean_genre",
    f"WITH {sql.CORPUS} SELECT id, {sql.clean_genre('genre')} AS genre FROM corpus",
)
def clean_genre(t):
    return t.corpus().select("id", tx.clean_genre(F.col("genre")).alias("genre"))


@query(
    "clean_title",
    f"WITH {sql.CORPUS} SELECT id, {sql.clean_title('title')} AS title FROM corpus",
)
def clean_title(t):
    return t.corpus().select("id", tx.clean_title(F.col("title")).alias("title"))


@query("project_columns", f"WITH {sql.CLEANED} SELECT id, text, genre, title FROM cleaned")
def project_columns(t):
    return clean_corpus(t.corpus())


@query(
    "normalise_lines",
    f"WITH {sql.LINES} SELECT id, line_no, {sql.normalise('line')} AS line FROM lines",
)
def normalise_lines(t):
    return t.lines().withColumn("line", tx.normalise_line(F.col("line")))


@query("drop_blank_lines", f"WITH {sql.TRAINING} SELECT id, line_no, line FROM training")
def drop_blank_lines(t):
    return t.training_lines()


@query("genre_filter", f"WITH {sql.CORPUS} SELECT id, content FROM corpus WHERE genre = 'fr'")
def genre_filter(t):
    return t.corpus().filter(F.col("genre") == "fr").select("id", "content")


@query(
    "genre_list",
    f"WITH {sql.CORPUS} SELECT genre, min(id) AS first_id FROM corpus GROUP BY genre ORDER BY 2",
)
def genre_list(t):
    return t.corpus().groupBy("genre").agg(F.min("id").alias("first_id")).orderBy("first_id")


@query(
    "head",
    f"WITH {sql.CORPUS} SELECT id, content, title, url, genre FROM corpus ORDER BY id LIMIT 5",
)
def head(t):
    return t.corpus().orderBy("id").limit(5)


@query(
    "row_count",
    f"""WITH {sql.CORPUS} SELECT count(*) AS total, count(*) FILTER (genre = 'fr') AS in_genre,
      count(*) FILTER (genre = 'fr' AND {sql.uniform('id')} < 0.12) AS sampled FROM corpus""",
)
def row_count(t):
    in_genre = F.col("genre") == "fr"
    sampled = in_genre & (splits.uniform(42, "id") < 0.12)
    return t.corpus().agg(
        F.count("*").alias("total"),
        F.count_if(in_genre).alias("in_genre"),
        F.count_if(sampled).alias("sampled"),
    )


@query(
    "newline_to_period",
    "SELECT doc_id AS id, replace(text, chr(10), '.') AS text FROM documents",
)
def newline_to_period(t):
    return t.documents().select("id", tx.newline_to_period(F.col("content")).alias("text"))


@query(
    "drop_single_space_rows",
    f"""WITH {sql.LINES} SELECT id, line_no, line FROM (SELECT id, line_no,
      translate({sql.strip('line')}, {sql.text(tx.PUNCTUATION)}, '') AS line FROM lines)
      WHERE line <> ' '""",
)
def drop_single_space_rows(t):
    bare = tx.delete_punctuation(tx.strip(F.col("line")))
    return t.lines().withColumn("line", bare).filter(F.col("line") != " ")


@query("truncate_chars", "SELECT doc_id AS id, substr(text, 1, 256) AS text FROM documents")
def truncate_chars(t):
    return t.documents().select("id", tx.truncate_chars(F.col("content")).alias("text"))


@query(
    "head_tail_lines",
    "SELECT doc_id AS id, "
    + ", ".join(
        f"{sql.head_lines('text', k)} AS head{k}, {sql.tail_lines('text', k)} AS tail{k}"
        for k in (1, 2)
    )
    + " FROM documents",
)
def head_tail_lines(t):
    text = F.col("content")
    parts = [(f(text, k), f"{n}{k}") for k in (1, 2) for f, n in ((tx.head_lines, "head"), (tx.tail_lines, "tail"))]
    return t.documents().select("id", *[c.alias(n) for c, n in parts])


def _joined(t, tokens):
    return t.documents().select("id", tokens.alias("w")).select(
        "id", F.size("w").alias("n"), F.array_join("w", "|").alias("tokens")
    )


def _joined_sql(tokens):
    return f"""SELECT id, len(w)::INT AS n, array_to_string(w, '|') AS tokens
      FROM (SELECT doc_id AS id, {tokens} AS w FROM documents)"""


@query("tokenize_words", _joined_sql(sql.words("text")))
def tokenize_words(t):
    return _joined(t, tk.words(F.col("content")))


@query("tokenize_runs", _joined_sql(sql.runs("text")))
def tokenize_runs(t):
    return _joined(t, tk.runs(F.col("content")))


@query("metric_tokens", _joined_sql(sql.runs("replace(text, chr(10), '.')", newline=False)))
def metric_tokens(t):
    return _joined(t, tk.runs(tx.newline_to_period(F.col("content")), newline=False))


@query(
    "word_count",
    f"""SELECT doc_id AS id, len(regexp_extract_all(text, '[{tx.WORD_CLASS}]+'))::INT AS words
      FROM documents""",
)
def word_count(t):
    return t.documents().select("id", tk.word_count(F.col("content")).alias("words"))


CHAR_VOCAB = f"""char_vocab AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS token_id
  FROM (SELECT DISTINCT unnest({sql.chars('text')}) AS token FROM documents))"""


@query("vocab_load", f"WITH {CHAR_VOCAB} SELECT token, token_id FROM char_vocab")
def vocab_load(t):
    path = new_table_path(t.spark, "char-vocab")
    en.build_char_vocab(t.documents(), "content").write.parquet(path)
    return t.spark.read.schema("token string, token_id bigint").parquet(path)


@query(
    "char_encode",
    f"""WITH {CHAR_VOCAB}, c AS (SELECT doc_id AS id, unnest(range(len(w))) AS pos, unnest(w) AS token
      FROM (SELECT doc_id, {sql.chars('text')} AS w FROM documents))
      SELECT id, string_agg(token_id, ',' ORDER BY pos) AS ids
      FROM c JOIN char_vocab USING (token) GROUP BY id""",
)
def char_encode(t):
    docs = t.documents()
    vocab = en.build_char_vocab(docs, "content")
    coded = en.encode_texts(docs, ["id"], {"ids": "content"}, vocab, tk.chars, None)
    return coded.select("id", F.array_join("ids", ",").alias("ids"))


@query("detokenize", "SELECT doc_id AS id, text FROM documents")
def detokenize(t):
    docs = t.documents()
    vocab = en.build_char_vocab(docs, "content")
    coded = en.encode_texts(docs, ["id"], {"ids": "content"}, vocab, tk.chars)
    return en.decode_texts(coded, ["id"], "ids", vocab)
