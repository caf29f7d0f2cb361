"""Building blocks of the checking SQL."""

from __future__ import annotations

from corpusloom.functions.text import (
    PUNCTUATION,
    SPACE_CHARS,
    SPACE_CLASS,
    UNKNOWN,
    UNSPACE,
    WORD_CLASS,
)


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


NL = "chr(10)"


def strip(x: str) -> str:
    return f"trim({x}, {text(SPACE_CHARS)})"


def clean(x: str) -> str:
    x = strip(x)
    for spaced, tight in UNSPACE:
        x = f"replace({x}, {text(spaced)}, {text(tight)})"
    return x


def clean_title(x: str) -> str:
    pattern = rf"[{WORD_CLASS}\p{{M}}]+|[^{WORD_CLASS}\p{{M}}{SPACE_CLASS}]+"
    words = f"regexp_extract_all(lower({strip(x)}), {text(pattern)})"
    return f"coalesce(array_to_string({words}, ' '), '{UNKNOWN}')"


def clean_genre(x: str) -> str:
    return f"coalesce({clean(x)}, '{UNKNOWN}')"


def normalise(x: str) -> str:
    return f"lower(translate({strip(x)}, {text(PUNCTUATION)}, ''))"


def words(x: str) -> str:
    parts = f"regexp_split_to_array(translate(lower({x}), {text(PUNCTUATION)}, ''), '[{SPACE_CLASS}]+')"
    return f"list_filter({parts}, lambda t: t <> '')"


def runs(x: str, newline: bool = True) -> str:
    x = f"{x} || {NL}" if newline else x
    found = f"regexp_extract_all({x}, '[{WORD_CLASS}]+|[^{WORD_CLASS}]+')"
    return f"list_filter({found}, lambda t: t <> ' ')"


def pieces(x: str) -> str:
    pattern = rf"</s>|<unk>|\n|[{WORD_CLASS}]+|[^{WORD_CLASS}\n<]+|<"
    return f"list_filter(regexp_extract_all({x}, '{pattern}'), lambda t: t <> ' ')"


def chars(x: str) -> str:
    return f"regexp_extract_all({x}, '(?s).')"


def uniform(*keys: object, seed: int = 42) -> str:
    texts = [
        f"coalesce(replace(replace(CAST({k} AS VARCHAR), '\\', '\\\\'), '|', '\\|'), '\\N')" for k in keys
    ]
    joined = f"concat_ws('|', '{seed}', {', '.join(texts)})"
    bits = f"('0x' || substr(md5({joined}), 1, 13))::BIGINT::DOUBLE"
    return f"(({bits} + 0.5::DOUBLE) / 4503599627370496::DOUBLE)"


def head_lines(x: str, k: int) -> str:
    return f"array_to_string(string_split({x}, {NL})[1:{k}], {NL})"


def tail_lines(x: str, k: int) -> str:
    return f"array_to_string(string_split({x}, {NL})[{k + 1}:], {NL})"


CORPUS = """corpus AS (
  SELECT d.doc_id AS id, text AS content,
    CASE WHEN contains(text, chr(10)) THEN string_split(text, chr(10))[1] END AS title,
    'doc://' || source || '/' || d.doc_id AS url,
    CASE WHEN l.doc_id IS NOT NULL THEN lang END AS genre
  FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id)"""

CLEANED = f"""{CORPUS}, cleaned AS (
  SELECT id, {clean('content')} AS text, {clean_genre('genre')} AS genre,
    {clean_title('title')} AS title FROM corpus)"""

LINES = f"""lines AS (
  SELECT doc_id AS id, unnest(range(len(parts)))::INT AS line_no, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(text, {NL}) AS parts FROM documents))"""

TRAINING = f"""{LINES}, training AS (
  SELECT * FROM (SELECT id, line_no, {normalise('line')} AS line FROM lines)
  WHERE line <> '')"""

LOGITS = """logits AS (
  SELECT vec_id AS context, unnest(range(len(embedding)))::INT AS token,
    unnest(embedding)::DOUBLE AS logit,
    CASE WHEN vec_id % 10 = 0 THEN -1 ELSE label END AS target FROM embeddings)"""


def thousandths(n: str, total: str) -> str:
    """Python's ``round(n / total, 3)`` in thousandths."""
    up = f"((2000 * {n} + {total}) // (2 * {total}))::BIGINT"
    binary = f"2000 * (({n} / {total}) * 9223372036854775808::DOUBLE)::BIGINT::HUGEINT"
    middle = f"(2 * {up} - 1)::HUGEINT * 9223372036854775808::HUGEINT"
    return (
        f"(CASE WHEN (2000 * {n} + {total}) % (2 * {total}) <> 0 THEN {up}"
        f" WHEN {binary} > {middle} THEN {up} WHEN {binary} < {middle} THEN {up} - 1"
        f" ELSE {up} - {up} % 2 END)"
    )


def chain1(source: str, column: str) -> str:
    return f"""w AS (SELECT {words(column)} AS w FROM {source}),
  c1 AS (SELECT w1, nxt, count(*) AS n FROM (
    SELECT unnest(w[:len(w) - 1]) AS w1, unnest(w[2:]) AS nxt FROM w WHERE len(w) >= 2)
    GROUP BY ALL),
  p1 AS (SELECT w1, nxt, n, sum(n) OVER k AS total, {thousandths('n', '(sum(n) OVER k)::BIGINT')} AS q
    FROM c1 WINDOW k AS (PARTITION BY w1))"""


def chain2(source: str, column: str) -> str:
    return f"""w AS (SELECT {words(column)} AS w FROM {source}),
  c2 AS (SELECT w1, w2, nxt, count(*) AS n FROM (
    SELECT unnest(w[:len(w) - 1]) AS w1, unnest(w[2:]) AS w2,
      unnest(list_append(w[3:], 'endl')) AS nxt FROM w WHERE len(w) >= 3)
    GROUP BY ALL),
  p2 AS (SELECT *, rank() OVER (PARTITION BY w1, w2 ORDER BY q DESC) AS place FROM (
    SELECT w1, w2, nxt, n, sum(n) OVER k AS total,
      {thousandths('n', '(sum(n) OVER k)::BIGINT')} AS q
    FROM c2 WINDOW k AS (PARTITION BY w1, w2)))"""
