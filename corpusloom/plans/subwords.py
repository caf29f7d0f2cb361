"""Subword queries: ids by merges of a public vocabulary, back to text, and training batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import encoding as en
from corpusloom.operators import splits
from corpusloom.operators.prompts import build_prompts, clean_corpus
from corpusloom.operators.subwords import MARKERS, Subwords
from corpusloom.plans import sql
from corpusloom.plans.encoding import prompt_sql, split_sql
from corpusloom.plans.registry import query
from corpusloom.session import materialise

try:
    import public_tokenizers

    VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
except ModuleNotFoundError:
    VOCABULARY = None

#: Markers stand as private characters in the checking SQL, and one parts white space.
_PRIVATE = [chr(0xE000 + n) for n in range(len(MARKERS))]
_PART = chr(0xE010)
_WHITE, _BLANK = r"[\t-\r\x{85}\p{Z}]", r"[^\t-\r\x{85}\p{Z}\x{E000}-\x{E004}]"


def pieces_sql(column: str) -> str:
    for marker, private in zip(MARKERS, _PRIVATE, strict=True):
        column = f"replace({column}, {sql.text(marker) if marker != chr(10) else sql.NL}, '{private}')"
    parted = rf"regexp_replace({column}, '({_WHITE}+)({_WHITE}{_BLANK})', '\1{_PART}\2', 'g')"
    signs = r"[^\t-\r\x{85}\p{Z}\p{L}\p{N}\x{E000}-\x{E010}]"
    pattern = rf"[\x{{E000}}-\x{{E004}}]|''s|''t|''re|''ve|''m|''ll|''d| ?\p{{L}}+| ?\p{{N}}+| ?{signs}+|{_WHITE}+"
    return f"regexp_extract_all({parted}, '{pattern}')"


def subword_sql(source: str, keys: str, column: str, name: str) -> str:
    """``name`` (keys, ids): pieces merged pair by pair in a recursion, then put together."""
    numbers = ", ".join(f"('{p}', {n})" for n, p in enumerate(_PRIVATE))
    return f"""{name}_rows AS (SELECT {keys}, unnest(range(len(w))) AS pos, unnest(w) AS piece
      FROM (SELECT {keys}, {pieces_sql(column)} AS w FROM {source})),
    {name}_bytes AS (SELECT piece, list_transform(range(1, length(h), 2), lambda i: substr(h, i, 2)) AS parts
      FROM (SELECT piece, hex(encode(piece)) AS h FROM (SELECT DISTINCT piece FROM {name}_rows
        WHERE piece NOT BETWEEN '{_PRIVATE[0]}' AND '{_PRIVATE[-1]}'))),
    {name}_merging AS (
      SELECT piece, parts FROM {name}_bytes
      UNION ALL
      SELECT piece, list_concat(parts[:k - 1], [parts[k] || parts[k + 1]], parts[k + 2:]) FROM (
        SELECT piece, any_value(parts) AS parts, arg_min(i, (r.id, i)) AS k
        FROM (SELECT piece, parts, unnest(range(1, len(parts))) AS i FROM {name}_merging) p
        JOIN ranks r ON r.h = parts[i] || parts[i + 1] GROUP BY piece)),
    {name}_ids AS (SELECT piece, list(r.id ORDER BY i) AS ids FROM (
        SELECT piece, unnest(range(len(parts))) AS i, unnest(parts) AS h
        FROM (SELECT piece, arg_min(parts, len(parts)) AS parts FROM {name}_merging GROUP BY piece))
      JOIN ranks r USING (h) GROUP BY piece
      UNION ALL SELECT p, [(SELECT max(id) + 1 FROM ranks) + n] FROM (VALUES {numbers}) AS v(p, n)),
    {name} AS (SELECT {keys}, coalesce(ids, []) AS ids FROM {source} LEFT JOIN (
      SELECT {keys}, flatten(list(ids ORDER BY pos)) AS ids
      FROM {name}_rows JOIN {name}_ids USING (piece) GROUP BY {keys}) USING ({keys}))"""


RANKS = f"""ranks AS (SELECT hex(from_base64(token)) AS h, id FROM read_csv('{VOCABULARY}',
    delim = ' ', header = false, quote = '', escape = '', columns = {{'token': 'VARCHAR', 'id': 'BIGINT'}}))"""

BATCHES = f"""WITH RECURSIVE {RANKS}, {sql.CLEANED}, prompts AS ({prompt_sql("title_genre_first", "title_genre")}),
  {subword_sql('prompts', 'id, variant', 'source', 'src')},
  {subword_sql('prompts', 'id, variant', 'target', 'tgt')},
  marks AS (SELECT max(id) + 1 AS b FROM ranks),
  pairs AS (SELECT id, variant, b, list_concat([b], src.ids[:40], [b + 2]) AS s,
    list_concat([b], tgt.ids[:382], [b + 2]) AS t FROM src JOIN tgt USING (id, variant), marks),
  placed AS (SELECT *, {split_sql(sql.uniform('id'))} AS split FROM pairs),
  batched AS (SELECT *, (row_number() OVER (PARTITION BY split ORDER BY id, variant) - 1) // 8 AS batch_id FROM placed),
  longest AS (SELECT *, max(len(t)) OVER (PARTITION BY split, batch_id) AS m FROM batched)
  SELECT id, variant, split, batch_id, len(s)::INT AS used,
    array_to_string(list_concat(s, list_transform(range(42 - len(s)), lambda x: b + 1)), ',') AS input_ids,
    array_to_string(list_concat(t, list_transform(range(m - len(t)), lambda x: -100)), ',') AS labels
  FROM longest"""

if VOCABULARY is not None:

    @query(
        "subword_encode",
        f"""WITH RECURSIVE {RANKS}, docs AS (SELECT doc_id AS id, text FROM documents),
          {subword_sql('docs', 'id', 'text', 'coded')}
          SELECT id, len(ids)::INT AS n, array_to_string(ids, ',') AS ids FROM coded""",
    )
    def subword_encode(t):
        coded = Subwords.load(t.spark, VOCABULARY).encode(t.documents(), ["id"], {"ids": "content"})
        return coded.select("id", F.size("ids").alias("n"), F.array_join("ids", ",").alias("ids"))

    @query("subword_decode", "SELECT doc_id AS id, text FROM documents")
    def subword_decode(t):
        words = Subwords.load(t.spark, VOCABULARY)
        return words.decode(words.encode(t.documents(), ["id"], {"ids": "content"}), ["id"])

    @query("prompt_batches", BATCHES)
    def prompt_batches(t):
        """Corpus, prompts, split, subwords and batches in one."""
        prompts = build_prompts(clean_corpus(t.corpus()), with_first=True)
        pairs = Subwords.load(t.spark, VOCABULARY).encode_pairs(prompts)
        pairs = materialise(splits.split_rows(pairs, ["id"]), "pairs")
        # Only the keys are put in order; the id arrays meet their batch by a join.
        batches = en.assign_batches(pairs.select("id", "variant", "split"), ["id", "variant"], 8)
        batched = pairs.drop("split").join(batches, ["id", "variant"])
        padded = en.pad_to_batch(batched, ["split", "batch_id"], "labels", en.IGNORED_LABEL)
        used = F.aggregate("attention_mask", F.lit(0), lambda total, m: total + m)
        return padded.select(
            "id", "variant", "split", "batch_id", used.alias("used"),
            F.array_join("input_ids", ",").alias("input_ids"), F.array_join("labels", ",").alias("labels"),
        )
