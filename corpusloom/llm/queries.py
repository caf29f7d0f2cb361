"""The registered queries of this package and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import (
    centroids,
    conversations,
    decontamination,
    html,
    licenses,
    lines,
    packing,
    quality_model,
    quality_rules,
    repeats,
    secrets,
    simhash,
    toxicity,
)
from corpusloom.llm.store import held_out, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.scan(docs, read(spark, sf_dir, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_LOWER_WORDS = """regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

SQL["op3_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_LOWER_WORDS} AS w FROM documents),
b AS (SELECT DISTINCT item_id, {_LOWER_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, list_slice(w, i, i + least(10, len(w)) - 1) AS g, least(10, len(w)) AS n
        FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
places AS (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS g
           FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n),
found AS (SELECT doc_id, i, p.n, item_id FROM places p JOIN win USING (g)),
hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM found, unnest(range(i, i + n)) AS t(k) GROUP BY doc_id),
who AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN who USING (doc_id)
"""


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    cleaned = lines.drop_site_lines(docs, dropped_column="n_dropped")
    return cleaned.select("doc_id", "text", "n_dropped", F.length("text").alias("n_chars"))


SQL["op8_line_dedup"] = """
WITH pages AS (SELECT DISTINCT source, text FROM documents),
total AS (SELECT source, count(*) AS total FROM pages GROUP BY source),
site AS (
  SELECT source, line, count(*) AS pages
  FROM (SELECT DISTINCT source, text, trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS line
        FROM pages, unnest(string_split(text, chr(10))) AS t(line))
  WHERE line <> '' GROUP BY source, line),
bad AS (SELECT s.source, s.line FROM site s JOIN total t ON s.source IS NOT DISTINCT FROM t.source
        WHERE s.pages >= 5 AND s.pages > 0.01 * t.total),
parts AS (
  SELECT doc_id, source, k, line, trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS bare
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents)),
marked AS (SELECT p.*, b.line IS NOT NULL AS gone FROM parts p LEFT JOIN bad b
           ON p.bare = b.line AND p.source IS NOT DISTINCT FROM b.source),
back AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '') AS text,
                count(*) FILTER (gone) AS n_dropped FROM marked GROUP BY doc_id)
SELECT doc_id, text, CAST(n_dropped AS BIGINT) AS n_dropped, CAST(length(text) AS INTEGER) AS n_chars FROM back
"""


def _judged(scored: DataFrame, parts: int, part: int) -> DataFrame:
    return scored.select(
        "doc_id",
        held_out("doc_id", parts, part).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.filter(~held_out("doc_id", 5, 0)))
    return _judged(toxicity.score(docs, model), 5, 0)


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.apply_rules(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_SHORT_WORDS = ", ".join(f"'{word}'" for word in quality_rules.STOP_WORDS)

SQL["op6_quality_rules"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, {_BLANKS}) <> '') AS l
           FROM documents),
g AS (SELECT doc_id, i, list_slice(w, i, i + 2) AS g FROM d, unnest(range(1, len(w) - 1)) AS t(i) WHERE len(w) > 2),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT k) AS n FROM again, unnest([i, i + 1, i + 2]) AS t(k) GROUP BY doc_id),
m AS (SELECT doc_id, len(w) AS n_words, length(translate(t, {_BLANKS}, '')) AS word_chars,
        length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
        len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
        len(list_filter(w, lambda x: lower(trim(x, '.,;:!?()"''')) IN ({_SHORT_WORDS}))) AS n_stop,
        len(list_filter(w, lambda x: ends_with(x, '!!'))) AS n_bang
      FROM d LEFT JOIN rep USING (doc_id)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND word_chars BETWEEN 2 * n_words AND 14 * n_words AND n_symbols * 20 <= word_chars
  AND n_symbols * 4 <= n_words AND n_stop * 100 >= n_words AND n_bang * 5 <= n_words
  AND n_dup_lines * 2 <= n_lines AND n_words >= 2 * n_lines AS kept
FROM v
"""


@query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["rank"] < 3)

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(secrets.written_out(base), 256).alias("base_sha256"),
        secrets.written_out(F.col("secrets")).alias("spans"),
    )


_ASSIGN = r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+)"""
_VALUE = r"""^[A-Za-z_]+["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$"""


def _sql_spans(kind: str, rank: int, pattern: str, where: str) -> str:
    return f"""SELECT doc_id, '{kind}' AS kind, {rank} AS r, s, s + length(m) AS e, m FROM (
      SELECT doc_id, m, CAST(sum(length(p) + coalesce(lag, 0)) OVER (PARTITION BY doc_id ORDER BY k) AS BIGINT) AS s
      FROM (SELECT doc_id, k, ms[k] AS m, ps[k] AS p, length(ms[k - 1]) AS lag
            FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms,
                         regexp_split_to_array(t, '{pattern}') AS ps FROM d),
                 unnest(range(1, len(ms) + 1)) AS u(k))) WHERE {where}"""


SQL["op4_secrets"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS (
  {_sql_spans("assign", 0, _ASSIGN, f"length(regexp_extract(m, '{_VALUE}', 1)) >= 6")}
  UNION ALL {_sql_spans("access", 1, "AKIA[A-Z0-9]+", "length(m) >= 20")}
  UNION ALL {_sql_spans("hex", 2, "[0-9a-f]+", "length(m) >= 24")}),
cand AS ({_sql_spans("entropy", 3, "[A-Za-z0-9+/_=-]+", "length(m) >= 20")}),
outside AS (SELECT c.* FROM cand c WHERE NOT EXISTS (
  SELECT 1 FROM base b WHERE b.doc_id = c.doc_id AND b.s <= c.s AND c.e <= b.e)),
open AS (SELECT * FROM outside WHERE NOT (
  regexp_matches(m, '^[A-Za-z]+$') OR regexp_matches(m, '^[0-9_+/=-]+$')
  OR regexp_matches(m, '^[A-Za-z]+([-_/+=]+[A-Za-z]+)*[-_/+=]*$')
  OR regexp_matches(m, '^[A-Za-z]+([-_/][A-Za-z0-9]{{1,8}}){{2,}}$')
  OR regexp_matches(m, '^[0-9a-fA-F]{{8}}(-[0-9a-fA-F]{{4}}){{3}}-[0-9a-fA-F]{{12}}$')
  OR regexp_matches(lower(m), 'example|sample|dummy|placeholder|changeme|redacted')
  OR len(list_filter(range(1, length(m) - 6), lambda i: m[i:i + 7] = repeat(m[i], 8))) > 0
  OR regexp_matches(m, '0123456789|abcdefghij|ABCDEFGHIJ'))),
dense AS (SELECT doc_id, kind, r, s, e FROM open WHERE list_max(list_transform(range(1, length(m) - 18),
    lambda i: list_entropy(string_split(m[i:i + 19], '')))) >= CASE
      WHEN regexp_matches(m, '^[0-9a-f]+$|^[0-9A-F]+$') THEN 2.9
      WHEN regexp_matches(m, '^[A-Za-z0-9]+$') THEN 3.5 ELSE 3.6 END),
spans AS (SELECT doc_id, kind, r, s, e FROM base UNION ALL SELECT * FROM dense),
out AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, r) FILTER (r < 3) AS base,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, r) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN out ON d.doc_id = out.doc_id
"""


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality_model.train(docs, labels.filter(~held_out("doc_id", 3, 1)))
    return _judged(quality_model.score(docs, model), 3, 1)


@query
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = html.main_text(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return text.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query
def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan(docs, licenses.train(docs))
    families = F.array_sort(F.array_distinct(F.col("licenses.family")))
    spans = F.transform(
        "licenses", lambda s: F.concat_ws(":", s["family"], s["start"], s["end"])
    )
    return found.select(
        "doc_id",
        F.size("licenses").cast("bigint").alias("n_notices"),
        F.array_join(families, ",").alias("families"),
        F.array_join(spans, ",").alias("spans"),
        F.round(F.array_max(F.col("licenses.probability")), 4).alias("probability"),
    )


@query
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = centroids.cluster(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    # One row for each of the 16 clusters, so both sides of the join below are small.
    own = done.rows.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("of_cluster")
    )
    whole = own.agg(F.sum("of_cluster").cast("bigint").alias("inertia"))
    digests = spark.createDataFrame(
        list(enumerate(done.digests())), "cluster int, centroid_sha256 string"
    )
    sums = own.select("cluster", F.col("of_cluster").cast("bigint").alias("cluster_inertia"))
    about = digests.join(sums, "cluster").join(F.broadcast(whole))
    return done.rows.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _centroid_sql(rounds: int = centroids.ROUNDS) -> str:
    dot = """list_sum(list_transform(range(1, 65), lambda j: (v[j] - c[j]) * (v[j] - c[j])))"""

    def assign(r: int) -> str:
        return f"""a{r} AS (
  SELECT vec_id, any_value(v) AS v, CAST(arg_min(k, (d, k)) AS INTEGER) AS cluster, CAST(min(d) AS BIGINT) AS distance
  FROM (SELECT n, vec_id, v, k, {dot} AS d FROM kept, c{r}) GROUP BY n, vec_id)"""

    def move(r: int) -> str:
        return f"""s{r} AS (
  SELECT cluster AS k, list(m ORDER BY j) AS c FROM (
    SELECT cluster, j, CAST((sum(v[j]) - ((sum(v[j]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
    FROM a{r - 1}, unnest(range(1, 65)) AS t(j) GROUP BY cluster, j) GROUP BY cluster),
c{r} AS (SELECT c{r - 1}.k, coalesce(s{r}.c, c{r - 1}.c) AS c FROM c{r - 1} LEFT JOIN s{r} ON c{r - 1}.k = s{r}.k)"""

    steps = [assign(0)]
    for r in range(1, rounds + 1):
        steps += [move(r), assign(r)]
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS n, vec_id,
         list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = 64),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS INTEGER) AS k, v AS c
       FROM (SELECT sha256('1:' || CAST(vec_id AS VARCHAR)) AS h, v FROM kept ORDER BY h NULLS LAST, v LIMIT 16)),
{", ".join(steps)}
SELECT vec_id, cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON k = cluster
"""


SQL["op13_centroids"] = _centroid_sql()


@query
def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.drop_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


SQL["op11_repeats"] = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, list_slice(w, i, i + 19) AS g FROM d, unnest(range(1, len(w) - 18)) AS t(i) WHERE len(w) > 19),
again AS (SELECT doc_id, i FROM (
    SELECT doc_id, i, min((doc_id, i)) OVER (PARTITION BY g) AS lowest FROM win) WHERE (doc_id, i) <> lowest),
gone AS (SELECT doc_id, list(DISTINCT k) AS ks FROM again, unnest(range(i, i + 20)) AS t(k) GROUP BY doc_id),
kept AS (SELECT d.doc_id, len(w) AS n, coalesce(len(ks), 0) AS n_gone,
                CASE WHEN ks IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1),
                  lambda k: NOT list_contains(ks, k)), lambda k: w[k]) END AS words
         FROM d LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n_gone AS BIGINT) AS n_removed,
       sha256(array_to_string(words, ' ')) AS kept_sha256 FROM kept
"""


@query
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    report = conversations.Repair(conversations.damaged(turns)).report()
    every = turns.select(F.col("conv_id").alias("_conv")).distinct()
    whole = every.join(report, F.col("_conv").eqNullSafe(F.col("conv_id")), "left")
    empty = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    values = [
        F.coalesce(F.col(n), empty.get(n, F.lit(0).cast("bigint"))).alias(n)
        for n, _ in conversations.REPORT
    ]
    return whole.select(F.col("_conv").alias("conv_id"), *values)


def _crc_table() -> str:
    """The 256 remainders of the CRC-32 polynomial, reflected."""
    out = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        out.append(value)
    return ", ".join(map(str, out))


def _conversation_sql() -> str:
    line, far = "chr(10)", 10**9

    def row(letter: str, cost: str, state: int, out: str | None = None) -> str:
        text = f"v[{state + 1}].o" if out is None else f"{line} || {out} || v[{state + 1}].o"
        return f"{{'c': v[{state + 1}].c + {cost}, 'a': '{letter}' || v[{state + 1}].a, 'o': {text}}}"

    def own(state: int) -> str:
        due = conversations.DUE[state]
        name = conversations.ROLES[due]
        legal = f"h = '{name[0]}'" + (" OR h = 's'" if state == 0 else "")
        target = f"CASE WHEN h = 's' THEN {{}} ELSE {{}} END" if state == 0 else "{1}"
        kept = target.format(row("K", "p", 1, "role || ':' || t"), row("K", "p", due, "role || ':' || t"))
        never = f"{{'c': CAST({far} AS BIGINT), 'a': '', 'o': ''}}"
        return (
            f"list_min([{row('D', '2', state)}, CASE WHEN must OR NOT ({legal}) THEN {never} ELSE {kept} END, "
            f"CASE WHEN must THEN {never} ELSE {row('R', 'p + 1', due, f'{chr(39)}{name}:{chr(39)} || t')} END])"
        )

    def inserted(column: str, state: int) -> str:
        name = conversations.ROLES[conversations.DUE[state]]
        return f"{{'c': {column}.c + 5, 'a': 'I' || {column}.a, 'o': {line} || '{name}:' || {column}.o}}"

    start = ", ".join(
        f"{{'c': CAST({cost} AS BIGINT), 'a': '{'I' * (cost // 5)}', 'o': {out}}}"
        for cost, out in zip(
            conversations.END,
            ["''", f"{line} || 'user:' || {line} || 'assistant:'", f"{line} || 'assistant:'", "''"],
            strict=True,
        )
    )
    return f"""
WITH RECURSIVE crc AS (SELECT [{_crc_table()}] AS t),
named AS (SELECT conv_id, turn, role, text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
parts AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(name, ''), lambda x: CAST(unicode(x) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS part FROM named, crc),
hurt AS (SELECT conv_id, turn, CASE WHEN part = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN part = 1 THEN '' WHEN part = 2 THEN translate(text, '.!?', '') ELSE text END AS t
  FROM parts, unnest(CASE WHEN part = 3 THEN [1, 2] ELSE [1] END) AS u(n) WHERE part <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(t)) AS i FROM hurt),
judged AS (SELECT *, substr(role, 1, 1) AS h, rtrim(t, {_BLANKS}) AS bare,
  row_number() OVER (PARTITION BY conv_id, role, t ORDER BY i) > 1 AS again,
  lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
coded AS (SELECT conv_id, i, turn, role, t, h, before, CASE WHEN bare = '' THEN 1 WHEN again THEN 2
  WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM judged),
facts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
  count(*) FILTER (before || h NOT IN ('su', 'ua', 'au')) AS illegal FROM coded GROUP BY conv_id),
back AS (
  SELECT conv_id, n AS i, [{start}] AS v FROM facts
  UNION ALL
  SELECT conv_id, i - 1, [list_min([b0, {inserted("u", 0)}]), list_min([b1, {inserted("u", 1)}]), u, a] FROM (
    SELECT conv_id, i, b0, b1, list_min([b2, {inserted("b3", 2)}]) AS u, list_min([b3, {inserted("b2", 3)}]) AS a FROM (
      SELECT conv_id, i, {own(0)} AS b0, {own(1)} AS b1, {own(2)} AS b2, {own(3)} AS b3 FROM (
        SELECT b.conv_id, b.i, b.v, c.role, c.t, c.h, c.fault IN (1, 2) AS must, CASE WHEN c.fault = 3 THEN 5 ELSE 0 END AS p
        FROM back b JOIN coded c ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = c.i)))),
done AS (SELECT conv_id, v[1] AS best FROM back WHERE i = 0),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
  coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.o, 2), '')) AS repaired_sha256
FROM ids LEFT JOIN facts ON ids.conv_id IS NOT DISTINCT FROM facts.conv_id
LEFT JOIN done ON ids.conv_id IS NOT DISTINCT FROM done.conv_id
"""


SQL["op12_conversations"] = _conversation_sql()
