"""The operators bound to the driver's tables: one query each, with SQL where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm import (
    decontamination, jaccard_join, line_dedup, prefix_trie, quality, secrets, sentencepiece_codec, spelling, suffix_dedup,
    token_counts, token_files, topk, toxicity,
)
from starmill.sources.staging import stage, staged_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: Unsigned crc32 of the UTF-8 bytes of a text, bit by bit.
CRC32 = """xor(list_reduce(list_transform(range(0, CAST(8 * strlen({0}) AS BIGINT)), lambda k: CASE WHEN k % 8 = 0 THEN CAST(
    16 * (strpos('0123456789ABCDEF', hex(encode({0}))[k // 4 + 1]) - 1)
    + strpos('0123456789ABCDEF', hex(encode({0}))[k // 4 + 2]) - 1 AS BIGINT) ELSE CAST(0 AS BIGINT) END),
    lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1)), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"""
ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@register(
    rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
item AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM b WHERE len(ws) > 0),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS piece
  FROM item, unnest(range(1, len(ws) - n + 2)) AS r(i)),
sizes AS (SELECT DISTINCT n FROM win),
place AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS piece
  FROM w, sizes, unnest(range(1, len(ws) - n + 2)) AS r(i)),
hit AS (SELECT doc_id, i, n, item_id FROM place JOIN win USING (n, piece)),
covered AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM hit, unnest(range(i, i + n)) AS r(j) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""
)
def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination_digests(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


LINES_SQL = rf"""
lines AS (
  SELECT doc_id, i, l, {ASCII_LOWER.format("trim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {{docs}}),
       unnest(ls) WITH ORDINALITY AS u(l, i)),
firsts AS (SELECT key, min(doc_id) AS lead FROM lines WHERE length(key) >= 10 GROUP BY key),
judged AS (SELECT doc_id, i, l, coalesce(doc_id > lead, false) AS gone FROM lines LEFT JOIN firsts USING (key))"""


@register(
    f"""
WITH {LINES_SQL.format(docs="documents")}
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""
)
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_digests(_table(spark, folder, "documents"))


@register()
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


SHINGLES_SQL = rf"""
ws AS (
  SELECT doc_id, regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws FROM {{docs}}),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + least(5, len(ws)) - 1], ' ') AS s
  FROM ws, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) AS r(i) WHERE len(ws) > 0),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
link AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id JOIN size p ON p.doc_id = x.doc_id JOIN size q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 75 * (p.n + q.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM {{docs}}
  UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)"""


@register(
    f"""
WITH RECURSIVE {SHINGLES_SQL.format(docs="documents")}
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM documents d LEFT JOIN size USING (doc_id) JOIN comp USING (doc_id)"""
)
def op8_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicate_groups(_table(spark, folder, "documents"))


#: A public model; any other SentencePiece file will do.
PIECE_MODEL = os.environ.get("PIECE_MODEL", "file:///opt/tokenizers/piece_bpe_32k.model")


@register()
def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_codec.token_digests(_table(spark, folder, "documents"), PIECE_MODEL)


@register(
    """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
win AS (SELECT doc_id, i, md5(x[2 * i + 1:2 * i + 400]) AS s FROM h, unnest(range(0, CAST(length(x) // 2 AS BIGINT) - 199)) AS r(i)),
many AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
hit AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM win SEMI JOIN many USING (s)),
mark AS (SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i > p + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hit),
span AS (SELECT doc_id, run, min(i) AS a, max(i) + 200 AS b FROM mark GROUP BY doc_id, run),
gap AS (
  SELECT h.doc_id, span.a, span.b, coalesce(lag(b) OVER (PARTITION BY h.doc_id ORDER BY a), 0) AS from_
  FROM h JOIN span USING (doc_id)),
kept AS (
  SELECT h.doc_id, string_agg(x[2 * from_ + 1:2 * a], '' ORDER BY a) AS front, max(b) AS tail,
         sum(b - a) AS n_removed, count(*) AS n_spans
  FROM h JOIN gap USING (doc_id) GROUP BY h.doc_id)
SELECT h.doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(front || x[2 * tail + 1:], x))) AS kept_sha256
FROM h LEFT JOIN kept USING (doc_id)"""
)
def op1_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.suffix_digests(_table(spark, folder, "documents"))


@register(
    """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         coalesce(CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))) AS BIGINT), 0) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5"""
)
def op9_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").selectExpr("vec_id AS id", "embedding AS vector")
    return topk.top_k(vectors, F.col("id") % 50 == 0)


@register()
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@register()
def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_spans(_table(spark, folder, "documents"))


@register(
    r"""
WITH counted AS (
  SELECT source, lang, 'words-1' AS tokenizer, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n
  FROM documents
  UNION ALL
  SELECT source, lang, 'words-2', len(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))
  FROM documents)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens
FROM counted GROUP BY ALL"""
)
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.corpus_totals(_table(spark, folder, "documents"))


#: Any tokenizers file whose words end at white space will do.
WORD_MODEL = os.environ.get("WORD_MODEL", "file://" + public_tokenizers.path("word_bpe_49k.json"))


@register()
def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = staged_path(spark, "token-files")
    token_files.write_tokens(_table(spark, folder, "documents"), WORD_MODEL, path)
    return token_files.token_checks(spark, path)


@register(
    rf"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents),
hashed AS (
  SELECT run, c, {CRC32.format("key")} AS h
  FROM (SELECT run, count(*) AS c, id || ':' || run AS key FROM runs GROUP BY id, run)),
w AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
         CAST(sum(c) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(c) >= 3),
short AS (
  SELECT word, n, length(word) AS size, i, left(word, i) || substr(word, i + 2) AS rest FROM w, unnest(range(0, length(word))) AS r(i)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM short a JOIN short b USING (rest, i, size) WHERE a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM w a JOIN short b ON a.word = b.rest
  UNION SELECT b.word, b.n, a.word, a.n FROM w a JOIN short b ON a.word = b.rest),
best AS (
  SELECT word, CASE WHEN m >= 2 * n THEN other END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n,
         count(*) OVER (PARTITION BY word) AS n_near
  FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY m DESC, other) = 1),
chain AS (
  SELECT word, word AS tip, 0 AS step FROM w
  UNION ALL SELECT chain.word, form, step + 1 FROM chain JOIN best ON best.word = chain.tip WHERE form IS NOT NULL),
ends AS (SELECT word, arg_max(tip, step) AS root FROM chain GROUP BY word)
SELECT w.word, form, root, n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, form_n
FROM w JOIN ends USING (word) LEFT JOIN best USING (word)"""
)
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_groups(_table(spark, folder, "documents"))


@register(
    f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list([role, text] ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS ts FROM t GROUP BY conv_id),
headed AS (SELECT *, {CRC32.format("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM own),
built AS (
  SELECT o.conv_id, list_concat(coalesce(b.ts, [])[1:o.h], o.ts[o.h + 1:]) AS ts
  FROM headed o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
pre AS (
  SELECT conv_id, d, sha256(CAST(to_json(ts[1:d]) AS VARCHAR)) AS key, sha256(CAST(to_json(ts[1:d - 1]) AS VARCHAR)) AS up,
         CASE WHEN d > 0 THEN length(ts[d][2]) ELSE 0 END AS size, len(ts) = d AS ended
  FROM built, unnest(range(0, len(ts) + 1)) AS r(d)),
node AS (
  SELECT key, d, any_value(up) AS up, any_value(size) AS size, min(conv_id) AS conv_id, count(*) AS n,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '') AS ends
  FROM pre GROUP BY key, d),
kids AS (SELECT up AS key, d - 1 AS d, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
full_ AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (key, d)),
below AS (
  SELECT a.key, a.d, count(*) FILTER (c.n_children = 0) AS n_leaves, sum((c.n - 1) * c.size) AS saved
  FROM full_ c JOIN pre p ON p.conv_id = c.conv_id AND p.d <= c.d JOIN full_ a ON a.key = p.key AND a.d = p.d
  GROUP BY a.key, a.d)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, f.n AS n_convs, f.n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_ f JOIN below USING (key, d) LEFT JOIN node p ON f.d > 0 AND p.key = f.up AND p.d = f.d - 1"""
)
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = stage(prefix_trie.conversation_turns(_table(spark, folder, "conversations")), "turns")
    return prefix_trie.prefix_trie(prefix_trie.with_shared_heads(turns))
