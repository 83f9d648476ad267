"""One query per operator over its whole table, and SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import bpe, classifier, dedup, html, licenses, lm, near, packing, quality, shards, spelling, toxicity, trie

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.deduplicate(table(spark, folder, "documents"))


ORACLES["op2_exact_dedup"] = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{dedup.A_TO_Z}', '{dedup.A_TO_Z.lower()}') AS plain FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(plain) AS text_sha256
FROM d WINDOW w AS (PARTITION BY plain)
"""


@query
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"))


@query
def op4_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_duplicates(table(spark, folder, "documents"))


@query
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), with_ids=False)


@query
def op6_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages"))


@query
def op7_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shards.round_trip(table(spark, folder, "documents"))


@query
def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@query
def op9_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(table(spark, folder, "documents"))


@query
def op10_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_decode(table(spark, folder, "documents"))


# crc32 by its table: 3988292384 is the reversed polynomial, 4294967295 the start and the last exclusive or
CRCS = """crcs AS (
  SELECT list(list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY n) AS t
  FROM range(256) AS r(n))"""


def crc_of(codes: str) -> str:
    """SQL for the crc32 of a list of byte values."""
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda a, x: xor(a >> 8, crcs.t[xor(a, x) % 256 + 1])), 4294967295)"


@query
def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.conversation_trie(table(spark, folder, "conversations"))


ORACLES["op11_conversation_trie"] = f"""
WITH {CRCS},
turns AS (
  SELECT conv_id AS c, strlen(coalesce(text, '')) AS bytes, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS sha,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT c, c - c % 5 AS base, CASE WHEN c % 5 = 0 THEN 0 ELSE {crc_of("list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)")} % 9 END AS skip
  FROM (SELECT DISTINCT c FROM turns), crcs),
parts AS (
  SELECT i.c, 0 AS part, t.pos, t.sha, t.bytes FROM ids i JOIN turns t ON t.c = i.base AND i.c <> i.base AND t.pos <= i.skip
  UNION ALL SELECT i.c, 1, t.pos, t.sha, t.bytes FROM ids i JOIN turns t ON t.c = i.c AND t.pos > i.skip),
whole AS (
  SELECT i.c, coalesce(list(p.sha ORDER BY part, pos) FILTER (p.sha IS NOT NULL), []) AS s, list(p.bytes ORDER BY part, pos) AS b
  FROM ids i LEFT JOIN parts p ON p.c = i.c GROUP BY i.c),
prefixes AS (SELECT c, s, b, d, s[1:d] AS k FROM whole, unnest(range(len(s) + 1)) AS u(d)),
nodes AS (
  SELECT d, k, min(c) AS c, count(*) AS n, (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE max(b[d]) END AS own,
    count(DISTINCT s[1:d + 1]) FILTER (len(s) > d) AS kids, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(s) = d), '') AS ends
  FROM prefixes GROUP BY d, k),
below AS (
  SELECT up, k[1:up] AS k, sum(own) AS saved, count(*) FILTER (kids = 0) AS leaves FROM nodes, unnest(range(d + 1)) AS u(up) GROUP BY ALL)
SELECT v.c AS conv_id, v.d AS depth, p.c AS parent_conv_id, v.n AS n_convs, v.kids AS n_children, b.leaves AS n_leaves,
  b.saved::BIGINT AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM nodes v JOIN below b ON b.up = v.d AND b.k = v.k LEFT JOIN nodes p ON p.d = v.d - 1 AND p.k = v.k[1:v.d - 1] AND v.d > 0
"""


@query
def op12_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classifier.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


ORACLES["op13_spelling_variants"] = f"""
WITH RECURSIVE {CRCS},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{dedup.A_TO_Z}', '{dedup.A_TO_Z.lower()}'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run
    FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
marked AS (
  SELECT run, n, {crc_of("flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195, unicode(x) - 64] END))")} AS h
  FROM runs, crcs),
spelt AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM marked),
words AS (SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) AS u(k)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.k = b.k AND a.rest = b.rest WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS other, max(m) AS m FROM near GROUP BY word),
linked AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= 10 * w.n THEN b.other END AS form, CASE WHEN b.m >= 10 * w.n THEN b.m END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
chain(word, tip) AS (
  SELECT word, word FROM linked
  UNION ALL SELECT c.word, l.form FROM chain c JOIN linked l ON l.word = c.tip WHERE l.form IS NOT NULL)
SELECT l.word, l.form, c.tip AS root, l.n, l.n_near, l.form_n
FROM linked l JOIN chain c ON c.word = l.word JOIN linked e ON e.word = c.tip AND e.form IS NULL
"""


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
