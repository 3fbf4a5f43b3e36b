"""The operators as named queries over the test tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trialweave.llm import (
    byte_bpe,
    decontaminate,
    embedding_dedup,
    html_text,
    imatch,
    language,
    prefix_trie,
    secrets,
    simhash,
    suffix_dedup,
    token_counts,
    whitening,
    window_dedup,
)
from trialweave.llm.common import table
from trialweave.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def query(run: Query) -> Query:
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(configure(spark), sf_dir)

    QUERIES[run.__name__] = configured
    return configured


@query
def op2_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op4_decontamination(spark, sf_dir):
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(documents, benchmark).drop("items", "spans")


@query
def op6_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"), RANKS, PATTERN)


@query
def op10_secrets(spark, sf_dir):
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


@query
def op7_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_window_dedup(spark, sf_dir):
    return window_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("removed")


@query
def op5_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("removed")


@query
def op8_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op1_html_text(spark, sf_dir):
    return html_text.extract_text(table(spark, sf_dir, "pages"))


@query
def op3_token_counts(spark, sf_dir):
    edited = token_counts.with_masking_edits(table(spark, sf_dir, "documents"))
    return token_counts.count_tokens(edited, RANKS, PATTERN, "edits")


@query
def op11_whitening(spark, sf_dir):
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    # Beyond the range of a long the cast stops the query (ANSI); the operator's own column is a decimal.
    return rows.withColumn("deviation", rows["deviation"].cast("long"))


@query
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op13_imatch(spark, sf_dir):
    return imatch.fingerprint_documents(table(spark, sf_dir, "documents"))


_WORDS = "regexp_extract_all({text}, '{pattern}')"
_BENCH_WORDS = _WORDS.format(
    text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')",
    pattern=r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
)
_PLAIN_WORDS = _WORDS.format(text="text", pattern=r"[^\x20\x09-\x0D]+")

ORACLE_SQL["op4_decontamination"] = f"""
WITH items AS (
  SELECT item_id::VARCHAR AS item, {_BENCH_WORDS} AS w FROM benchmark
  WHERE item_id IS NOT NULL AND text IS NOT NULL
),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, w[i : i + least(len(w), 10) - 1] AS words
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i) WHERE len(w) > 0
),
texts AS (SELECT doc_id, coalesce({_BENCH_WORDS}, []) AS w FROM documents),
met AS (
  SELECT doc_id, i, size, item
  FROM (SELECT doc_id, i, size, w[i : i + size - 1] AS words
        FROM texts, (SELECT DISTINCT size FROM windows), unnest(range(1, len(w) - size + 2)) AS r(i))
  JOIN windows USING (size, words)
),
hits AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM met, unnest(range(i, i + size)) AS r(place)
  GROUP BY doc_id
),
names AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hits USING (doc_id) LEFT JOIN names USING (doc_id)"""

ORACLE_SQL["op8_embedding_dedup"] = """
WITH RECURSIVE vectors AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9
),
reach AS (
  SELECT vec_id, vec_id AS other FROM vectors
  UNION SELECT vec_id, b FROM reach JOIN links ON other = a
)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
       min(other) AS component_id, vec_id = min(other) AS kept
FROM reach GROUP BY vec_id"""

ORACLE_SQL["op9_window_dedup"] = f"""
WITH texts AS (SELECT doc_id, coalesce({_PLAIN_WORDS}, []) AS w FROM documents),
windows AS (
  SELECT doc_id, i, w[i : i + 12] AS words FROM texts, unnest(range(1, len(w) - 11)) AS r(i)
),
later AS (
  SELECT doc_id, i FROM windows JOIN (SELECT words, min(doc_id) AS first FROM windows GROUP BY words)
  USING (words) WHERE first < doc_id
),
gone AS (SELECT DISTINCT doc_id, place FROM later, unnest(range(i, i + 13)) AS r(place)),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS words
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM texts)
  ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)"""

# CRC-32 (reflected, polynomial 0xEDB88320) of an id's digits: a fold over the bytes and, within, their bits.
_CRC = """xor(4294967295, list_reduce(
  [4294967295] || list_transform(string_split(conv::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
  lambda crc, byte: list_reduce([xor(crc, byte)] || range(8),
    lambda c, bit: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END))))"""

ORACLE_SQL["op12_prefix_trie"] = f"""
WITH own AS (
  SELECT conv_id AS conv, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
    ORDER BY turn NULLS FIRST, coalesce(role, ''),
    sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
shares AS (SELECT conv, t, conv - conv % 100 AS base, {_CRC} % 6 AS h FROM own),
built AS (
  SELECT shares.conv, list_concat(coalesce(own.t, [])[1 : h], shares.t[h + 1 :]) AS t
  FROM shares LEFT JOIN own ON own.conv = base
),
prefixes AS (SELECT conv, d AS depth, t[1 : d] AS p, len(t) = d AS ends FROM built, unnest(range(len(t) + 1)) AS r(d)),
nodes AS (
  SELECT p, depth, min(conv) AS conv, count(*) AS n,
         sha256(coalesce(string_agg(conv::VARCHAR, ',' ORDER BY conv) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY p, depth
),
children AS (SELECT p[1 : depth - 1] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
valued AS (
  SELECT nodes.*, coalesce(children.n, 0) AS n_children,
         CASE WHEN depth > 0 THEN (nodes.n - 1) * length(p[depth].text) ELSE 0 END AS saved
  FROM nodes LEFT JOIN children USING (p)
),
sums AS (
  SELECT p[1 : d] AS p, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM valued, unnest(range(depth + 1)) AS r(d) GROUP BY 1
)
SELECT valued.conv AS conv_id, valued.depth, parent.conv AS parent_conv_id, valued.n AS n_convs, n_children,
       n_leaves, saved_tokens, valued.ends_sha256
FROM valued JOIN sums USING (p)
LEFT JOIN nodes AS parent ON valued.depth > 0 AND parent.p = valued.p[1 : valued.depth - 1]"""
