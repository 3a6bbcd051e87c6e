"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, chunk_encoding, divergence, extraction, histogram_packing, jaccard, outliers, packing, prefix_trie, quality, substrings,
               token_counts, vectors)

PIECES, WORDS, BYTES, BYTE_RANKS = "piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(_table(spark, sf_dir, "pages"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS)))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


HARD_TURN = "\\### Assistant: </turn> ok"


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = (spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HARD_TURN).alias("text")))
    return chat.digests(chat.format_examples(talks.unionByName(hard)))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = outliers.quality_rules(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_bpe_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_encoding.encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTES), public_tokenizers.path(BYTE_RANKS))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"), n=3, percent=90)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTES), public_tokenizers.path(BYTE_RANKS))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


_ESCAPED = r"replace(replace(replace({0}, '\', '\0'), '###', '\1'), '</turn>', '\2')"

OP5_SQL = rf"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{HARD_TURN}' UNION ALL SELECT -7, 1, 'assistant', '{HARD_TURN}'),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    count(*) OVER (PARTITION BY conv_id) AS n,
    length('### ' || replace({_ESCAPED.format('role')}, ':', '\3') || ': ' || {_ESCAPED.format('text')} || '</turn>' || chr(10)) AS size
  FROM said),
summed AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS so_far FROM placed)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY i), '')) AS loss_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' OR i = n THEN so_far END), 0)::BIGINT AS formatted_chars
FROM summed GROUP BY conv_id"""

OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS size FROM v),
link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.9),
reach(node, c) AS (SELECT vec_id, vec_id FROM u UNION SELECT y, c FROM reach JOIN link ON x = node WHERE c < y),
best AS (SELECT node, min(c) AS c FROM reach GROUP BY node),
n AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN best ON node = vec_id LEFT JOIN n ON n.x = vec_id"""

_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

OP9_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
link AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach(node, c) AS (SELECT doc_id, doc_id FROM w UNION SELECT y, c FROM reach JOIN link ON x = node WHERE c < y),
best AS (SELECT node, min(c) AS c FROM reach GROUP BY node)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN best ON node = w.doc_id"""

OP10_SQL = f"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) >= 13)),
m AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM win JOIN m USING (g), range(0, 13) AS r(k) WHERE doc_id > m),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id"""

# crc32 of the decimal digits, bit by bit
_CRC = ("xor(list_reduce(list_transform(string_split({0}::VARCHAR, ''), lambda d: ascii(d)::BIGINT), lambda crc, byte: list_reduce([0, 1, 2, 3, 4, 5, 6, 7],"
        " lambda x, bit: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(crc, byte)), 4294967295::BIGINT), 4294967295)")

OP11_SQL = f"""
WITH said AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, md5(length(coalesce(role, '')) || ':' || coalesce(role, '')
    || coalesce(text, '')) AS item FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, item, length(text) AS chars, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, item) AS pos FROM said),
convs AS (SELECT c, {_CRC.format("c")} % 6 AS h, c - c % 100 AS base, n FROM (SELECT c, count(*) AS n FROM own GROUP BY c)),
heads AS (SELECT a.c, a.h, a.base, least(a.h, coalesce(b.n, 0)) AS given FROM convs a LEFT JOIN convs b ON b.c = a.base),
turns AS (
  SELECT heads.c, pos AS d, item, chars FROM heads JOIN own ON own.c = heads.base AND pos <= given
  UNION ALL SELECT heads.c, given + pos - h, item, chars FROM heads JOIN own ON own.c = heads.c AND pos > h),
seq AS (SELECT heads.c, string_agg(item, '' ORDER BY d) AS items, list(chars ORDER BY d) AS chars, count(item) AS size
  FROM heads LEFT JOIN turns ON turns.c = heads.c GROUP BY heads.c),
prefix AS (SELECT c, size, d, chars[d] AS chars, coalesce(items[1:32 * d], '') AS key FROM seq, unnest(range(0, size + 1)) AS r(d)),
node AS (SELECT key, d, min(c) AS c, count(*) AS n, any_value(chars) AS chars,
  sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (size = d), '')) AS ends FROM prefix GROUP BY key, d),
kids AS (SELECT key[1:32 * (d - 1)] AS key, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
own_total AS (SELECT node.*, coalesce(kids.n, 0) AS kids FROM node LEFT JOIN kids ON kids.key = node.key),
total AS (SELECT key[1:32 * a] AS key, count(*) FILTER (kids = 0) AS leaves, sum((n - 1) * coalesce(chars, 0)) AS saved
  FROM own_total, unnest(range(0, d + 1)) AS r(a) GROUP BY 1)
SELECT o.c AS conv_id, o.d AS depth, p.c AS parent_conv_id, o.n AS n_convs, o.kids AS n_children, leaves AS n_leaves,
  saved::BIGINT AS saved_tokens, o.ends AS ends_sha256
FROM own_total o JOIN total ON total.key = o.key LEFT JOIN node p ON p.d = o.d - 1 AND p.key = o.key[1:32 * (o.d - 1)]"""

OP13_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
word AS (SELECT i, lang, source, unnest(w) AS t FROM doc),
kept AS (SELECT lang, t FROM word GROUP BY lang, t HAVING count(DISTINCT i) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM doc),
n AS (SELECT lang, source, t, count(*) AS n FROM word JOIN kept USING (lang, t) GROUP BY ALL),
cell AS (SELECT g.lang, g.source, kept.t, coalesce(n, 0) AS n FROM g JOIN kept ON kept.lang = g.lang
  LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.t = kept.t),
rate AS (SELECT *, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p FROM cell JOIN v USING (lang)),
whole AS (SELECT lang, t, sum(n) AS n FROM cell GROUP BY lang, t),
base AS (SELECT lang, t, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q FROM whole JOIN v USING (lang)),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM rate a JOIN rate b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source
  GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
term AS (SELECT lang, source, 'term' AS part, t AS item, (p - q)::BIGINT AS value FROM rate JOIN base USING (lang, t) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, r::INTEGER AS rank FROM ranked WHERE part = 'pair' OR r <= 50"""

QUERIES = {f.__name__: f for f in (op1_quality_classifier, op2_html_extraction, op3_best_fit_packing, op4_token_counts, op5_chat_formatting,
                                   op6_quality_rules, op7_embedding_near_dedup, op8_bpe_chunk_reuse, op9_ngram_jaccard_join, op10_substring_dedup,
                                   op11_conversation_prefix_trie, op12_histogram_packing, op13_source_divergence)}
SQL_CHECKS = {"op5_chat_formatting": OP5_SQL, "op7_embedding_near_dedup": OP7_SQL, "op9_ngram_jaccard_join": OP9_SQL,
              "op10_substring_dedup": OP10_SQL, "op11_conversation_prefix_trie": OP11_SQL, "op13_source_divergence": OP13_SQL}
