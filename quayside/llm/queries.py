"""Registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table, and derives the digest columns.

``ORACLE`` has the DuckDB statement where SQL can express the result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import read_table

from . import boosted_quality, hard_negatives, html_main, licence_scan, line_rules, metric_join, mixture_shards, ngram_join, phrase_mining, prefix_bpe, reply_trees, token_counts, vector_packing
from .shared import Scratch

SHARDS = 24
TOKEN_LIMIT = 512
SEQUENCE_TOKENS = 1024
SEQUENCE_SEGMENTS = 64
SEQUENCE_LOSS = 1020  # of a sequence's tokens, those that bear loss
ACCEPTED_SCORE = 0.7
NEAR_COSINE = 0.9
PHRASE_LEAST = 30
PHRASE_WORDS = 4
PHRASES = 2000


def op1_page_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract_main_text(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars", "n_lines", "n_shared")


def op2_ngram_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_groups(read_table(spark, sf_dir, "documents"))


def op3_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = line_rules.measure(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rules.select("doc_id", *[f"rules.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op4_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return prefix_bpe.encode_digests(read_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op5_mixture_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = mixture_shards.interleave(read_table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "stratum")


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = metric_join.near_vectors(read_table(spark, sf_dir, "embeddings"), NEAR_COSINE)
    return near.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), TOKEN_LIMIT)


def op8_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                         SEQUENCE_TOKENS, SEQUENCE_SEGMENTS, SEQUENCE_LOSS)


def op9_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = boosted_quality.train(docs, read_table(spark, sf_dir, "labels"))
    scored = boosted_quality.score(docs, model)
    return scored.select("doc_id", boosted_quality.held_out().alias("held_out"), "score", (F.col("score") >= ACCEPTED_SCORE).cast("int").alias("predicted"))


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licence_scan.scan_licences(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"), "licence_kind")


def op11_setm_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrases = phrase_mining.mine_phrases(read_table(spark, sf_dir, "documents"), PHRASE_LEAST, PHRASE_WORDS)
    return phrase_mining.best_of_each_language(phrases, PHRASES).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_zone_map_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.pmod("vec_id", F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(vectors.withColumn("label", moved), F.pmod("vec_id", F.lit(50)) == 0)


def op13_reply_tree_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = F.lit("<|im_end|><|im_start|>assistant ok").alias("text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), planted)
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").unionAll(extra)
    scratch = Scratch(spark, "replies")
    trees = reply_trees.chains(rows, "conv_id", "turn", "role", "text", scratch)
    chats = reply_trees.format_paths(trees, scratch=scratch)
    read = chats.select(F.col("tree").alias("conv_id"), reply_trees.read_back(F.col("formatted")).alias("said"), F.length("formatted").cast("long").alias("formatted_chars"),
                        F.array_join(reply_trees.under_loss(F.col("formatted"), F.col("turns")), "").alias("loss"))
    lines = F.array_join(F.transform("said", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("said").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


QUERIES = {f.__name__: f for f in (
    op1_page_main_text, op2_ngram_groups, op3_line_rules, op4_prefix_bpe, op5_mixture_shards, op6_near_vectors, op7_token_counts,
    op8_vector_packing, op9_boosted_quality, op10_licence_scan, op11_setm_phrases, op12_zone_map_negatives, op13_reply_tree_chats)}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_ENDS = "[" + "".join("\\" + c if c in "\"')]}.!?" else c for c in line_rules.TERMINAL) + r"][\x20\x09-\x0D]*\z"

ORACLE = {
    "op2_ngram_groups": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * shared >= 80 * (nx.n + ny.n - shared)),
e AS (SELECT x AS a, y AS b FROM l UNION SELECT y, x FROM l),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(w.doc_id, min(coalesce(r.b, w.doc_id))) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.a = w.doc_id GROUP BY w.doc_id""",
    "op3_line_rules": rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
lines AS (
  SELECT doc_id, line, length(translate(line, {_SPACES}, '')) AS chars, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE translate(line, {_SPACES}, '') <> ''),
judged AS (
  SELECT *, (NOT regexp_matches(line, {_quoted(_ENDS)}) AND n < 12)
    OR 10 * (length(line) - length(translate(line, {_quoted(line_rules.SYMBOLS)}, ''))) > chars
    OR 10 * (length(line) - length(translate(line, '!', ''))) > chars
    OR (length(line) - length(translate(line, {_quoted(line_rules.MENU_MARKS)}, '')) >= 3
        AND 4 * (length(line) - length(translate(line, {_quoted(line_rules.MENU_MARKS)}, ''))) >= n)
    OR (n <= 30 AND regexp_matches(lower(line), {_quoted("|".join(line_rules.BOILERPLATE))})) AS fails
  FROM lines),
l AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS dup, sum(CASE WHEN fails THEN chars ELSE 0 END) AS lost FROM judged GROUP BY doc_id),
g AS (
  SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i, unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) AS g
  FROM d WHERE len(ws) >= 5),
rep AS (
  SELECT doc_id, count(DISTINCT spot) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2, i + 3, i + 4]) AS spot FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1)
  GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(ws) AS n_words, length(translate(text, {_SPACES}, '')) AS word_chars,
    length(text) - length(translate(text, {_quoted(line_rules.SYMBOLS)}, '')) AS n_symbols,
    coalesce(l.dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(l.lost, 0) AS lost
  FROM d LEFT JOIN l USING (doc_id) LEFT JOIN rep USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT 100 * lost > 50 * word_chars AS kept
FROM m""",
    "op11_setm_phrases": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS k)),
f AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
above AS (
  SELECT lang, g, max(f) AS above FROM (SELECT lang, g[:k - 1] AS g, f FROM f WHERE k > 2 UNION ALL SELECT lang, g[2:] AS g, f FROM f WHERE k > 2)
  GROUP BY ALL),
c AS (
  SELECT f.lang, f.g, f.f AS a, unnest(range(1, f.k)) AS cut FROM f LEFT JOIN above USING (lang, g)
  WHERE f.k > 1 AND (above IS NULL OR 100 * above < 80 * f.f)),
s AS (
  SELECT c.*, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.g = c.g[:cut] JOIN f y ON y.lang = c.lang AND y.g = c.g[cut + 1:]),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank,
  array_to_string(g, ' ') AS phrase, a, l, r, n, score
FROM best JOIN n USING (lang) QUALIFY rank <= 2000""",
    "op12_zone_map_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3""",
    "op13_reply_tree_chats": r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, t, CASE t WHEN 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok' FROM (SELECT unnest([0, 1]) AS t)),
c AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(24 + length(role) + length(text) + len(regexp_extract_all(text, '<\\*\|')))::BIGINT AS formatted_chars
  FROM said GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM c""",
    "op6_near_vectors": """
WITH RECURSIVE v AS (
  SELECT vec_id, CASE WHEN len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN embedding::DOUBLE[] END AS e FROM embeddings),
l AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS least FROM r GROUP BY x),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, least(v.vec_id, coalesce(c.least, v.vec_id)) AS component_id,
  v.vec_id = least(v.vec_id, coalesce(c.least, v.vec_id)) AS kept
FROM v LEFT JOIN n ON n.x = v.vec_id LEFT JOIN c ON c.x = v.vec_id""",
}
