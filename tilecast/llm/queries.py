"""The registered queries of the text operators, over whole tables, and SQL for those that it can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tilecast.llm import alignment, byte_bpe, chat_format, exact_dups, fingerprints, hard_negatives, host_rules, language_id, language_model, near_dups, packing, token_files, toxicity
from tilecast.llm.text import ship


#: Where every machine has the tokenizers' files.
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: The same ids as byte_bpe_50k.json, as ranks.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark, sf_dir):
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op2_toxicity(spark, sf_dir):
    return toxicity.detect(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_chat_format(spark, sf_dir):
    rows = _table(spark, sf_dir, "conversations")
    return chat_format.chat_digest(chat_format.with_probe(rows))


def op4_fingerprints(spark, sf_dir):
    return fingerprints.imatch(_table(spark, sf_dir, "documents"))


def op5_host_rules(spark, sf_dir):
    return host_rules.quality_rules(_table(spark, sf_dir, "documents"))


def op6_token_files(spark, sf_dir):
    return token_files.token_digest(_table(spark, sf_dir, "documents"), WORDS)


def op7_byte_bpe(spark, sf_dir):
    return byte_bpe.bpe_digest(_table(spark, sf_dir, "documents"), BYTES)


def op8_near_dups(spark, sf_dir):
    return near_dups.duplicate_digest(_table(spark, sf_dir, "documents"))


def op9_language_model(spark, sf_dir):
    return language_model.score_digest(_table(spark, sf_dir, "documents"))


def op10_packing(spark, sf_dir):
    return packing.packing_digest(_table(spark, sf_dir, "documents"), WORDS)


def op11_alignment(spark, sf_dir):
    return alignment.aligned(_table(spark, sf_dir, "documents"), RANKS, PIECES)


def op12_hard_negatives(spark, sf_dir):
    return hard_negatives.mine_digest(_table(spark, sf_dir, "embeddings"))


def op13_exact_dups(spark, sf_dir):
    return exact_dups.copies_digest(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_toxicity": op2_toxicity,
    "op3_chat_format": op3_chat_format,
    "op4_fingerprints": op4_fingerprints,
    "op5_host_rules": op5_host_rules,
    "op6_token_files": op6_token_files,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_near_dups": op8_near_dups,
    "op9_language_model": op9_language_model,
    "op10_packing": op10_packing,
    "op11_alignment": op11_alignment,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_exact_dups": op13_exact_dups,
}

CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), marked AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
    length(regexp_replace(replace(text, '~', '~0'), '(<\||\[INST\]|\[/INST\]|</?s>|<</?SYS>>|</SYS>>|</?SYS>>)', '\1~1', 'g')) AS text_len,
    length(regexp_replace(replace(role, '~', '~0'), '(<\||\[INST\]|\[/INST\]|</?s>|<</?SYS>>|</SYS>>|</?SYS>>)', '\1~1', 'g')) AS role_len
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(text_len + CASE WHEN before = role THEN 8 ELSE 9 + role_len + 8 + 7 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

RULES_SQL = r"""
WITH texts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM texts, unnest(range(1, len(words) - 1)) AS t(i)
), twice AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
), measured AS (
  SELECT r, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    len(lines) AS n_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM texts LEFT JOIN covered USING (r)
), failed AS (
  SELECT *, n_words < 50 AS f1, 100 * n_repeat_words > 50 * n_words AS f2, 10 * n_symbols > 3 * word_chars AS f3,
    10 * n_dup_lines > 5 * n_lines AS f4
  FROM measured
), hosts AS (
  SELECT source, rule, count(*) AS n, count(*) FILTER (f) AS k
  FROM (SELECT source, unnest([1, 2, 3, 4]) AS rule, unnest([f1, f2, f3, f4]) AS f FROM failed) GROUP BY ALL
), priors AS (
  SELECT rule, avg(k / n) AS m, CASE WHEN var_pop(k / n) > 0 THEN least(greatest(avg(k / n) * (1 - avg(k / n)) / var_pop(k / n) - 1, 2), 1000) ELSE 1000 END AS w
  FROM hosts GROUP BY rule
), verdicts AS (
  SELECT source, max((k + w * m) / (n + w)) <= 0.5 AS host_kept FROM hosts JOIN priors USING (rule) GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
  NOT (f1 OR f2) AND host_kept AS kept
FROM failed JOIN verdicts ON failed.source IS NOT DISTINCT FROM verdicts.source
"""

COPIES_SQL = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM texts WINDOW w AS (PARTITION BY norm ORDER BY n_chars DESC, doc_id NULLS LAST)
"""

NEGATIVES_SQL = """
WITH base AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM base a JOIN base b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3
"""

ORACLE = {"op3_chat_format": CHAT_SQL, "op5_host_rules": RULES_SQL, "op12_hard_negatives": NEGATIVES_SQL, "op13_exact_dups": COPIES_SQL}
