"""The operators as queries over the driver tables, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import bpe, chat, exact, language, lines, mixing, quality, repair, runs, sharding, simhash, simple8b, toxicity

TOKENIZER = "byte_bpe_50k.json"
#: A conversation whose texts hold the template's own marks.
MARKED = r"\### Assistant: </turn> ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED)], rows.schema)
    turns, examples = chat.write_examples(rows.union(marked))
    return chat.conversation_digests(turns, examples)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


def op3_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_exact_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op5_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op6_simple8b_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.encoded_files(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op7_near_duplicate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.near_duplicate_lines(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).drop("failed_rules")


def op9_page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.page_languages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair.repaired(repair.damaged(rows), rows)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(table(spark, sf_dir, "documents"), runs.with_planted_period, collapse=False).drop("collapsed")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    function.__name__: function
    for function in (
        op1_chat_prefix_targets,
        op2_mix_sources,
        op3_simhash_components,
        op4_exact_groups,
        op5_minimax_shards,
        op6_simple8b_files,
        op7_near_duplicate_lines,
        op8_quality_rules,
        op9_page_languages,
        op10_bpe_round_trip,
        op11_conversation_repair,
        op12_toxicity,
        op13_periodic_runs,
    )
}

_ESCAPED = r"replace(replace(replace(replace({0}, '\', '\b'), '#', '\x'), ':', '\y'), '<', '\z')"

CHAT_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{MARKED}'), (-7, 1, 'assistant', '{MARKED}')
), sized AS (
  SELECT *, length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}) + 14 AS chars FROM turns
), placed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto FROM sized
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars,
       count(*) FILTER (role = 'assistant') AS n_examples,
       CAST(coalesce(sum(upto) FILTER (role = 'assistant'), 0) AS BIGINT) AS example_chars
FROM placed GROUP BY conv_id"""

EXACT_SQL = r"""
WITH spaced AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS spaced FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY spaced) AS keep_id,
       count(*) OVER (PARTITION BY spaced) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY spaced) AS kept,
       sha256(spaced) AS text_sha256
FROM spaced"""


def _bound(rule: quality.Rule) -> str:
    scale = rule.per or "1"
    parts = [f"{rule.measure} >= {rule.least} * {scale}"] if rule.least is not None else []
    parts += [f"{rule.measure} <= {rule.most} * {scale}"] if rule.most is not None else []
    return " AND ".join(parts)


_STOP = ", ".join(f"'{word}'" for word in quality.stop_forms())
QUALITY_SQL = rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, spot, count(*) OVER (PARTITION BY doc_id, words[spot], words[spot + 1], words[spot + 2]) AS n
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS spot FROM split)
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest([spot, spot + 1, spot + 2]) AS place FROM windows WHERE n > 1) GROUP BY doc_id
), measured AS (
  SELECT s.doc_id,
         len(words) AS n_words,
         length(array_to_string(words, '')) AS word_chars,
         length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(lines) AS n_lines,
         len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words,
         len(list_filter(words, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•‣–][ \t]'))) AS n_bullet_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines
  FROM split s LEFT JOIN covered c ON s.doc_id = c.doc_id
)
SELECT *, NOT ({" AND ".join(map(_bound, quality.BASE))}) AS base_failed,
       {" AND ".join(map(_bound, (*quality.BASE, *quality.RULES)))} AS kept
FROM measured"""

ORACLES: dict[str, str] = {
    "op1_chat_prefix_targets": CHAT_SQL,
    "op4_exact_groups": EXACT_SQL,
    "op8_quality_rules": QUALITY_SQL,
}
