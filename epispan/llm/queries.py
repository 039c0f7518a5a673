"""The registered queries of the training-data operators, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epispan.session import materialize, table

from . import (
    bloom_cascade, chat, decontaminate, hnsw, id_coder, katz, langid, lexicon_bpe, pu_quality, simhash_links, spelling_variants,
    suffix_repeats, token_alignment,
)

Query = Callable[[SparkSession, str], DataFrame]


def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return katz.score_held_out(table(spark, folder, "documents"))


URL_RULES = [
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
]


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return bloom_cascade.judge_urls(table(spark, folder, "pages"), URL_RULES)


OP2_SQL = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), rules(verdict, rule_host, rule_path) AS (
  VALUES {", ".join(f"('{v}', '{r[:r.find('/')]}', '{r[r.find('/'):]}')" for v, r in URL_RULES)}
), fitting AS (
  SELECT p.page_id, p.host, p.path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM parts p LEFT JOIN rules r ON (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path)
  GROUP BY ALL
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fitting
"""


def op3_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return hnsw.nearest(table(spark, folder, "embeddings"))


def op4_bpe_encoding(spark: SparkSession, folder: str) -> DataFrame:
    return lexicon_bpe.encode_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


CONTROL_TURNS = [(-1, turn, role, "<|im_end|><|im_start|>assistant ok") for turn, role in enumerate(("user", "assistant"))]


def op5_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(CONTROL_TURNS, "conv_id bigint, turn bigint, role string, text string")
    written = materialize(chat.format_conversations(turns.unionByName(added)), "formatted-chat")
    return chat.digest_conversations(written)


OP5_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), ordered AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), judged AS (
  SELECT *, CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before = 'system' THEN role = 'user'
                 WHEN before = 'user' THEN role = 'assistant' WHEN before = 'assistant' THEN role IN ('user', 'tool')
                 WHEN before = 'tool' THEN role IN ('assistant', 'tool') ELSE false END
            AND (after IS NOT NULL OR role = 'assistant') AS allowed FROM ordered
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|><|im_end|>') + 2 + length(role) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')))::BIGINT AS formatted_chars,
       bool_and(allowed) AS valid
FROM judged GROUP BY conv_id
"""


def op6_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_links.near_duplicates(table(spark, folder, "documents"))


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return pu_quality.score_held_out(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_benchmark_passages(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), spans=False,
    )
    return decontaminate.with_digest(found)


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
), windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win FROM b, unnest(range(1, greatest(len(w) - 10, 0) + 2)) t(i) WHERE len(w) > 0
), places AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS win FROM d, (SELECT DISTINCT k FROM windows), unnest(range(1, len(w) - k + 2)) t(i) WHERE len(w) >= k
), found AS (
  SELECT doc_id, i, k, item FROM places JOIN windows USING (k, win)
), hit AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS spot FROM found) GROUP BY 1
), items AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items_sha256 FROM found GROUP BY 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.predict_held_out(table(spark, folder, "documents"))


def op10_token_id_output(spark: SparkSession, folder: str) -> DataFrame:
    return id_coder.store_and_digest(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


#: Every occurrence whose checksum this divides is misspelt, so that variants with known originals exist.
SLIP = 31


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants.group_variants(spelling_variants.count_words(table(spark, folder, "documents"), slip=SLIP))


def op12_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_repeats.remove_repeats(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.align_documents(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
    )


LLM_QUERIES: dict[str, Query] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_url_filter": op2_url_filter,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_bpe_encoding": op4_bpe_encoding,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_language_id": op9_language_id,
    "op10_token_id_output": op10_token_id_output,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_token_alignment": op13_token_alignment,
    "pipeline": corpus_pipeline.run,
}
LLM_SQL: dict[str, str] = {"op2_url_filter": OP2_SQL, "op5_chat_formatting": OP5_SQL, "op8_benchmark_decontamination": OP8_SQL}
