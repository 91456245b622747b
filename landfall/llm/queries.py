"""Registered queries of the subpackage: thin digests of the operators' results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm import (
    byte_bpe,
    chat_format,
    curve_search,
    language_id,
    lm_scoring,
    paragraph_dedup,
    quality_rules,
    quartile_digest,
    ranked_search,
    simhash_dedup,
    token_counts,
    vector_packing,
    whitening,
)
from landfall.llm.common import documents, fold


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = quality_rules.judge(documents(spark, sf_dir))
    return j.select("doc_id", *quality_rules.MEASURES, "base_failed", "kept", "host_failed")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.fit(docs.filter(fold("doc_id") != 0))
    held_out = F.coalesce(fold("doc_id") == 0, F.lit(False))
    return language_id.identify(docs, model, {"doc_id": F.col("doc_id"), "held_out": held_out})


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_texts(documents(spark, sf_dir))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = simhash_dedup.simhash_groups(documents(spark, sf_dir))
    return g.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(documents(spark, sf_dir))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    text = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], turns.schema)
    return chat_format.digests(chat_format.format_conversations(turns.union(planted)))


def op8_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quartile_digest.edited_neighbours(documents(spark, sf_dir))


def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_packing.pack(documents(spark, sf_dir))


def op10_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.repeated_units(documents(spark, sf_dir)).drop("text_key")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_curve_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_search.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_language_id, op3_token_counts, op4_lm_scoring, op5_simhash_dedup, op6_byte_bpe,
    op7_chat_format, op8_quartile_digest, op9_vector_packing, op10_paragraph_dedup,
    op11_whitening, op12_ranked_search, op13_curve_search, pipeline)}

ORACLE = {
    "op1_quality_rules": r"""
WITH t AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM t)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id
), m AS (
  SELECT t.doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_capitals,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM t LEFT JOIN covered ON t.doc_id = covered.doc_id
), f AS (
  SELECT *, n_words < 20 OR n_repeat_words * 100 > n_words * 30 AS base_failed,
         n_symbols * 10 > n_words OR n_dup_lines * 100 > n_lines * 30 OR n_capitals * 2 > word_chars AS soft_failed
  FROM m
), hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (base_failed OR soft_failed) AS k FROM f GROUP BY source
), prior AS (
  SELECT p, least(1000.0, greatest(1.0, CASE WHEN extra > 0 THEN p * (1 - p) / extra - 1 ELSE 1000.0 END)) AS weight
  FROM (SELECT p, avg(pow(k / n - p, 2) - p * (1 - p) / n) AS extra FROM hosts, (SELECT sum(k) / sum(n) AS p FROM hosts) GROUP BY p)
), rates AS (
  SELECT source, (k + p * weight) / (n + weight) AS rate FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rate > 0.5 AND NOT (soft_failed AND rate > 0.02) AS kept, rate > 0.5 AS host_failed
FROM f JOIN rates ON f.source IS NOT DISTINCT FROM rates.source
""",
    "op7_chat_format": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, regexp_replace(role || chr(1) || text, '([<\[])(\\*(?:\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\]))', '\1\\\2', 'g') AS escaped FROM t
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(escaped) - 1 + length('<|im_start|><|im_sep|><|im_end|>')) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
""",
    "op12_ranked_search": r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), sizes AS (
  SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
), whole AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes
), held AS (
  SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, whole GROUP BY term
), scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), whole GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 50
""",
}
