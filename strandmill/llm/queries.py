"""Registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.llm import bpe, chat, exact_dedup, fuzzy_passages, licenses, mixing, quality, simhash, suffix_dedup, token_counts

VOCABULARY = "byte_bpe_50k.json"
OWN_CHAT = "</s>[INST] ok [/INST]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    return public_tokenizers.path(VOCABULARY)


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary_path())


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary_path())


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.element_at(F.array(F.lit("user"), F.lit("assistant")), F.col("id").cast("int") + 1).alias("role"),
        F.lit(OWN_CHAT).alias("text"),
    )
    chats = chat.format_chats(rows.unionByName(own))
    turns = chat.read_turns(F.col("formatted"))
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    loss = chat.loss_text(F.col("segments"))
    read = chats.withColumn("turns", turns).withColumn("loss", loss)
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "n_bad_turns",
        "complete",
    )


OP7_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), k AS (
  SELECT *, CASE WHEN role IN ('system', 'user', 'assistant') THEN role END AS known,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nth FROM t
), b AS (SELECT *, lag(known IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY nth) AS before FROM k
), w AS (
  SELECT *, CASE WHEN (role = 'system' AND before IS NULL) OR (role = 'user' AND coalesce(before, 'system') <> 'user')
    OR (role = 'assistant' AND before = 'user') THEN 0 ELSE 1 END AS bad FROM b
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY nth), '')) AS loss_sha256,
  CAST(sum(16 + length(replace(replace(replace(replace(role, chr(92), 'xx'), '<', 'xx'), '[', 'xx'), ']', 'xx'))
    + length(replace(replace(replace(text, chr(92), 'xx'), '<', 'xx'), '[', 'xx'))) AS BIGINT) AS formatted_chars,
  CAST(sum(bad) AS BIGINT) AS n_bad_turns,
  sum(bad) = 0 AND arg_max(role, nth) = 'assistant' AS complete
FROM w GROUP BY conv_id
"""


def op6_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_passages.shared_passages(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


OP8_SQL = """
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (SELECT text_sha256, min(doc_id) AS keep_id, CAST(count(*) AS BIGINT) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_licenses": op1_licenses,
        "op2_mixing": op2_mixing,
        "op3_quality": op3_quality,
        "op4_bpe": op4_bpe,
        "op5_token_counts": op5_token_counts,
        "op6_fuzzy_passages": op6_fuzzy_passages,
        "op7_chat": op7_chat,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_simhash": op9_simhash,
        "op10_suffix_dedup": op10_suffix_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op7_chat": OP7_SQL, "op8_exact_dedup": OP8_SQL}
