"""The registered queries: each operator with production parameters on its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm import chat_format, decontaminate, hard_negatives, language, line_dedup, neighbours, ngram_join, packing, secrets, substring_dedup, suffix_dedup, token_files, whitening
from earshot.llm.common import table
from earshot.llm.encoding import vocabulary_path


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_path())


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), vocabulary_path())


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.digests(chat_format.chats(chat_format.with_planted(table(spark, sf_dir, "conversations"))))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.with_moved_labels(table(spark, sf_dir, "embeddings"))
    return hard_negatives.mine(rows, hard_negatives.is_anchor)


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_suffix_dedup, op3_substring_dedup, op4_packing, op5_token_files, op6_ngram_join, op7_decontaminate, op8_secrets, op9_language, op10_neighbours, op11_chat_format, op12_whitening, op13_hard_negatives)}
ORACLES: dict[str, str] = {"op1_line_dedup": line_dedup.ORACLE, "op3_substring_dedup": substring_dedup.ORACLE, "op6_ngram_join": ngram_join.ORACLE, "op11_chat_format": chat_format.ORACLE, "op13_hard_negatives": hard_negatives.ORACLE}
