"""The operators over the driver tables: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import (decontamination, jaccard, language, mixing, personal, quality,
                           resampling, secrets_scan, sharding, simhash, substrings, toxicity,
                           vector_codes)
from shelfwise.llm.samples import held_out
from shelfwise.llm.store import table


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_language(spark, sf_dir):
    return language.identify_documents(_documents(spark, sf_dir)).select(
        "doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")


def op2_quality(spark, sf_dir):
    return quality.host_quality(_documents(spark, sf_dir), ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op3_toxicity(spark, sf_dir):
    return toxicity.score_documents(_documents(spark, sf_dir), table(spark, sf_dir, "labels")) \
        .select("doc_id", held_out(4, 2).alias("held_out"), "score", "predicted")


def op4_mixing(spark, sf_dir):
    return mixing.mix(_documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken")


def op5_sharding(spark, sf_dir):
    return sharding.shard_table(_documents(spark, sf_dir))


def op6_substrings(spark, sf_dir):
    return substrings.remove_repeats(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_decontamination(spark, sf_dir):
    return decontamination.benchmark_overlaps(
        _documents(spark, sf_dir), table(spark, sf_dir, "benchmark")) \
        .select("doc_id", "item_id", "doc_word", "equal_words")


def op8_secrets(spark, sf_dir):
    return secrets_scan.digest(secrets_scan.scan_secrets(_documents(spark, sf_dir)))


def op9_personal(spark, sf_dir):
    return personal.digest(personal.find_personal(_documents(spark, sf_dir)))


def op10_jaccard(spark, sf_dir):
    return jaccard.similar_documents(_documents(spark, sf_dir)).select(
        "doc_id", "n_shingles", "component_id")


def op11_vector_codes(spark, sf_dir):
    return vector_codes.encode(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_simhash(spark, sf_dir):
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op13_resampling(spark, sf_dir):
    return resampling.resample(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark")) \
        .select("doc_id", "n_features", "weight", "score", "rank")


def queries():
    return {f.__name__: f for f in (
        op1_language, op2_quality, op3_toxicity, op4_mixing, op5_sharding, op6_substrings,
        op7_decontamination, op8_secrets, op9_personal, op10_jaccard, op11_vector_codes, op12_simhash,
        op13_resampling)}
