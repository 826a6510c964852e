"""Registered queries of the training-data operators: each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import divergence, embedding_dedup, language_id, license_scan, line_dedup, mixing, packing, perplexity, prefix_trie, quality_rules, simhash, substring_dedup, token_counts


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.line_dedup(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = license_scan.license_scan(_table(spark, sf_dir, "documents"))
    return scanned.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)))
    samples = language_id.learn(docs.filter("not held_out"))
    return language_id.language_id(docs.select("doc_id", "held_out", "text"), samples).select("doc_id", "held_out", "lang_pred", "score")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ruled = quality_rules.quality_rules(_table(spark, sf_dir, "documents"))
    return ruled.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = _table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return perplexity.quality_classifier(_table(spark, sf_dir, "documents"), trusted)


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_groups(_table(spark, sf_dir, "embeddings"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_best_fit(_table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.substring_dedup(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation c begins with the first h turns of c - c % 5 and goes on after its own first h; h = crc32(c) % 9."""
    own = prefix_trie.sequences(_table(spark, sf_dir, "conversations"))
    head = own.select(F.col("conv_id").alias("head_id"), F.slice("turns", 1, 8).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    both = own.join(head, F.col("conv_id") - F.col("conv_id") % 5 == F.col("head_id"), "left")
    turns = F.concat(F.slice(F.coalesce("head", F.slice("turns", 1, F.lit(0))), F.lit(1), h), F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1))))
    return prefix_trie.prefix_trie(both.select("conv_id", turns.alias("turns")))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(_table(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


REGISTRY = {f.__name__: f for f in (op1_mix_sources, op2_line_dedup, op3_license_scan, op4_language_id, op5_quality_rules, op6_quality_classifier, op7_simhash_dedup, op8_embedding_dedup, op9_best_fit_packing, op10_substring_dedup,
                                     op11_prefix_trie, op12_source_divergence, op13_token_counts)}
