"""The registered queries: each applies its operator, with its production
parameters, to the whole table and returns the whole result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import (
    decontaminate, filter_audit, fingerprint, language_id, license_scan, packing, quality, role_repair,
    secret_scan, simhash_dedup, spelling_variants, substring_dedup, token_counts,
)
from tallyspark.llm.common import read_table


def op1_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return role_repair.repair(read_table(spark, sf_dir, "conversations"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans",
                        "n_random")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = fingerprint.edited_fingerprints(read_table(spark, sf_dir, "documents"))
    return prints.select(
        "doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        fingerprint.as_text(F.col("print")).alias("fingerprint"),
        fingerprint.as_text(F.col("edited_print")).alias("edited_fingerprint"),
        "near_edited", "near_next")


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicate_groups(read_table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeated_passages(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed",
                       F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(read_table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_50k.json"),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_passages(read_table(spark, sf_dir, "documents"),
                                               read_table(spark, sf_dir, "benchmark"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"),
                                public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read_table(spark, sf_dir, "documents"),
                                 read_table(spark, sf_dir, "labels"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"),
                               filter_audit.text_filters(), copies="E")
    return found.drop("orders_reaching", "orders_leaving")


def _license_digest(docs: DataFrame) -> DataFrame:
    base = F.filter("notices", lambda x: x["base"])
    return license_scan.scan(docs).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(base["word"]).alias("first_word"), F.array_max(base["word"]).alias("last_word"),
        license_scan.joined(base["label"]).alias("base_labels"),
        license_scan.joined(F.concat(F.col("notices.label"), F.flatten("expressions.labels"))).alias("labels"),
        "score",
        license_scan.joined(F.concat(F.col("notices.label"), F.flatten("expressions.chosen"))).alias("chosen"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _license_digest(read_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(read_table(spark, sf_dir, "documents"))


QUERIES = {name: fn for name, fn in globals().items() if name.startswith("op")}

#: The others have no SQL form that is usable on whole tables.
ORACLE: dict[str, str] = {"op11_filter_audit": filter_audit.AUDIT_SQL}
