"""A corpus, cleaned and packed for training, in five stages.

Each stage reads what its predecessor kept, as Parquet in the shared folder,
and returns the columns of ``documents``; the last returns packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import decontaminate, language_id, packing, secret_scan, simhash_dedup
from tallyspark.llm.common import delete, read_table, scratch, stored
from tallyspark.session import shared_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language that the corpus teaches go."""
    return language_id.keep_identified(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash_dedup.one_per_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by their kind."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of one length."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: SQL cannot express the stages; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the last stage's output stays in the shared folder."""
    docs, before = read_table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        path = shared_dir(spark, f"stage-{name}")
        try:
            with scratch(spark):
                docs = stored(stage(spark, docs, sf_dir), name, path)
        except BaseException:
            delete(spark, [path])
            raise
        finally:
            delete(spark, before)
        before = [path]
    return docs
