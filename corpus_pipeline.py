"""Corpus pipeline: quality filter, language filter, near-duplicate removal, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read back as the next stage's ``docs``. All but the last return the columns of
``documents``. Stages keep nulls, repeated rows and empty texts as their operators define.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from staysift.llm import language_id, ngram_join, packing, quality_crf
from staysift.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches 0.3 stay."""
    model = quality_crf.fit_sample(docs, table(spark, sf_dir, "labels"))
    return quality_crf.keep_good(docs, model, 0.3)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are mostly of one known language stay."""
    return language_id.keep_identified(docs, language_id.fit_sample(docs), 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group linked by 5-word shingles at similarity 0.8."""
    return ngram_join.keep_one_each(docs, size=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 tokens. The workers still hold what the stages before needed: small
    blocks and caches."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(docs, vocabulary, 1024, 2, cache_bytes=24 << 20, block_bytes=2 << 20)


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("packing", pack)]

# the classifiers and the tokenizer have no SQL form; tests/llm holds a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
