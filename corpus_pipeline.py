"""Corpus preparation: each stage is written as Parquet and reread as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from runledger.llm.language import keep_identified
from runledger.llm.neardup import drop_copies
from runledger.llm.packing import pack
from runledger.llm.quality import keep_good
from runledger.llm.shared import documents, materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near enough to a language's centroid."""
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five words, similarity 0.8)."""
    return drop_copies(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents placed in sequences of 1024 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("packing", packing)]
#: No SQL expresses the trained stages; tests/llm compares each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
