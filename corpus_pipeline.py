"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, mixing, token digests.

Each stage takes (spark, docs, sf_dir) and works on all rows it is given; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import bpe, line_dedup, mixing, ngram_join, quality
from tallyloom.llm.common import columns_of
from tallyloom.session import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rejected documents, and failing lines of the others."""
    return quality.keep_good(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that an earlier document has; a document may be left without text."""
    deduped = line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))
    return deduped.select(*columns_of(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group of near duplicates."""
    return ngram_join.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that the mix takes, in training order."""
    return mixing.training_order(docs).select(*columns_of(docs))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes, one row per copy."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("mixing", mix_sources),
    ("byte_bpe", encode_tokens),
]

# Byte-pair encoding has no SQL form; tests compare run() with a plain program.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
