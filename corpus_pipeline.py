"""The training-corpus pipeline: five stages over ``documents``, each stored and reread by the next.

Toxic documents go, one document of each near-duplicate group stays, repeated
passages are cut out, documents holding a benchmark item go, the rest is encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import byte_bpe, decontaminate, minhash, suffix_dedup, toxicity
from ledgerline.llm.common import stored, table

#: What SQL cannot express (signatures, learned scores, tokenizers) has no oracle; tests compare with brute force.
ORACLE_SQL = None


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; the model is learned from ``labels`` of the documents at hand."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return minhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur more than once are cut out of the texts; every document stays."""
    return suffix_dedup.clean(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (array of token ids) and n_tokens of every document left, checked by decoding."""
    return byte_bpe.checked(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxic", toxic),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``; every stage's result is stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
