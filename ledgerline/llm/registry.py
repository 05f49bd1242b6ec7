"""Registered queries of the training-data operators: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (byte_bpe, cover_tree, decontaminate, hard_negatives, inner_products, licences, lm_score, minhash,
                            shards, suffix_dedup, token_files, toxicity, whitening)
from ledgerline.llm.common import table, texts

#: Production parameters.
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SHARD_TREE = shards.tree(regions=2, racks=3, shards=4)


def op1_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id", "n_item").agg(F.max("n_shared").alias("n_shared"))


def op4_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_pairs(table(spark, sf_dir, "embeddings"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(texts(docs), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(table(spark, sf_dir, "documents"), n=4).drop("text_key")


def op7_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents"), SHARD_TREE)


def op8_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "labels").where("quality = 1")
    scores = lm_score.score(table(spark, sf_dir, "documents"), target)
    return scores.select("doc_id", "n_tokens", *[(F.round(c, 6) + F.lit(0.0)).alias(c)
                                                 for c in ("target_loss", "background_loss", "score")])


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.roundtrip(spark, table(spark, sf_dir, "documents"), WORD_TOKENIZER)


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.report(table(spark, sf_dir, "documents"))


def op11_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inner_products.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, hard_negatives.shifted_label())


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_suffix_array, op2_byte_bpe, op3_decontaminate, op4_cover_tree, op5_toxicity, op6_minhash, op7_hash_tree,
        op8_cross_entropy, op9_token_files, op10_licences, op11_top_products, op12_hard_negatives, op13_whitening)}


def oracle_sql() -> dict[str, str]:
    return {"op8_cross_entropy": lm_score.score_sql(), "op10_licences": licences.report_sql(),
            "op11_top_products": inner_products.top_products_sql(), "op12_hard_negatives": hard_negatives.mine_sql()}
