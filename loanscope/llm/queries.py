"""The operators over their whole tables, by query name."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from loanscope.llm import (
    agenda_bpe, bradley_terry, conversation_repair, factorization_machine, feistel_shards, importance_resampling, ownership,
    semi_markov, signature_join, spaced_seeds, style_tree, trie_dedup, vantage_trees,
)
from loanscope.llm.shared import tuned

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = trie_dedup.exact_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return bradley_terry.scored(docs, bradley_terry.fit(docs, _table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_join.near_groups(_table(spark, sf_dir, "documents"), signature_join.Rule(width=3, percent=85))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return factorization_machine.scored(docs, factorization_machine.fit(docs, _table(spark, sf_dir, "labels")))


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel_shards.shards(_table(spark, sf_dir, "documents"), k=24).drop("number")


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only documents with benchmark passages: one row for each with each item."""
    return spaced_seeds.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agenda_bpe.token_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.main_texts(_table(spark, sf_dir, "pages"))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return semi_markov.personal_data(docs, semi_markov.fit(docs))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ownership.secrets(_table(spark, sf_dir, "documents"), owner="source", repository="doc_id")


def resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return importance_resampling.resampled(docs, target).drop("n_words")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    return conversation_repair.repaired(conversation_repair.damaged(rows), rows.select("conv_id"))


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage_trees.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def queries() -> dict[str, Query]:
    return {
        "op1_exact_dedup": exact_dedup,
        "op2_quality": quality,
        "op3_near_dedup": near_dedup,
        "op4_toxicity": toxicity,
        "op5_sharding": sharding,
        "op6_decontamination": decontamination,
        "op7_page_text": page_text,
        "op8_piece_tokens": piece_tokens,
        "op9_personal_data": personal_data,
        "op10_secrets": secrets,
        "op11_resampling": resampling,
        "op12_conversations": conversations,
        "op13_neighbours": neighbours,
    }
