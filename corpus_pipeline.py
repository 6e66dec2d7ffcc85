"""A corpus pipeline over `documents`: reject poor documents, exact copies, near copies and benchmark leaks, tokenise."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loanscope.llm import agenda_bpe, bradley_terry, signature_join, spaced_seeds, trie_dedup
from loanscope.llm.shared import tuned, written


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = tuned(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return bradley_terry.keep_good(docs, bradley_terry.fit(docs, labels))


def _exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tuned(spark)
    return trie_dedup.drop_copies(docs)


def _near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tuned(spark)
    return signature_join.drop_near_copies(docs, signature_join.Rule(width=5, percent=80))


def _leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return spaced_seeds.drop_leaks(docs, tuned(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def _tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tuned(spark)
    return agenda_bpe.token_digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", _quality), ("exact_dedup", _exact), ("near_dedup", _near), ("decontamination", _leaks), ("tokens", _tokens),
]

#: The classifier and the tokenizer can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
