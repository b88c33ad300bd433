"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next one.

The first three keep whole rows of ``documents``; the last returns one row per packed piece. An empty
table passes through all of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tilecast.llm import host_rules, language_id, near_dups, packing
from tilecast.llm.text import ship
from tilecast.session import materialize

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifier knows. Null, empty and letterless texts go."""
    ship(spark)
    return language_id.keep_identified(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, on hosts that pass them. Rows without a host are one host together."""
    ship(spark)
    return host_rules.keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates: five-word shingles, similarity 0.8.

    Rows without an id stay, and rows that repeat one go or stay together.
    """
    ship(spark)
    return near_dups.keep_first(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 4096 tokens; repeated rows are packed each."""
    ship(spark)
    return packing.packing_digest(docs, TOKENIZER)


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("packing", pack),
]

#: Trained models and tokenizers decide the rows, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
