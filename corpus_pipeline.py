"""The corpus pipeline: language, exact copies, near copies, mixing, token ids.

Each stage takes (spark, docs, folder of the tables) and gives a DataFrame, which is written as Parquet and read again
as the next stage's documents. All stages but the last give the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadcycle.llm import bpe, exact_dedup, language, mixing, simhash
from loadcycle.llm.common import cut, tables
from loadcycle.llm.queries import PATTERN, VOCABULARY


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told, which becomes the ``lang`` of those without; learnt from the documents' own labels.

    Null texts and texts without a letter go, no others, however close the languages' scores are. If no row has a label,
    no language can be told and all go.
    """
    model = language.train(docs)
    return language.told_languages(docs, model)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of equal texts."""
    return exact_dedup.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return simhash.one_of_each(docs, width=3, seed=42, radius=2)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document comes as often as the mix takes it."""
    return mixing.mix(docs, weights=(3, 1, 2), share=1.5, most=2)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts with the language, one row per document of the mix."""
    return bpe.round_trip(docs, VOCABULARY, PATTERN, keep=["lang"])


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("mixing", mixed_sources),
    ("byte_level_bpe", token_ids),
]

#: SQL can express neither the learnt languages nor the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


