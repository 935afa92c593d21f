"""The corpus pipeline: five stages over ``documents``, each stored and read again by the next.

Stages that hand texts to Python set the session's limit on the bytes of an Arrow batch, if it has none of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adjudica.llm import curriculum, decontaminate, language_id, near_dedup, token_store
from adjudica.llm.queries import tokenizer_path
from adjudica.llm.shared import small_batches, stored, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the others go."""
    small_batches(spark)
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    small_batches(spark)
    return near_dedup.keep_one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no test item is found."""
    small_batches(spark)
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them. They leave in training order, but the next stage does not keep it."""
    return curriculum.in_training_order(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixed corpus, read back: one row per document taken, in ascending id order as op8 sets it."""
    small_batches(spark)
    folder, dictionary = token_store.write_documents(docs, tokenizer_path())
    return token_store.read_documents(spark, folder, dictionary)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", drop_benchmark_leaks),
    ("mix", mix_sources),
    ("tokens", write_tokens),
]

#: The tokenizer of the last stage has no SQL form; tests run the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
