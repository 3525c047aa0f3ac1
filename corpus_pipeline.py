"""Cleaning a training corpus: five stages over `documents`, each one of the operators of
orderlens.llm. A stage's rows are written as Parquet in the shared folder and read again as
the next one's documents, so lost executors repeat one stage at most.

Every stage keeps all columns of `documents` but the last, which returns the encoding. A
null text passes all stages (no words, no tokens); an empty table gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderlens.llm import bpe, decontaminate, neardup, substrings, toxicity
from orderlens.llm.frames import stored
from orderlens.llm.queries import TOXIC_AT, table, tokenizer_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored TOXIC_AT or more go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), toxicity.character_model(docs))
    return toxicity.reject(docs, model, TOXIC_AT)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the least id."""
    return neardup.keep_first(docs)


def remove_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words covered by a repeated window of 20 words go, all but the first occurrence."""
    return substrings.remove_repeats(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a test item, question and answer, go."""
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts of what is left."""
    return bpe.digest(docs, tokenizer_path())


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", remove_repeated_spans),
    ("decontamination", remove_benchmark),
    ("bpe", encode),
]

#: SQL can't express the learned stage; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
