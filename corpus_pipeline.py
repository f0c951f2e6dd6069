"""A training-data pipeline over ``documents``: four stages, each one operator of ``llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm import byte_bpe, jaccard_join, source_mix, toxicity
from llm.queries import RANKS
from shelf.staging import stage


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, fitted on the labelled ones, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document, a row for each pass over its source."""
    return source_mix.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the offsets that decode parts of it."""
    return byte_bpe.encode(docs, RANKS).select("doc_id", "source", "lang", "ids", "n_tokens", "offsets")


STAGES = [
    ("toxicity", clean),
    ("n-gram Jaccard join", distinct),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", encoded),
]

# Training and encoding cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
