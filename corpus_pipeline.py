"""Documents to packed token sequences: the stages of a training-data pipeline.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
A stage's rows are written to the shared folder and read again by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import exact_dedup, language, mixing, near_dedup, packing
from ledgerloom.llm.common import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in one of the languages; null texts, texts without a letter and texts like none of the languages go."""
    return language.identified_documents(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies."""
    return exact_dedup.without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.without_near_copies(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each source in the target proportions; a document taken again is a row again."""
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.packed_documents(docs)


STAGES = [
    ("language_id", language_id), ("exact_dedup", exact_copies), ("near_dedup", near_copies),
    ("mixing", mixing_sources), ("packing", packed_sequences),
]

#: Language models and token ids are not SQL; tests hold the result against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
