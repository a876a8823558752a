"""From raw documents to a training mix, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps; it is
written as Parquet to the cluster's shared scratch folder and read again as the
next one's documents. All stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import forest, langid, mixing, pii, tiling
from tidewater.session import scratch_path

#: Share of a text's n-grams, corrected for chance, that its language must know.
LEAST_LANGUAGE_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; without letters or in another language they go."""
    return langid.keep_known(docs, langid.fit(docs), LEAST_LANGUAGE_SCORE)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return forest.keep_first(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold a benchmark item."""
    return tiling.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span of personal data replaced by its kind."""
    return pii.redact(docs, pii.fit(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    return mixing.mix_documents(docs)


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("decontaminated", decontaminated),
    ("without_personal_data", without_personal_data),
    ("mixed", mixed),
]

#: N-gram filters, a MinHash forest and a trained span model are not SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is a table that the next stage, and a rerun after a loss, reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
