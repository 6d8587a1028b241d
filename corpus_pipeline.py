"""A pipeline from raw documents to packed batches.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's documents.  Stages 1 to 4 return the columns of ``docs``,
also columns beyond those of ``documents``.  Null texts and texts without words fall to the
quality rules; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelworks.llm import exact, packing, partenum, quality, substrings
from panelworks.llm.common import stage
from panelworks.session import tidy

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes boilerplate lines, and documents that fail a rule or have too little left."""
    return quality.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the smallest id."""
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return partenum.drop_near_copies(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages that occurred before, and documents of which nothing is left."""
    return substrings.drop_repeats(docs)


def packing_buckets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each document with their bucket, batch and slot."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing_buckets),
]

# Components of near copies, sentence boundaries and the choice of buckets are beyond SQL of a
# reasonable length; the pipeline is tested against a plain Python version instead.
ORACLE_SQL: str | None = None


@tidy
def _written(step: Stage, name: str, spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What a stage returns, stored; what it stored on the way is removed."""
    return stage(step(spark, docs, sf_dir), name)


@tidy
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the ``documents`` table below ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = _written(step, name, spark, docs, sf_dir)
    return docs
