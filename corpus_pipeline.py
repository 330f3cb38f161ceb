"""The corpus pipeline: named stages, each reading what its predecessor wrote.

Every stage but the last returns the columns of the documents it was given; the
last returns one row per piece and its place in a sequence of 1024 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faregate.llm import exact_dedup, minhash, mixing, packing, quality
from faregate.llm.common import ship, table
from faregate.operators.layout import written


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not reject; it learns from ``labels`` and the documents it is given."""
    return quality.drop_low_quality(docs, table(spark, sf_dir, "labels"))


def keep_one_of_equals(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space, the longest, then the one with the smallest id."""
    return exact_dedup.drop_duplicates(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents that are 0.8 alike or more, the document with the smallest id."""
    ship(spark)
    return minhash.drop_near_duplicates(docs, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in proportion to the square root of their size, as many rows as there are; in random order."""
    return mixing.mix_sources(docs, with_copies=False)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing into sequences of 1024 tokens."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_good_quality),
    ("exact dedup", keep_one_of_equals),
    ("near dedup", keep_one_of_near_copies),
    ("mixing", mix),
    ("best-fit packing", pack_documents),
]
ORACLE_SQL: str | None = None  # the classifier and the tokens have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read back."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
    return docs
