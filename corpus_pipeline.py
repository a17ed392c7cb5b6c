"""A corpus made ready for training: five stages, each written as Parquet and read again.

Toxic documents go, then exact copies, then near copies; personal data are replaced, and
what is left is packed into sequences. Each stage works on all its predecessor kept. All
stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm.common import settle
from tidegauge.llm.exact import without_copies
from tidegauge.llm.pii import pseudonymise
from tidegauge.llm.queries import SAMPLE_KEY, packed, table
from tidegauge.llm.simhash import without_near_copies
from tidegauge.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose worst window scores below the threshold; labels come from their own table."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return without_copies(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies, the row with the smallest doc_id."""
    return without_near_copies(docs)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with personal data replaced in the text."""
    return pseudonymise(docs, SAMPLE_KEY)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the packed sequences."""
    return packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("pii", pseudonyms),
    ("packing", packing),
]

#: SQL has no word for the trained network.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
