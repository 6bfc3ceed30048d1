"""The corpus pipeline: each stage reads what the one before has written.

Good documents are kept, one of each group of near duplicates stays, personal data is masked, sources are mixed to target
shares, and what is left is packed into training sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tileframe.llm import jaccard, mixing, packing, pii, quality
from tileframe.llm.common import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: words in shingles of five, similarity 0.8 or more."""
    return jaccard.distinct_documents(docs, n=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans are masked; ``n_chars`` is counted anew."""
    return pii.masked(docs, length="n_chars")


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as their rates say."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.mixed(docs, labels.select("doc_id", mixing.domain_of_labels().alias("domain")))


def packing_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mixing", mixing_sources),
    ("packing", packing_sequences),
]

#: Token ids and fitted rates are beyond SQL; no test runs the pipeline as a whole yet.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
