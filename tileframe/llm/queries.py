"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tileframe.llm import (
    alignment, html_text, jaccard, lexical, licenses, lm_score, mixing, near_vectors, neighbours, packing, pii, quality, revisits,
)
from tileframe.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingles overlap by 85 % or more."""
    return jaccard.join_ngrams(_read(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(_read(spark, sf_dir, "pages"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every document."""
    return licenses.scan(_read(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack(_read(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-likelihood of every document under a network trained on all of them."""
    return lm_score.score(_read(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates for all documents that bring the labelled domains to their target shares."""
    labels = _read(spark, sf_dir, "labels").select("doc_id", mixing.domain_of_labels().alias("domain"))
    return mixing.mix(_read(spark, sf_dir, "documents"), labels)


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    return neighbours.search(_read(spark, sf_dir, "embeddings"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, as spans."""
    return pii.scan(_read(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict per document; documents of one source share a host."""
    return quality.judge(_read(spark, sf_dir, "documents"))


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two visits of every page; its revisits point to the responses that hold their payloads."""
    out = revisits.resolve_revisits(revisits.captures(_read(spark, sf_dir, "pages")))
    pairs = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return out.withColumn("headers", F.array_join(F.array_sort(pairs), "\n"))


def op11_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors of one label with a cosine of 0.98 or more."""
    return near_vectors.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical.search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two public tokenizers, for every document."""
    return alignment.align(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_html_extraction": op2_html_extraction,
    "op3_license_scan": op3_license_scan,
    "op4_packing": op4_packing,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_mixing": op6_mixing,
    "op7_neighbours": op7_neighbours,
    "op8_pii": op8_pii,
    "op9_quality_rules": op9_quality_rules,
    "op10_warc_revisits": op10_warc_revisits,
    "op11_near_vectors": op11_near_vectors,
    "op12_lexical_search": op12_lexical_search,
    "op13_token_alignment": op13_token_alignment,
}
