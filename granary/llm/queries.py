"""Registered queries of the text operators: each reads its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from granary.llm import bpe, langid, merkle, minhash, mixing, periodic, pii, pseudolm, quality, secretscan, tokencount, urls, vectors
from granary.session import tuned

BYTE_BPE, WORD_PIECES = "byte_bpe_50k.tiktoken", "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return vectors.linked(table(spark, sf_dir, "embeddings"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and round trip of every whole text."""
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text."""
    return pii.digests(table(spark, sf_dir, "documents"))


def op8_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every whole text."""
    return pseudolm.scored(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op9_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of every whole text."""
    return quality.verdicts(table(spark, sf_dir, "documents"))


def op3_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every whole text."""
    return minhash.duplicates(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-piece tokens of every whole text."""
    return tokencount.counted(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path(WORD_PIECES)).drop("text")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text."""
    return langid.identified(table(spark, sf_dir, "documents"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.allotments(table(spark, sf_dir, "documents"))


def op10_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every url."""
    return urls.filtered(table(spark, sf_dir, "pages"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every whole text."""
    return periodic.digests(table(spark, sf_dir, "documents"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text."""
    return secretscan.digests(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document."""
    return merkle.digests(table(spark, sf_dir, "documents"))


QUERIES = [op1_vector_links, op2_byte_bpe, op3_weighted_minhash, op4_token_counts, op5_language_id, op6_source_mix, op7_personal_data, op8_pseudo_likelihood, op9_adaptive_quality, op10_url_templates,
           op11_periodic_runs, op12_secret_scan, op13_merkle_manifest]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES}
