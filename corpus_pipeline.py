"""From raw documents to token ids: quality rules, near-duplicates, personal data, source mix, byte-level BPE.

Every stage takes all its predecessor kept and returns a DataFrame, which is written as Parquet and read again for the next
one. All stages but the last return the columns of documents; a document that the mix takes twice is there twice. The mix adds
shard and order and lays its rows out by them; the last stage keeps both, as a later read may deal files to tasks in any order.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import bpe, minhash, mixing, pii, quality
from granary.llm.queries import BYTE_BPE, table
from granary.session import stored, tuned

ORACLE_SQL = None  # similarity search, the field and the encoder are not SQL


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the fixed and the adaptive rules."""
    tuned(spark)
    return quality.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    tuned(spark)
    return minhash.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced; n_chars counts the new text."""
    tuned(spark)
    return pii.redacted(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, a row for each copy, with its shard and order: shards one after the other, each in order."""
    tuned(spark)
    return mixing.mixed(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text; with the document's place in the mix, if it has one."""
    tuned(spark)
    place = [c for c in ("shard", "order") if c in docs.columns]
    coded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text", *place), public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    count = (F.octet_length("ids") / 4).cast("long")
    return coded.select("doc_id", "lang", "source", count.alias("n_tokens"), "ids", same.alias("decodes"), *place)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
