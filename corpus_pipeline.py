"""The training-data pipeline over ``documents``: five stages, each on all that the one before kept.

Every stage is written as Parquet before the next one reads it. The first four return the columns of ``documents``; packing
returns one row per piece of a sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import exact_dedup, mixing, packing, simhash, toxicity
from tagloom.llm.common import stored, table
from tagloom.llm.queries import with_package


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose expected severity reaches the model's cut; the model learns from ``labels``."""
    return toxicity.accepted(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text, the one with the largest doc_id stays."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints (three-word shingles, at most 3 bits apart), the one with the least doc_id stays."""
    return simhash.deduplicate(docs, words=3, radius=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mixture takes them; the last taken of a source may be cut."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences: doc_id, start, length, ids (little-endian u32), doc_tokens, sequence_id, offset."""
    return packing.pack(docs.select("doc_id", F.col("text")))


STAGES = [
    ("toxicity", with_package(reject_toxic)),
    ("exact_dedup", with_package(drop_copies)),
    ("simhash_near_dedup", with_package(drop_near_copies)),
    ("mixing", with_package(mix_sources)),
    ("packing", with_package(pack_sequences)),
]

#: SQL has neither the model nor the tokenizer nor the packing; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, one after the other, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
