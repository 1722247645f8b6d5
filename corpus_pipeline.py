"""A corpus pipeline over ``documents``, each stage written and read again.

Toxic documents go, one document of each near-duplicate group stays, documents with a passage of
the benchmark go, and what is left is packed into sequences of ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rentrank.llm import decontamination, packing, simhash, toxicity
from rentrank.llm.store import saved, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half, by models of the labelled ones among them."""
    return toxicity.without_toxic(docs, toxicity.fitted(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: shingles of 3 words, 2 bits."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, and their sequences."""
    return packing.packed(docs, packing.tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL has neither the models nor the tokenizer; tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
