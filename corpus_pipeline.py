"""A training corpus from raw documents: quality, near-duplicates, decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
one's documents. All but the last return the columns that they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from limnos.llm import decontaminate, packing, quality, secrets, simhash
from limnos.llm.queries import TOKENIZER
from limnos.llm.shared import on_workers, saved, table

GENERATION = 50_000  # pieces that a packing worker remembers: the executor's memory still holds what earlier stages have taken


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on these documents and the table of labels, accepts."""
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of the smallest id."""
    return simhash.one_of_each(docs)


def decontaminated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; those that hold nothing else go."""
    return decontaminate.cleaned(docs, table(spark, sf_dir, "benchmark"))


def redacted_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets replaced by a mark."""
    return secrets.redact(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return packing.pack(docs, TOKENIZER, generation=GENERATION)


STAGES = [
    ("quality_classifier", on_workers(good_documents)),
    ("simhash_near_dedup", on_workers(distinct_documents)),
    ("benchmark_decontamination", on_workers(decontaminated_documents)),
    ("secret_scans", on_workers(redacted_documents)),
    ("best_fit_packing", on_workers(packed_sequences)),
]
ORACLE_SQL = None  # a trained classifier and a tokenizer are beyond SQL; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
