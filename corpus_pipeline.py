"""Corpus preparation: five stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketmart.llm.decontamination import decontaminate
from basketmart.llm.minhash import one_of_each
from basketmart.llm.packing import pack
from basketmart.llm.pii import redact_documents
from basketmart.llm.text import held_out, read_table
from basketmart.llm.toxicity import fit_toxicity, reject_toxic
from basketmart.session import stored


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the labels of the whole table, held-out ones left out."""
    model = fit_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels").filter(~held_out(4)))
    return reject_toxic(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8), the one with the smallest id.

    Documents without words are linked with nothing and stay. Rows are judged by their texts, so rows that repeat an id or
    have none lose no text of their own.
    """
    return one_of_each(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    return redact_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", packing),
]

#: The stages learn models, compare sets and run a tokenizer; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = stored(docs)
    return docs
