"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankmatch.llm import mixing, packing, pii, quality_model, simhash
from rankmatch.llm.queries import held_out, table
from rankmatch.session import store


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of these documents, does not reject."""
    labels = table(spark, sf_dir, "labels").where(~held_out(5, 0))
    return quality_model.keep(docs, quality_model.train(docs, labels, "quality"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return simhash.deduplicate(docs, shingle=3, radius=3, seed=42)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with marks in place of personal data."""
    return pii.redact(docs, pii.train(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mix(docs, weights=(1, 2, 3), max_epochs=3)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of several lengths, each with the documents it holds."""
    return packing.sequences(docs)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_dedup),
    ("PII", private),
    ("mixing sources", mixed),
    ("best-fit packing", packed),
]

# Training and message passing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
