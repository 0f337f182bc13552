"""Pipeline from documents to packed sequences, one operator a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sijill.llm import ordermin, packing, repeats, secrets, toxicity
from sijill.llm.common import shared_folder, table
from sijill.llm.queries import tokenizer


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the least doc_id."""
    return ordermin.first_of_class(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller doc_id holds are cut out."""
    return repeats.dedup(docs).drop("removed")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 token ids."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("near_dedup", without_near_copies),
    ("substring_dedup", without_repeats),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: SQL expresses none of the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents; what each returns is written and read again."""
    folder, docs = shared_folder(spark, "pipeline"), table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
