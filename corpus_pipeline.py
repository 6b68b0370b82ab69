"""A corpus made ready for training: five stages, each applying one operator to what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    decontaminate,
    ngram_join,
    packing,
    rule_ensemble,
    secret_scan,
    vocabulary,
)
from tidemark.llm.store import prepare_workers, materialize

ORACLE_SQL = None  # trained models and set similarity: tested against brute force instead


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject.

    Null and empty texts are scored like any other; repeated rows and rows without id are judged
    each. Without labels nothing is rejected.
    """
    prepare_workers(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = rule_ensemble.train(docs, labels)
    return rule_ensemble.keep_predicted(docs, model)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the least id, in one row.

    Rows that repeat an id are one document. Rows without id come after those with one, copies among
    them are one row; null and empty texts are linked with nothing.
    """
    prepare_workers(spark)
    return ngram_join.keep_first(docs)


def keep_decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and empty texts stay; repeated rows and rows without id are judged each. An empty benchmark
    removes nothing.
    """
    prepare_workers(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.keep_clean(docs, benchmark)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and their lengths counted anew.

    Null texts stay null; repeated rows and rows without id stay.
    """
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences of 1024 tokens.

    Null and empty texts are one end id; repeated rows and rows without id are packed each.
    """
    prepare_workers(spark)
    return packing.pack_documents(docs, vocabulary.default_path())


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", keep_decontaminated),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    sf_dir = sf_dir.rstrip("/")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, "stage")
    return docs
