"""From raw documents to packed sequences: five stages, each on all rows its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from graniteflow.llm import classifier, mixing, ngram_join, packing, rules
from graniteflow.session import scratch_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of these documents, predicts as good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classifier.keep_good(docs, classifier.train(docs, labels))


def little_repetition(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return rules.keep_passing(docs)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return ngram_join.keep_one_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source takes them, each with its whole text; texts without a word go."""
    return mixing.mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences.

    Fewer chunks are cached than alone, since workers still hold memory of the stages before.
    """
    return packing.pack_documents(docs, cached=300_000)


STAGES = [
    ("quality classifier", good_quality),
    ("quality rules", little_repetition),
    ("n-gram Jaccard join", one_of_each_class),
    ("mixing sources to target weights", mixed),
    ("best-fit packing", packed),
]

#: Feature scores, suffix arrays and token ids are beyond SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.split()[0])
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
