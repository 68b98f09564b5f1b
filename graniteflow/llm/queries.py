"""The named queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graniteflow.llm import (
    ann, chat, classifier, extract, fingerprints, merkle, mixing, ngram_join, packing, rules, token_counts, trie, url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return fingerprints.document_fingerprints(documents, radius=fingerprints.NEAR_RADIUS)


@query
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


SQL["op3_mixing"] = mixing.MIX_SQL


@query
def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, folder, "pages"), url_filter.rule_table(spark))


SQL["op9_url_filter"] = url_filter.FILTER_SQL


@query
def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"))


@query
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge(_table(spark, folder, "documents"))


@query
def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract.extract_pages(_table(spark, folder, "pages"))


@query
def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return classifier.classify(documents, classifier.train(documents, _table(spark, folder, "labels")))


@query
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    edits = token_counts.document_edits(F.col("text"), F.col("source"), F.col("lang"))
    return token_counts.edited_counts(_table(spark, folder, "documents"), edits)


@query
def op8_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_pairs(chat.with_rejected(_table(spark, folder, "conversations")), "conv_id")


SQL["op8_chat_formatting"] = chat.FORMAT_SQL


@query
def op10_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, folder, "documents"))


@query
def op11_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(_table(spark, folder, "embeddings"))


@query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.tampered_check(_table(spark, folder, "documents"))


SQL["op12_merkle_manifest"] = merkle.TAMPERED_SQL


@query
def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(_table(spark, folder, "conversations"))


SQL["op13_conversation_trie"] = trie.TRIE_SQL
