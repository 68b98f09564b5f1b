"""Sources, sinks, projections and scalar columns."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from graniteflow.functions import columns as cx
from graniteflow.functions.text import WORD
from graniteflow.plans.catalog import query
from graniteflow.plans.views import (
    HASHTAGS, NET_PRICE, TOKENS, TWEETS, doc_tokens, hashtag_rows, net_price, sql_word_vectors, tweets, with_sql,
    word_vectors,
)
from graniteflow.session import scratch_path
from graniteflow.sources import readers, writers


# ------------------------------------------------------- sources and sinks
@query("csv_round_trip", """
SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, round(sum(o_totalprice), 2) AS total,
       max(o_orderpriority) AS last_priority FROM orders""")
def csv_round_trip(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    path = writers.write_table(rows, scratch_path(t.spark, "orders-csv"), "csv")
    back = readers.read_csv(t.spark, path, rows.schema, line_sep="\n")
    return back.agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"),
        F.round(F.sum("o_totalprice"), 2).alias("total"), F.max("o_orderpriority").alias("last_priority"),
    )


@query("csv_renamed", "SELECT p_partkey AS item, p_name AS title, p_type AS genres FROM part")
def csv_renamed(t):
    path = writers.write_table(t.part.select("p_partkey", "p_name", "p_type"), scratch_path(t.spark, "part-csv"), "csv")
    return readers.read_csv(t.spark, path, "item bigint, title string, genres string", line_sep="\n")


@query("csv_line_ends", "SELECT page_id, length(html) AS n_chars, md5(replace(html, chr(10), chr(13))) AS html_md5 FROM pages")
def csv_line_ends(t):
    rows = t.pages.select("page_id", F.replace("html", F.lit("\n"), F.lit("\r")).alias("html"))
    path = writers.write_table(rows, scratch_path(t.spark, "pages-csv"), "csv", lineSep="\n")
    back = readers.read_csv(t.spark, path, rows.schema, line_sep="\n")
    return back.select("page_id", F.length("html").cast("bigint").alias("n_chars"), F.md5("html").alias("html_md5"))


POST = (
    "citation_date bigint, url string, author struct<followers:bigint>, "
    "metrics struct<citations:struct<total:bigint>, impressions:double>, user_id bigint"
)


def _posts(t):
    return tweets(t).select(
        F.col("epoch").alias("citation_date"), F.concat(F.lit("e/"), "event_id").alias("url"),
        F.struct("followers").alias("author"),
        F.struct(F.struct(F.col("retweets").alias("total")).alias("citations"), F.col("value").alias("impressions")).alias("metrics"),
        "user_id", "tag",
    )


POST_PATHS = {
    "time": "citation_date", "followers": "author.followers", "retweets": "metrics.citations.total",
    "impressions": "metrics.impressions", "url": "url",
}


@query("jsonl_scan", with_sql(TWEETS, """
SELECT epoch AS time, followers, retweets, value AS impressions, 'e/'||event_id AS url FROM tweets"""))
def jsonl_scan(t):
    path = writers.write_table(_posts(t).drop("tag"), scratch_path(t.spark, "posts"), "json")
    return cx.record_fields(readers.read_jsonl(t.spark, path, POST), POST_PATHS)


@query("json_column", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_column(t):
    return t.events.select("event_id", F.from_json("props", "k bigint").alias("p")).select("event_id", "p.k")


@query("folder_scan", with_sql(TWEETS, "SELECT tag, count(*) AS n, CAST(sum(retweets) AS BIGINT) AS retweets FROM tweets GROUP BY 1"))
def folder_scan(t):
    """Files of one folder tree tagged by the folder they lie in, in one scan."""
    path = writers.write_table(_posts(t), scratch_path(t.spark, "tagged"), "json", partition_by=["tag"])
    rows = readers.scan_folder(
        t.spark, path, POST, "json", r"part-(\d+)", tag="part_no", recursiveFileLookup="true"
    ).withColumn("tag", F.regexp_extract("_metadata.file_path", r"tag=([^/]+)/", 1))
    return rows.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.sum("metrics.citations.total").alias("retweets"))


@query("word_vector_scan", with_sql(TOKENS, sql_word_vectors("tokens", "token"), """
SELECT count(*) AS n, count(*) AS n_rejected, """ + ", ".join(f"round(sum(v{j}), 4) AS s{j}" for j in range(8)) + " FROM known"))
def word_vector_scan(t):
    vectors = word_vectors(doc_tokens(t), "token")
    lines = vectors.select(F.concat_ws(" ", "word", F.array_join(F.col("v").cast("array<string>"), " ")).alias("value"))
    short = vectors.select(F.concat_ws(" ", "word", F.lit("0.5")).alias("value"))
    path = writers.write_table(lines.unionByName(short), scratch_path(t.spark, "vectors"), "text")
    back = readers.word_vector_lines(t.spark, path, 8)
    return back.agg(
        F.count("v").alias("n"), F.count("rejected").alias("n_rejected"), *[F.round(F.sum(F.col("v")[j].cast("double")), 4).alias(f"s{j}") for j in range(8)]
    )


@query("feature_bundle", """
SELECT vec_id, label, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE)*x))), 6) AS norm,
       CAST(len(embedding) AS BIGINT) AS dim FROM embeddings""")
def feature_bundle(t):
    from pyspark.ml.functions import vector_to_array

    rows = readers.read_features(t.spark, f"{t.folder}/embeddings.parquet")
    x = vector_to_array("features")
    norm = F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v))
    return rows.select("vec_id", "label", F.round(norm, 6).alias("norm"), F.size(x).cast("bigint").alias("dim"))


@query("table_sink", "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def table_sink(t):
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    path = writers.write_table(rows, scratch_path(t.spark, "nations"), "parquet")
    return t.spark.read.schema(rows.schema).parquet(path)


@query("stored_stage", with_sql(TOKENS, "SELECT token, count(DISTINCT doc_id) AS n_docs FROM tokens GROUP BY 1"))
def stored_stage(t):
    pairs = writers.stored(doc_tokens(t).distinct(), "pairs")
    return pairs.groupBy("token").agg(F.count(F.lit(1)).alias("n_docs"))


# ------------------------------------------------------------ projections
@query("select_columns", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem")
def select_columns(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query("columns_by_type", "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def columns_by_type(t):
    return t.lineitem.select(*cx.columns_of(t.lineitem, DoubleType))


@query("product_column", "SELECT l_orderkey, l_linenumber, round(l_quantity*l_discount*l_tax, 6) AS volume FROM lineitem")
def product_column(t):
    volume = cx.product_of("l_quantity", "l_discount", "l_tax")
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(volume, 6).alias("volume"))


@query("filter_equal", "SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1998 AND o_orderstatus = 'F'")
def filter_equal(t):
    year = (F.col("o_orderdate") >= "1998-01-01") & (F.col("o_orderdate") < "1999-01-01")
    return t.orders.where(year & (F.col("o_orderstatus") == "F")).select("o_orderkey", "o_totalprice")


@query("merge_labels", """
SELECT CASE WHEN lang IN ('fr','es') THEN 'romance' ELSE lang END AS label, count(*) AS n FROM documents GROUP BY 1""")
def merge_labels(t):
    label = cx.merge_labels("lang", {"romance": ["fr", "es"]})
    return t.documents.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("rollup_label", "SELECT vec_id, CAST(floor(label/4) AS BIGINT) AS root FROM embeddings")
def rollup_label(t):
    return t.embeddings.select("vec_id", cx.rollup_label("label", 4).alias("root"))


@query("to_numeric", """
SELECT word, CASE WHEN regexp_full_match(word, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST(word AS DOUBLE) END AS number
FROM (SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM documents)""")
def to_numeric(t):
    words = t.documents.select(F.explode(F.split("text", " ")).alias("word")).distinct()
    return words.select("word", cx.to_numeric("word").alias("number"))


@query("count_alnum", r"SELECT doc_id, length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')) AS n_alnum FROM documents")
def count_alnum(t):
    return t.documents.select("doc_id", cx.count_alnum("text").alias("n_alnum"))


@query("length_without_spaces", "SELECT doc_id, length(replace(text, ' ', '')) AS n_solid FROM documents")
def length_without_spaces(t):
    return t.documents.select("doc_id", cx.length_without_spaces("text").alias("n_solid"))


@query("list_length", r"SELECT doc_id, CAST(len(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS BIGINT) AS n_tokens FROM documents")
def list_length(t):
    words = F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))
    return t.documents.select("doc_id", cx.list_length(words).alias("n_tokens"))


@query("profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{k}' AS column_type, count(*) AS n_rows, count({c}) AS n_present FROM documents"
    for c, k in [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")]))
def profile(t):
    return cx.profile(t.documents)


@query("nested_fields", with_sql(TWEETS, "SELECT epoch AS time, followers, retweets, value AS impressions, 'e/'||event_id AS url FROM tweets"))
def nested_fields(t):
    return cx.record_fields(_posts(t), POST_PATHS)


@query("tag_totals", with_sql(HASHTAGS, """
SELECT doc_id, CAST(len(names) AS BIGINT) AS n_tags,
       CAST(coalesce(list_sum(range(len(names))), 0) AS BIGINT) AS sum_start,
       CAST(coalesce(list_sum(range(len(names))), 0) + coalesce(list_sum(list_transform(names, lambda x: length(x))), 0) AS BIGINT) AS sum_end
FROM hashtags"""))
def tag_totals(t):
    return hashtag_rows(t).select("doc_id", *[c.alias(n) for n, c in cx.tag_totals("tags").items()])


@query("hour_bucket", with_sql(TWEETS, "SELECT event_id, CAST(floor(epoch/3600) AS BIGINT) AS hour FROM tweets"))
def hour_bucket(t):
    return tweets(t).select("event_id", cx.hour_bucket("epoch").alias("hour"))


@query("relabel", "SELECT vec_id, CASE label WHEN 0 THEN 1 WHEN 1 THEN 0 ELSE label END AS label FROM embeddings")
def relabel(t):
    return t.embeddings.select("vec_id", cx.relabel("label", {0: 1, 1: 0}).alias("label"))


@query("absolute_gap", with_sql(NET_PRICE, "SELECT l_orderkey, l_linenumber, round(abs(price - l_extendedprice), 6) AS gap FROM net_price"))
def absolute_gap(t):
    gap = cx.absolute_gap("price", "l_extendedprice")
    return net_price(t).select("l_orderkey", "l_linenumber", F.round(gap, 6).alias("gap"))


@query("merge_records", """
SELECT o_orderkey, o_orderstatus AS a, o_orderpriority AS b,
       CASE WHEN o_totalprice > 250000 THEN 'big' ELSE o_orderstatus END AS c FROM orders""")
def merge_records(t):
    left = F.create_map(F.lit("a"), "o_orderstatus", F.lit("c"), "o_orderstatus")
    big = F.when(F.col("o_totalprice") > 250000, F.create_map(F.lit("c"), F.lit("big"))).otherwise(
        F.create_map(F.lit("b"), "o_orderpriority")
    )
    right = cx.merged_map(big, F.create_map(F.lit("b"), F.col("o_orderpriority")))
    merged = cx.merged_map(left, right)
    return t.orders.select("o_orderkey", merged["a"].alias("a"), merged["b"].alias("b"), merged["c"].alias("c"))
