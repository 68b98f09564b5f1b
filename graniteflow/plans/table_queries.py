"""Aggregations, windows, set operations, splits and feature columns."""

from __future__ import annotations

import math
from itertools import accumulate, takewhile

from pyspark.sql import functions as F

from graniteflow.functions import columns as cx
from graniteflow.functions.hashing import hash_unit
from graniteflow.operators import ordering, split, stats, vectorize
from graniteflow.plans.catalog import query
from graniteflow.plans.views import (
    FOLDED, NET_FEATURES, NET_PRICE, PART_RATINGS, PART_TYPES, RATINGS, RETURN_FLAGS, RUNS, TWEETS, YEARLY, cluster_runs,
    net_price, part_ratings, ratings, sql_fold, sql_hash, sql_unit, tweets, with_sql, yearly,
)


def r6(name):
    return F.round(name, 6).alias(name)


@query("value_counts", "SELECT source, count(*) AS n FROM documents GROUP BY 1")
def value_counts(t):
    return stats.value_counts(t.documents, "source")


@query("source_stats", with_sql(TWEETS, """
SELECT tag, count(*) AS n, round(count(*)/((max(epoch)-min(epoch))/3600.0), 6) AS per_hour,
       round(avg(followers), 6) AS mean_followers, round(avg(retweets), 6) AS mean_retweets FROM tweets GROUP BY 1"""))
def source_stats(t):
    return stats.source_stats(tweets(t)).select("tag", "n", r6("per_hour"), r6("mean_followers"), r6("mean_retweets"))


@query("hourly_rate", with_sql(TWEETS, "SELECT round(count(*)/((max(epoch)-min(epoch))/3600.0), 6) AS per_hour FROM tweets"))
def hourly_rate(t):
    return stats.source_stats(tweets(t).withColumn("tag", F.lit("all"))).select(r6("per_hour"))


@query("hourly_histogram", with_sql(TWEETS, """
counts AS (SELECT tag, CAST(floor(epoch/3600) AS BIGINT) AS hour, count(*) AS n FROM tweets GROUP BY ALL),
grid AS (SELECT tag, unnest(range(min(hour), max(hour)+1)) AS hour FROM counts GROUP BY tag)""",
"SELECT tag, hour, coalesce(n, 0) AS n FROM grid LEFT JOIN counts USING (tag, hour)"))
def hourly_histogram(t):
    return stats.hourly_histogram(tweets(t).withColumn("hour", cx.hour_bucket("epoch")), "tag", "hour")


@query("rating_matrix", with_sql(RATINGS, 'SELECT "user", item, round(rating, 6) AS rating FROM ratings'))
def rating_matrix(t):
    return stats.rating_matrix(ratings(t)).select("user", "item", r6("rating"))


@query("rating_pivot", with_sql(RATINGS, """named AS (SELECT "user", 'item_' || item AS name, rating FROM ratings WHERE item IS NOT NULL)""", """
SELECT "user", coalesce(round(COLUMNS('(item_.*)'), 6), 0) AS '\\1' FROM (PIVOT named ON name USING avg(rating) GROUP BY "user")"""))
def rating_pivot(t):
    """Every item of the ratings is a column."""
    rows = ratings(t).where("item IS NOT NULL")
    items = [r["item"] for r in rows.select("item").distinct().orderBy("item").collect()]
    wide = stats.rating_matrix(rows, items)
    return wide.select("user", *[F.round(F.col(str(i)), 6).alias(f"item_{i}") for i in items])


@query("density", with_sql(PART_RATINGS, """
SELECT count(*) AS n_ratings, count(DISTINCT "user") AS n_users, count(DISTINCT item) AS n_items,
       round(count(*)/(count(DISTINCT "user")*1.0*count(DISTINCT item)), 8) AS density FROM ratings"""))
def density(t):
    return stats.density(part_ratings(t)).withColumn("density", F.round("density", 8))


@query("rating_frequency", with_sql(PART_RATINGS, """
SELECT item, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, item) - 1 AS rank_index FROM ratings GROUP BY 1"""))
def rating_frequency(t):
    return stats.rating_frequency(part_ratings(t), "item")


@query("user_frequency", with_sql(PART_RATINGS, """
SELECT "user", count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, "user") - 1 AS rank_index FROM ratings GROUP BY 1"""))
def user_frequency(t):
    return stats.rating_frequency(part_ratings(t), "user")


@query("item_variance", with_sql(PART_RATINGS, "SELECT item, count(*) AS n, round(var_pop(rating), 6) AS variance FROM ratings GROUP BY 1"))
def item_variance(t):
    return stats.item_variance(part_ratings(t)).select("item", "n", r6("variance"))


@query("user_mean", with_sql(PART_RATINGS, 'SELECT "user", round(avg(rating), 6) AS mean_rating FROM ratings GROUP BY 1'))
def user_mean(t):
    return stats.user_mean(part_ratings(t)).select("user", r6("mean_rating"))


@query("rating_histogram", with_sql(RATINGS, """
counts AS (SELECT least(CAST(floor(rating/0.5) AS BIGINT), 9) AS bin, count(*) AS n FROM ratings GROUP BY 1)""", """
SELECT g.bin, CAST(g.bin*0.5 AS DOUBLE) AS left_edge, coalesce(n, 0) AS n FROM (SELECT unnest(range(10)) AS bin) g LEFT JOIN counts USING (bin)"""))
def rating_histogram(t):
    return stats.histogram(ratings(t), "rating", 10, 0.0, 5.0)


@query("length_histogram", """
WITH ends AS (SELECT min(n_chars)::DOUBLE AS lo, (max(n_chars) - min(n_chars))::DOUBLE/50 AS width FROM documents),
counts AS (SELECT least(CAST(floor((n_chars - lo)/width) AS BIGINT), 49) AS bin, count(*) AS n FROM documents CROSS JOIN ends GROUP BY 1)
SELECT g.bin, round(lo + g.bin*width, 6) AS left_edge, coalesce(n, 0) AS n
FROM (SELECT unnest(range(50)) AS bin) g CROSS JOIN ends LEFT JOIN counts USING (bin)""")
def length_histogram(t):
    return stats.histogram(t.documents, "n_chars", 50).withColumn("left_edge", F.round("left_edge", 6))


@query("box_stats", with_sql(NET_PRICE, """
q AS (SELECT p_type, count(*) AS n, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median,
             quantile_cont(price, 0.75) AS q3 FROM net_price GROUP BY 1)""", """
SELECT p_type, q.n, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
       round(min(price) FILTER (price >= q1-1.5*(q3-q1) AND price <= q3+1.5*(q3-q1)), 4) AS low_whisker,
       round(max(price) FILTER (price >= q1-1.5*(q3-q1) AND price <= q3+1.5*(q3-q1)), 4) AS high_whisker,
       count(*) FILTER (NOT (price >= q1-1.5*(q3-q1) AND price <= q3+1.5*(q3-q1))) AS n_outliers
FROM net_price JOIN q USING (p_type) GROUP BY ALL"""))
def box_stats(t):
    out = stats.box_stats(net_price(t), "p_type", "price")
    return out.select("p_type", "n", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3", "low_whisker", "high_whisker")], "n_outliers")


@query("yearly_trend", with_sql(YEARLY, """
SELECT year, count(*) AS n, round(avg(o_totalprice), 4) AS mean,
       round(avg(o_totalprice) - 1.96*stddev_samp(o_totalprice)/sqrt(count(*)), 4) AS low,
       round(avg(o_totalprice) + 1.96*stddev_samp(o_totalprice)/sqrt(count(*)), 4) AS high FROM yearly GROUP BY 1"""))
def yearly_trend(t):
    return stats.trend(yearly(t), "year", "o_totalprice").select("year", "n", *[F.round(c, 4).alias(c) for c in ("mean", "low", "high")])


@query("contingency", with_sql(RUNS, "SELECT run_id, truth, pred, count(*) AS n FROM runs GROUP BY ALL"))
def contingency(t):
    return stats.contingency(cluster_runs(t), "truth", "pred", ["run_id"])


CORR_COLS = ["l_extendedprice", "l_discount", "l_tax", "l_quantity", "p_size", "price"]


def _pairs(cols):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i:]]


@query("corr_matrix", with_sql(NET_PRICE, " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM net_price" for a, b in _pairs(CORR_COLS))))
def corr_matrix(t):
    return stats.corr_matrix(net_price(t), CORR_COLS).withColumn("corr", F.round("corr", 6))


@query("user_counters", with_sql(RATINGS, 'SELECT "user", count(*) AS n_rated, count(*) FILTER (rating >= 3) AS n_liked FROM ratings GROUP BY 1'))
def user_counters(t):
    from graniteflow.operators.recommend import user_counters as counters

    return counters(ratings(t), 3.0)


@query("distinct_labels", "SELECT DISTINCT lang, source FROM documents")
def distinct_labels(t):
    return t.documents.select("lang", "source").distinct()


# ---------------------------------------------------- windows and ordering
@query("running_total", """
SELECT o_orderkey, CAST(sum(CAST(o_totalprice*100 AS BIGINT)) OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS running_cents FROM orders""")
def running_total(t):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    out = ordering.running_totals(t.orders, ["o_orderdate", "o_orderkey"], {"running_cents": cents})
    return out.select("o_orderkey", "running_cents")


@query("year_series", with_sql(YEARLY, """
SELECT year, o_orderkey, row_number() OVER (PARTITION BY year ORDER BY o_orderkey) - 1 AS place, o_totalprice FROM yearly"""))
def year_series(t):
    return ordering.row_index(yearly(t), ["o_orderkey"], ["year"], "place").select("year", "o_orderkey", "place", "o_totalprice")


@query("sort_descending", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def sort_descending(t):
    return t.customer.select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey")


@query("best_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def best_n(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5)


@query("top_items", """
SELECT label, vec_id, CAST(rank AS INTEGER) AS rank FROM (
  SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY embedding[1] DESC, vec_id) AS rank FROM embeddings)
WHERE rank <= 10""")
def top_items(t):
    rows = t.embeddings.select("label", "vec_id", F.col("embedding")[0].alias("factor"))
    return ordering.top_per_group(rows, ["label"], ["-factor", "vec_id"], 10).select("label", "vec_id", "rank")


@query("union_by_name", """
SELECT c_custkey AS key, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier""")
def union_by_name(t):
    customers = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    suppliers = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"))
    return stats.union_all([customers, suppliers])


@query("train_test_split", f"SELECT o_orderkey, {sql_unit(42, 'o_orderkey')} < 0.2 AS is_test FROM orders")
def train_test_split(t):
    train, test = split.split(t.orders.select("o_orderkey"), "o_orderkey", 0.2, seed=42)
    return train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))


@query("kfold", f"SELECT o_orderkey, CAST({sql_fold(5, 9, 'o_orderkey')} AS INTEGER) AS fold FROM orders")
def kfold(t):
    return split.with_fold(t.orders.select("o_orderkey"), "o_orderkey", 5, seed=9)


#: P(weight <= j) of a Poisson(1) weight for all j whose tail exceeds 2^-32, the finest step of the hash.
POISSON = list(takewhile(lambda p: 1 - p > 2.0**-32, accumulate(math.exp(-1.0) / math.factorial(j) for j in range(40))))


@query("bootstrap", f"""
WITH r AS (SELECT c_custkey, CAST(b AS INTEGER) AS resample, {sql_unit(6, 'c_custkey', 'b')} AS u
           FROM customer CROSS JOIN (SELECT unnest(range(4)) AS b))
SELECT c_custkey, resample, CAST({' + '.join(f'(u >= {p!r})::INT' for p in POISSON)} AS BIGINT) AS weight,
       u < {POISSON[0]!r} AS out_of_bag FROM r""")
def bootstrap(t):
    return split.bootstrap(t.customer.select("c_custkey"), "c_custkey", 4, seed=6)


# --------------------------------------------------------- feature columns
def _sql_scaled(cols, table):
    cells = ", ".join(f"round(({c} - avg({c}) OVER ())/stddev_pop({c}) OVER (), 6) AS {c}" for c in cols)
    return f"SELECT l_orderkey, l_linenumber, {cells} FROM {table}"


SCALED_COLS = ["l_extendedprice", "l_discount", "l_tax", "l_quantity", "p_size", "price"]


@query("standard_scale", with_sql(NET_PRICE, _sql_scaled(SCALED_COLS, "net_price")))
def standard_scale(t):
    out = vectorize.standard_scale(net_price(t), SCALED_COLS)
    return out.select("l_orderkey", "l_linenumber", *[r6(c) for c in SCALED_COLS])


ENCODED = f"""encoded AS (
  SELECT l_orderkey, l_linenumber,
    CAST(list_position({PART_TYPES!r}, p_type) - 1 AS DOUBLE) AS p_type,
    CAST(list_position({RETURN_FLAGS!r}, l_returnflag) - 1 AS DOUBLE) AS l_returnflag,
    l_extendedprice, l_discount, l_tax, l_quantity, p_size, price FROM net_price)"""


@query("ordinal_encode", with_sql(NET_PRICE, ENCODED, "SELECT l_orderkey, l_linenumber, p_type, l_returnflag FROM encoded"))
def ordinal_encode(t):
    return net_price(t).select(
        "l_orderkey", "l_linenumber", vectorize.ordinal_encode("p_type", PART_TYPES).alias("p_type"),
        vectorize.ordinal_encode("l_returnflag", RETURN_FLAGS).alias("l_returnflag"),
    )


def encoded_net_price(t, keep=("l_orderkey", "l_linenumber")):
    return vectorize.encode_columns(
        net_price(t), {"p_type": PART_TYPES, "l_returnflag": RETURN_FLAGS},
        ["l_extendedprice", "l_discount", "l_tax", "l_quantity", "p_size", "price"], list(keep),
    )


@query("column_transformer", with_sql(NET_PRICE, ENCODED, _sql_scaled(NET_FEATURES + ["price"], "encoded")))
def column_transformer(t):
    out = vectorize.standard_scale(encoded_net_price(t), NET_FEATURES + ["price"])
    return out.select("l_orderkey", "l_linenumber", *[r6(c) for c in NET_FEATURES + ["price"]])


POLY = ["l_discount", "l_tax", "l_quantity"]


@query("polynomial_features", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    [f"round({a}, 6) AS {a}" for a in POLY] + [f"round({a}*{b}, 6) AS {a}_{b}" for a, b in _pairs(POLY)]) + " FROM lineitem")
def polynomial_features(t):
    terms = vectorize.polynomial_columns(POLY, 2)
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", *[F.round(c, 6).alias(n.replace("*", "_")) for n, c in terms.items()]
    )


@query("concat_features", """
SELECT doc_id, n_chars, lang, quality, toxic FROM documents JOIN labels USING (doc_id)""")
def concat_features(t):
    return vectorize.concat_features(t.documents.select("doc_id", "n_chars", "lang"), t.labels, "doc_id")


@query("random_features", "SELECT doc_id, " + ", ".join(f"round({sql_unit(13, 'doc_id', str(j))}, 9) AS r{j}" for j in range(4)) + " FROM documents")
def random_features(t):
    out = vectorize.random_features(t.documents.select("doc_id"), "doc_id", 4, seed=13)
    return out.select("doc_id", *[F.round(f"r{j}", 9).alias(f"r{j}") for j in range(4)])
