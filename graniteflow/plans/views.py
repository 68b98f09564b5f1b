"""Input views of the registered queries, each as a plan and as SQL text.

Every view covers all rows of its tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graniteflow.functions import text as tx
from graniteflow.functions.columns import epoch_seconds
from graniteflow.functions.hashing import hash_int, hash_unit
from graniteflow.functions.stopwords import STOP_WORDS
from graniteflow.session import partitions_for, spread


def with_sql(*parts: str) -> str:
    """``WITH a, b, c <body>``: all parts but the last are CTE definitions."""
    return "WITH RECURSIVE " + ",\n".join(parts[:-1]) + "\n" + parts[-1]


def sql_hash(seed: int, *keys: str) -> str:
    text = "||':'||".join([f"'{seed}'"] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return f"CAST('0x'||substr(md5({text}),1,8) AS BIGINT)"


def sql_unit(seed: int, *keys: str) -> str:
    return f"({sql_hash(seed, *keys)}/4294967296.0)"


SQL_STOPS = "(" + ",".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS) + ")"


# ------------------------------------------------------------------ text
def doc_tokens(t, together: bool = False) -> DataFrame:
    """(doc_id, token). ``together``: dealt by document, for counts and weights within documents."""
    texts = t.documents.select("doc_id", "text")
    texts = texts.repartition(partitions_for(texts), "doc_id") if together else spread(texts)
    return texts.select("doc_id", F.explode(tx.tokens("text")).alias("token"))


def legal_tokens(t, together: bool = False) -> DataFrame:
    return doc_tokens(t, together).where(tx.is_legal("token"))


TOKENS = r"""tokens AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS token
  FROM documents)"""
LEGAL = TOKENS + rf""",
legal AS (
  SELECT * FROM tokens
  WHERE token NOT IN {SQL_STOPS} AND NOT regexp_matches(token, '\p{{Nd}}'))"""


def word_vectors(words: DataFrame, col: str, dim: int = 8) -> DataFrame:
    """Repeatable vectors for half of the vocabulary; the other half is unknown."""
    known = words.select(F.col(col).alias("word")).distinct().where(hash_int("word", seed=5) % 2 == 1)
    byte = lambda j: F.conv(F.substring(F.md5(F.col("word")), 2 * j + 1, 2), 16, 10).cast("double")
    return known.select("word", F.array(*[byte(j) / 255.0 - 0.5 for j in range(dim)]).alias("v"))


def sql_word_vectors(source: str, col: str, dim: int = 8) -> str:
    cells = ", ".join(
        f"CAST('0x'||substr(md5(word),{2 * j + 1},2) AS BIGINT)/255.0 - 0.5 AS v{j}" for j in range(dim)
    )
    return f"""known AS (
  SELECT word, {cells}
  FROM (SELECT DISTINCT {col} AS word FROM {source}) WHERE {sql_hash(5, 'word')} % 2 = 1)"""


# --------------------------------------------------------------- ratings
def ratings(t) -> DataFrame:
    """(user, item, rating) in half steps from 0.5 to 5, mean on duplicates."""
    item = F.get_json_object("props", "$.k").cast("bigint")
    rating = F.least(F.lit(5.0), F.ceil(F.col("value") / 15) * F.lit(0.5))
    rows = t.events.select(F.col("user_id").alias("user"), item.alias("item"), rating.alias("rating"))
    return rows.groupBy("user", "item").agg(F.avg("rating").alias("rating"))


RATINGS = """ratings AS (
  SELECT user_id AS "user", CAST(json_extract(props, '$.k') AS BIGINT) AS item,
         avg(least(5.0, ceil(value/15)*0.5)) AS rating
  FROM events GROUP BY 1, 2)"""


def part_ratings(t) -> DataFrame:
    """Sparse ratings: customer × part, rating from the quantity."""
    rating = F.ceil(F.col("l_quantity") / 5) * F.lit(0.5)
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"), rating.alias("rating"))
        .groupBy("user", "item")
        .agg(F.avg("rating").alias("rating"))
    )


PART_RATINGS = """ratings AS (
  SELECT o_custkey AS "user", l_partkey AS item, avg(ceil(l_quantity/5)*0.5) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""


def sql_fold(k: int, seed: int, *keys: str) -> str:
    return f"{sql_hash(seed, *keys)} % {k}"


FOLDED = f"""folded AS (
  SELECT *, CAST({sql_fold(10, 7, '"user"', 'item')} AS INTEGER) AS fold FROM ratings)"""


# ---------------------------------------------------------------- labels
def docs_labeled(t) -> DataFrame:
    return t.documents.join(t.labels, "doc_id")


# ------------------------------------------------------------ regression
PART_TYPES = ["SMALL", "MEDIUM", "LARGE", "STANDARD", "ECONOMY", "PROMO"]
RETURN_FLAGS = ["A", "N", "R"]
NET_FEATURES = ["p_type", "l_returnflag", "l_extendedprice", "l_discount", "l_tax", "l_quantity", "p_size"]


def net_price(t) -> DataFrame:
    """Line items with their part: numeric and ordered columns, label ``price``."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_type", "l_returnflag", "l_extendedprice",
        "l_discount", "l_tax", "l_quantity", F.col("p_size").cast("double").alias("p_size"),
        net.alias("price"),
    )


NET_PRICE = """net_price AS (
  SELECT l_orderkey, l_linenumber, l_partkey, p_type, l_returnflag, l_extendedprice, l_discount,
         l_tax, l_quantity, CAST(p_size AS DOUBLE) AS p_size,
         l_extendedprice*(1-l_discount)*(1+l_tax) AS price
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def yearly(t) -> DataFrame:
    """Orders with their year, line count and total quantity; label ``o_totalprice``."""
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("n_lines"), F.sum("l_quantity").alias("quantity")
    )
    return t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", F.year("o_orderdate").alias("year"), "o_totalprice", "n_lines", "quantity"
    )


YEARLY = """yearly AS (
  SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice, n_lines, quantity
  FROM orders JOIN (SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS n_lines, sum(l_quantity) AS quantity
                    FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey)"""


# ---------------------------------------------------------------- tweets
def tweets(t) -> DataFrame:
    """Event records in the shape of tagged, time-stamped posts."""
    return t.events.select(
        "event_id", "user_id", F.col("event_type").alias("tag"), epoch_seconds("ts").alias("epoch"),
        F.get_json_object("props", "$.k").cast("bigint").alias("followers"),
        F.floor("value").cast("bigint").alias("retweets"), "value",
    )


TWEETS = """tweets AS (
  SELECT event_id, user_id, event_type AS tag, CAST(floor(epoch(ts)) AS BIGINT) AS epoch,
         CAST(json_extract(props, '$.k') AS BIGINT) AS followers,
         CAST(floor(value) AS BIGINT) AS retweets, value FROM events)"""


def hashtag_rows(t) -> DataFrame:
    """Documents whose long words carry a hash mark, with the tag structs."""
    marked = F.regexp_replace("text", r"(\p{L}{9,})", "#$1")
    names = F.regexp_extract_all("marked", F.lit(r"#(\p{L}+)"), F.lit(1))
    tag = lambda w, i: F.struct(w.alias("text"), F.array(i, i + F.length(w)).alias("indices"))
    return (
        t.documents.select("doc_id", marked.alias("marked"))
        .withColumn("names", names)
        .withColumn("tags", F.transform("names", tag))
    )


HASHTAGS = r"""hashtags AS (
  SELECT doc_id, marked, regexp_extract_all(marked, '#(\p{L}+)', 1) AS names
  FROM (SELECT doc_id, regexp_replace(text, '(\p{L}{9,})', '#\1', 'g') AS marked FROM documents))"""


# ------------------------------------------------------------ clusterings
def cluster_runs(t) -> DataFrame:
    """Two labelings of the documents per run, scored against the language."""
    base = t.documents.select("doc_id", F.col("lang").alias("truth"), "source", "n_chars", "text")
    runs = F.array(
        F.struct(F.lit("by_source").alias("run_id"), F.col("source").alias("pred")),
        F.struct(
            F.lit("by_accent").alias("run_id"),
            F.when(F.rlike("text", F.lit("[êèç]")), "accent").otherwise("plain").alias("pred"),
        ),
        F.struct(
            F.lit("by_length").alias("run_id"),
            F.floor(F.log2(F.col("n_chars"))).cast("string").alias("pred"),
        ),
    )
    return base.select("doc_id", "truth", F.inline(runs)).select("run_id", "doc_id", "truth", "pred")


RUNS = """runs AS (
  SELECT 'by_source' AS run_id, doc_id, lang AS truth, source AS pred FROM documents
  UNION ALL SELECT 'by_accent', doc_id, lang,
    CASE WHEN regexp_matches(text, '[êèç]') THEN 'accent' ELSE 'plain' END FROM documents
  UNION ALL SELECT 'by_length', doc_id, lang,
    CAST(CAST(floor(log2(n_chars)) AS BIGINT) AS VARCHAR) FROM documents)"""


# -------------------------------------------------------- binary scores
def scored_docs(t) -> DataFrame:
    """Labelled documents with a coarse (tied) and a fine score."""
    score = F.floor(F.log2(F.col("n_chars")) * 4) / 4
    return docs_labeled(t).select(
        "doc_id", F.col("quality").cast("double").alias("y"), "lang", "toxic",
        score.alias("score"), (F.length("text") > 500).cast("double").alias("pred"),
        hash_unit("doc_id", seed=3).alias("noise"),
    )


SCORED = f"""scored AS (
  SELECT doc_id, CAST(quality AS DOUBLE) AS y, lang, toxic, floor(log2(n_chars)*4)/4 AS score,
         CASE WHEN length(text) > 500 THEN 1.0 ELSE 0.0 END AS pred, {sql_unit(3, 'doc_id')} AS noise
  FROM documents JOIN labels USING (doc_id))"""
