"""URL rules by a sort-merge range join on reversed-host canonical keys.

``blog.example.net`` has the key ``net.example.blog.``, so a host and its subdomains are
the keys with one prefix: an interval. Rules open and close intervals, which nest. Keys
and interval ends are sorted together, and the stack of open rules at a key is the stack
of the last end before it. A first sweep finds the ruled hosts above each url, a second
one the longest ruled path on each of these hosts; the longest rule of all decides.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graniteflow.session import cut_lineage, partitions_for

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def open_rules(points: DataFrame, rules: DataFrame, key: str = "_key") -> DataFrame:
    """Adds ``_stack``: the ``_load`` of every rule whose ``_prefix`` starts the key, outermost first.

    ``rules`` has distinct non-null ``_prefix``. A null key has no open rule (null or empty
    stack). Rows are range-partitioned by key and a hash of the row, so that equal keys of
    many rows spread over tasks; each range begins with the stack left by the ranges before.
    """
    inner = rules.select("_prefix", "_load", F.explode(F.sequence(F.lit(1), F.length("_prefix"))).alias("_n"))
    above = inner.select("_prefix", F.col("_prefix").substr(F.lit(1), F.col("_n")).alias("_above"), "_n")
    nested = above.join(rules.select(F.col("_prefix").alias("_above"), "_load"), "_above").groupBy("_prefix").agg(
        F.sort_array(F.collect_list(F.struct("_n", "_load"))).alias("_open")
    )
    loads = F.transform("_open", lambda x: x["_load"])
    start = F.encode(F.col("_prefix"), "UTF-8")
    ends = nested.select(
        F.explode(F.array(
            F.struct(start.alias("_pos"), loads.alias("_stack")),
            F.struct(F.concat(start, F.unhex(F.lit("FF"))).alias("_pos"), F.slice(loads, F.lit(1), F.size(loads) - 1).alias("_stack")),
        )).alias("_e")
    ).select("_e.*")
    rows = points.withColumn("_pos", F.encode(F.col(key), "UTF-8")).withColumn("_tie", F.xxhash64(*points.columns))
    swept = cut_lineage(
        rows.unionByName(ends.withColumn("_end", F.lit(True)), allowMissingColumns=True)
        .repartitionByRange(partitions_for(points), F.col("_pos").asc_nulls_first(), F.col("_tie").asc_nulls_first())
        .withColumn("_range", F.spark_partition_id())
    )
    last = swept.groupBy("_range").agg(F.max_by("_stack", F.when(F.col("_end"), F.col("_pos"))).alias("_left"))
    # One row per range, as many as the session's shuffle partitions.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("_range", F.last("_left", ignorenulls=True).over(before).alias("_left"))
    so_far = (
        Window.partitionBy("_range").orderBy(F.col("_pos").asc_nulls_first(), F.col("_tie").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    stack = F.coalesce(F.last("_stack", ignorenulls=True).over(so_far), F.col("_left"))
    out = swept.join(carried, "_range").withColumn("_stack", stack).where(F.col("_end").isNull())
    return out.select(*points.columns, "_stack")


def filter_urls(df: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per row of ``df``: id, host, path, rule (null if none fits), verdict.

    ``rules`` has action, host and path. A rule fits its host and all subdomains if the
    url's path starts with the rule's path; the longest rule wins (host and path together,
    then the longer host). Of equal rules ``block`` wins; rules with a null are not used.
    A null url, or one without ``://``, has an empty host and path, which no host rule fits.
    """
    key = host_key(F.col("host"))
    rules = rules.where("action IS NOT NULL AND host IS NOT NULL AND path IS NOT NULL").groupBy("host", "path").agg(F.max("action").alias("action"))
    load = F.struct((F.length("host") + F.length("path")).alias("n"), F.length("host").alias("h"), F.concat("host", "path").alias("rule"), "action")
    paths = rules.select(F.concat(key, F.lit("/"), F.col("path")).alias("_prefix"), load.alias("_load"))
    hosts = rules.select(key.alias("_prefix")).distinct().select("_prefix", F.col("_prefix").alias("_load"))
    pages = df.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    ruled = open_rules(pages.withColumn("_key", key), hosts).select("_row", "_id", "host", "path", F.explode_outer("_stack").alias("_on"))
    ruled = open_rules(ruled.withColumn("_key", F.concat("_on", F.lit("/"), F.col("path"))).drop("_on"), paths)
    best = ruled.groupBy("_row", "_id", "host", "path").agg(F.max(F.try_element_at("_stack", F.lit(-1))).alias("_best"))
    return best.select(
        F.col("_id").alias(id_col), "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.action", F.lit(default)).alias("verdict")
    )


def rule_table(spark, rules=RULES) -> DataFrame:
    """Rules given as (action, host, path)."""
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(("action", "host", "path"), rule, strict=True)]) for rule in rules]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("_rule")).select("_rule.*")


FILTER_SQL = r"""
WITH rules(action, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
p AS (
  SELECT row_number() OVER () AS r, page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
hit AS (
  SELECT p.r, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(action, length(rhost || rpath)) AS action
  FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY p.r)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM p LEFT JOIN hit USING (r)
"""
