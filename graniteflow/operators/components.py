"""Connected components and minimum spanning trees of edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graniteflow.session import cut_lineage


def _signature(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (or itself)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    kept = lowest.select("a", F.col("m").alias("b"))
    return moved.unionByName(kept).where("a <> b").distinct()


def connected_components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(id, label): smallest id reachable from every node.

    Alternating star contraction: a logarithmic number of rounds in practice,
    also for long chains, and only linear edge tables. Minima are combined
    before the shuffle; a hub's edges are split by the skew-join rule.
    """
    now = cut_lineage(edges.where("a <> b").select("a", "b").distinct())
    before = None
    for _ in range(max_rounds):
        mark = _signature(now)
        if mark == before or mark[0] == 0:
            break
        before = mark
        now = cut_lineage(_small_star(_large_star(now)))
    else:
        raise RuntimeError("components did not settle")
    stars = now.select(F.col("a").alias("id"), F.col("b").alias("label"))
    return nodes.select("id").join(stars, "id", "left").select("id", F.coalesce("label", "id").alias("label"))


def spanning_tree(edges: DataFrame) -> DataFrame:
    """(a, b, w) of a minimum spanning forest by Borůvka rounds; ties by (w, a, b).

    Every round each component takes its lightest outgoing edge and the touched
    components are merged, which at least halves their number.
    """
    live = cut_lineage(edges.select("a", "b", "w", F.col("a").alias("ca"), F.col("b").alias("cb")).where("ca <> cb"))
    tree = None
    while live.limit(1).count():
        ends = live.select(F.explode(F.array("ca", "cb")).alias("c"), F.struct("w", "a", "b", "ca", "cb").alias("e"))
        chosen = cut_lineage(ends.groupBy("c").agg(F.min("e").alias("e")).select("e.*").distinct())
        part = chosen.select("a", "b", "w")
        tree = part if tree is None else tree.unionByName(part)
        nodes = chosen.select(F.explode(F.array("ca", "cb")).alias("id")).distinct()
        labels = connected_components(nodes, chosen.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        name = lambda c: labels.select(F.col("id").alias(c), F.col("label").alias(f"n{c}"))
        live = live.join(name("ca"), "ca", "left").join(name("cb"), "cb", "left").select(
            "a", "b", "w", F.coalesce("nca", "ca").alias("ca"), F.coalesce("ncb", "cb").alias("cb")
        ).where("ca <> cb")
        live = cut_lineage(live)
    return edges.select("a", "b", "w").limit(0) if tree is None else tree
