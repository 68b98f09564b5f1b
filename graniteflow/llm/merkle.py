"""Merkle manifest of a table: one tree per group of rows, a tree over the group roots, proofs of all rows.

Every row is a leaf; a node is the SHA-256 (as hex text) of up to three consecutive nodes
below it. Proofs come from an octopus multiproof: the leaves of a tree lie in aligned
blocks of 3^7 leaves (the leaf partitions). A block lists the coordinates of the nodes that its
leaves need and that it cannot compute itself, once for all its leaves, fetches them with
one join on the table of upper nodes, computes the nodes its leaves share, and writes the
proof of every leaf without further data. A tree of any size is spread over its blocks;
upper levels are blocks of block tops, so the driver sees only the largest tree's size.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graniteflow.llm.sqltext import sql_crc32, sql_leaf
from graniteflow.operators.ordering import row_index
from graniteflow.session import cut_lineage

#: Nodes hashed into one, and levels of a block.
WIDTH, LEVELS = 3, 7
#: Name of the tree over the group roots; those of groups start with 0 (null) or 1.
TOP = ""


def _hash(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def height(leaves: int) -> int:
    """Levels above ``leaves`` leaves until one node remains."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // WIDTH), levels + 1
    return levels


def climb(digests: list[str], levels: int) -> list[list[str]]:
    """The nodes of every level from ``digests`` up, ``levels`` times; a lone node is hashed again."""
    out = [digests]
    for _ in range(levels):
        below = out[-1]
        out.append([_hash(*below[i : i + WIDTH]) for i in range(0, len(below), WIDTH)])
    return out


def _run(pos: int) -> range:
    """Positions of the run that holds ``pos``."""
    return range(pos - pos % WIDTH, pos - pos % WIDTH + WIDTH)


def missing(level: int, pos: int, leaves: int) -> list[tuple[int, int]]:
    """(level, position) of the siblings on the way from a node to the root of a tree of ``leaves`` leaves."""
    out = []
    for up in range(level, height(leaves)):
        there = -(-leaves // WIDTH**up)
        out += [(up, i) for i in _run(pos) if i != pos and i < there]
        pos //= WIDTH
    return out


def way(level: int, pos: int, leaves: int, known: dict[tuple[int, int], str]) -> list[tuple[str, str]]:
    """(nodes left of it, nodes right of it) for each level from a node to the root."""
    out = []
    for up in range(level, height(leaves)):
        run = _run(pos)
        out.append(("".join(known.get((up, i), "") for i in run if i < pos), "".join(known.get((up, i), "") for i in run if i > pos)))
        pos //= WIDTH
    return out


def leaf_digest(*columns: Column) -> Column:
    """Hex digest of a row: for each column ``-`` if null, else its UTF-8 byte count, ``:`` and its text."""
    text = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def _blocks(leaves: DataFrame, levels: int) -> DataFrame:
    """(tree, total, block, items): the leaves of each block in order; at most 3^levels of them in a row."""
    item = F.struct("pos", *[c for c in leaves.columns if c not in ("tree", "total", "pos")])
    return leaves.groupBy("tree", "total", F.floor(F.col("pos") / WIDTH**levels).cast("bigint").alias("block")).agg(
        F.sort_array(F.collect_list(item)).alias("items")
    )


def _nodes(blocks: DataFrame, level: int, all_levels: bool, levels: int) -> DataFrame:
    """(tree, total, level, pos, digest) of the nodes above the blocks' ``digest``, or of their tops only."""
    def run(batches):
        for batch in batches:
            rows = []
            for tree, total, block, digests in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                found = climb(digests, min(levels, height(total) - level))
                for up, nodes in enumerate(found):
                    if up and (all_levels or up == len(found) - 1) or len(found) == 1:
                        rows += [(tree, total, level + up, block * WIDTH ** (levels - up) + i, d) for i, d in enumerate(nodes)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["tree", "total", "level", "pos", "digest"])

    digests = F.transform("items", lambda x: x["digest"])
    return blocks.select("tree", "total", "block", digests.alias("digests")).mapInArrow(run, "tree string, total bigint, level bigint, pos bigint, digest string")


def upper_nodes(blocks: DataFrame, most: int, levels: int) -> DataFrame:
    """All nodes from the block tops (or the roots of lower trees) to the roots; ``most``: leaves of the largest tree."""
    level = levels
    nodes = found = cut_lineage(_nodes(blocks, 0, False, levels))
    while level < height(most):
        below = found.where((F.col("level") == level) & (F.col("total") > WIDTH**level))
        level += levels
        found = cut_lineage(_nodes(_blocks(below.drop("level"), levels), level - levels, True, levels))
        nodes = nodes.unionByName(found)
    return nodes


def _roots(nodes: DataFrame, most: int) -> DataFrame:
    """(tree, digest) of the roots: the only node of its level that is not below another."""
    last = F.lit(0)
    for up in range(height(most)):
        last = F.when(F.col("total") > WIDTH**up, up + 1).otherwise(last)
    return nodes.where((F.col("pos") == 0) & (F.col("level") == last)).select("tree", "digest")


def _most(leaves: DataFrame) -> int:
    return leaves.agg(F.max("total").alias("n")).first()["n"] or 0


class Manifest:
    """Blocks of leaves, upper nodes of all trees and the places of the group roots in the top tree."""

    def __init__(self, leaves: DataFrame, group: Column, order: list[str], carry: list[str], levels: int = LEVELS):
        """``leaves`` has a column ``digest``; ``order`` sorts a group's leaves (nulls first), ``carry`` is kept for proofs.

        A block has ``levels`` levels.
        """
        self.levels = levels
        named = leaves.select(F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0")).alias("tree"), *dict.fromkeys([*order, "digest", *carry]))
        placed = row_index(named, [*order, "digest"], ["tree"], "pos", totals=True).withColumnRenamed("pos_total", "total")
        self.blocks = cut_lineage(_blocks(placed.select("tree", "total", "pos", "digest", *[c for c in carry if c != "digest"]), levels))
        most = _most(self.blocks)
        nodes = upper_nodes(self.blocks, most, levels)
        self.group_roots = _roots(nodes, most)
        tops = self.group_roots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "digest")
        self.top_leaves = cut_lineage(row_index(tops, ["of"], ["tree"], "pos", totals=True).withColumnRenamed("pos_total", "total"))
        most, tops = _most(self.top_leaves), _blocks(self.top_leaves.drop("of"), levels)
        above = upper_nodes(tops, most, levels)
        self.root = _roots(above, most).select("digest")
        # the top tree's levels below its blocks' tops serve the proofs, too
        inner = _nodes(tops, 0, True, levels).where((F.col("level") > 0) & (F.col("level") < levels))
        leaf_level = self.top_leaves.select("tree", "total", F.lit(0).cast("bigint").alias("level"), "pos", "digest")
        top = leaf_level.unionByName(inner).unionByName(above.where(F.col("level") >= levels))
        self.nodes = nodes.unionByName(top).select("tree", "level", "pos", "digest")

    def proofs(self) -> DataFrame:
        """One row per leaf: what was carried, pos, digest, subroot, root and proof.

        ``proof`` has for each level from the leaf to the root the concatenated nodes left
        and right of the leaf's own node in its run.
        """
        seat = self.top_leaves.select(F.col("of").alias("tree"), F.col("pos").alias("seat"), F.col("total").alias("seats"), F.col("digest").alias("subroot"))
        partitions = self.blocks.join(seat, "tree")
        wanted = partitions.select("tree", "block", "total", "seat", "seats").mapInArrow(_wanted(self.levels), "tree string, block bigint, in_tree string, level bigint, pos bigint")
        fetched = wanted.join(self.nodes.withColumnRenamed("tree", "in_tree"), ["in_tree", "level", "pos"])
        fetched = fetched.groupBy("tree", "block").agg(F.collect_list(F.struct((F.col("in_tree") == TOP).alias("top"), "level", "pos", "digest")).alias("known"))
        ready = partitions.join(fetched, ["tree", "block"], "left")
        carried = [f for f in self.blocks.schema["items"].dataType.elementType.fields if f.name not in ("pos", "digest")]
        kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried)
        schema = f"{kept}{', ' if kept else ''}pos bigint, digest string, subroot string, root string, proof array<struct<left:string,right:string>>"
        names = [f.name for f in carried]
        return ready.select("total", "block", "items", "seat", "seats", "subroot", "known").mapInArrow(_expand(names, self.levels), schema)


def _wanted(levels: int):
    """Function to rows of node coordinates that each leaf partition lacks: in its own tree above its top, and in the top tree."""
    def run(batches):
        for batch in batches:
            rows = []
            for tree, block, total, seat, seats in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                rows += [(tree, block, tree, level, pos) for level, pos in missing(levels, block, total)]
                rows += [(tree, block, TOP, level, pos) for level, pos in missing(0, seat, seats)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["tree", "block", "in_tree", "level", "pos"])

    return run


def _expand(names: list[str], levels: int):
    """Function over batches of ready leaf partitions that writes the proof of each leaf."""
    def run(batches):
        for whole in batches:
            for r in range(whole.num_rows):
                batch = whole.slice(r, 1)
                total, block, seat, seats, subroot = (batch.column(i)[0].as_py() for i in (0, 1, 3, 4, 5))
                items, known = batch.column(2).flatten(), batch.column(6)[0].as_py() or []
                digests = items.field(items.type.get_field_index("digest")).to_pylist()
                own = climb(digests, min(levels, height(total)))
                base = block * WIDTH**levels
                inside = {(up, base // WIDTH**up + i): d for up, nodes in enumerate(own) for i, d in enumerate(nodes)}
                top = {(x["level"], x["pos"]): x["digest"] for x in known if x["top"]}
                outside = {(x["level"], x["pos"]): x["digest"] for x in known if not x["top"]}
                rest = way(len(own) - 1, block if height(total) > levels else 0, total, outside) + way(0, seat, seats, top)
                root = subroot
                for left, right in way(0, seat, seats, top):
                    root = _hash(left, root, right)
                # paths of the nodes of a level from those of the level above
                paths = [rest]
                for up in range(len(own) - 2, -1, -1):
                    first = base // WIDTH**up
                    step = []
                    for i in range(len(own[up])):
                        run_ = _run(first + i)
                        left = "".join(inside[up, j] for j in run_ if j < first + i)
                        right = "".join(inside[up, j] for j in run_ if j > first + i and (up, j) in inside)
                        step.append([(left, right), *paths[i // WIDTH]])
                    paths = step
                n = len(digests)
                flat = [x for path in paths for x in path]
                sides = pa.StructArray.from_arrays([pa.array([x[0] for x in flat], pa.string()), pa.array([x[1] for x in flat], pa.string())], names=["left", "right"])
                offsets = pa.array([i * len(paths[0]) for i in range(n + 1)], pa.int32())
                columns = [items.field(items.type.get_field_index(c)) for c in [*names, "pos", "digest"]]
                columns += [pa.array([subroot] * n), pa.array([root] * n), pa.ListArray.from_arrays(offsets, sides)]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "pos", "digest", "subroot", "root", "proof"])

    return run


def proof_digest(proof: Column) -> Column:
    """Hex digest of a proof's nodes, from the leaf up and from left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """Root that follows from a leaf and its proof."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def tampered_check(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Proofs of all documents and their verdict on a tampered copy.

    One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.
    Where 2 divides the CRC-32 of the decimal doc_id, the copy's text has lost its line
    feeds; ``folded_root`` is computed from the copy's leaf and the proof.

    Leaves ascend by doc_id (null first; a null id is not tampered with), equal ids by
    their digest; repeated rows are leaves of their own with equal digests. Null columns
    count as ``-``, empty texts as ``0:``. Whole texts are hashed where they lie; only
    digests are shuffled. An empty table has no rows.
    """
    parts = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = leaf_digest(*parts[:4], F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.contains(F.col("text"), F.lit("\n"))
    leaves = docs.select("doc_id", F.col("source").alias("group"), leaf_digest(*parts).alias("digest"), F.when(hit, changed).alias("copy"))
    proofs = Manifest(leaves, F.col("group"), ["doc_id"], ["doc_id", "copy"], levels).proofs()
    folded = fold(F.coalesce("copy", "digest"), F.col("proof"))
    out = proofs.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), folded.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


TAMPERED_SQL = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, coalesce('1' || source, '0') AS tree, {{leaf_text}} AS leaf, {{copy_text}} AS copy,
    {sql_crc32("doc_id::VARCHAR")} % 2 = 0 AS hit FROM documents),
p AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM l),
t(tree, lvl, pos, digest, n) AS (
  SELECT tree, 0, pos, leaf, n FROM p
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3 FROM t WHERE n > 1 GROUP BY tree, lvl, pos // 3, n),
s AS MATERIALIZED (
  SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS seat, count(*) OVER () AS seats FROM t WHERE n = 1),
u(lvl, pos, digest, n) AS (
  SELECT 0, seat, digest, seats FROM s
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3 FROM u WHERE n > 1 GROUP BY lvl, pos // 3, n),
runs AS MATERIALIZED (
  SELECT 0 AS part, tree, lvl, pos // 3 AS run, list(digest ORDER BY pos) AS nodes FROM t WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT 1, '', lvl, pos // 3, list(digest ORDER BY pos) FROM u WHERE n > 1 GROUP BY ALL),
f(id, tree, part, lvl, pos, n, seat, seats, node, proof) AS (
  SELECT p.id, p.tree, 0, 0, p.pos, p.n, s.seat, s.seats, p.node, '' FROM (
    SELECT row_number() OVER (ORDER BY tree, pos) AS id, tree, pos, n, CASE WHEN hit THEN copy ELSE leaf END AS node FROM p) p JOIN s USING (tree)
  UNION ALL
  SELECT f.id, f.tree, CASE WHEN f.n > 1 THEN f.part ELSE 1 END, CASE WHEN f.n > 1 THEN f.lvl + 1 ELSE 0 END,
    CASE WHEN f.n > 1 THEN f.pos // 3 ELSE f.seat END, CASE WHEN f.n > 1 THEN (f.n + 2) // 3 ELSE f.seats END, f.seat, f.seats,
    CASE WHEN f.n > 1 THEN sha256(array_to_string(list_concat(list_concat(r.nodes[:f.pos % 3], [f.node]), r.nodes[f.pos % 3 + 2:]), '')) ELSE f.node END,
    CASE WHEN f.n > 1 THEN f.proof || array_to_string(list_concat(r.nodes[:f.pos % 3], r.nodes[f.pos % 3 + 2:]), '') ELSE f.proof END
  FROM f LEFT JOIN runs r ON r.part = f.part AND r.tree = (CASE WHEN f.part = 0 THEN f.tree ELSE '' END) AND r.lvl = f.lvl AND r.run = f.pos // 3
  WHERE f.n > 1 OR f.part = 0),
q AS (SELECT *, row_number() OVER (ORDER BY tree, pos) AS id FROM p)
SELECT q.doc_id, q.leaf, s.digest AS subroot, u.digest AS root, sha256(f.proof) AS proof_sha256, f.node AS folded_root, f.node = u.digest AS verified
FROM q JOIN s USING (tree) JOIN f ON f.id = q.id AND f.part = 1 AND f.n = 1 JOIN u ON u.n = 1
"""
TAMPERED_SQL = TAMPERED_SQL.format(
    leaf_text=sql_leaf("doc_id", "source", "lang", "n_chars", "text"), copy_text=sql_leaf("doc_id", "source", "lang", "n_chars", "replace(text, chr(10), '')")
)
