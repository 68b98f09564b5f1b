"""Whole regression forests over binned features.

Every feature is cut into at most 32 bins, as Spark's trees do. Rows whose bins are all equal
form a cell: no tree can part them, so a tree needs of a cell only the sum of its rows' weights
and that of their weighted labels. These sums are made once for all trees, and each tree is
grown to its full depth by one task, whose memory follows the cells and not the rows. A tree
returns its prediction for every cell, and rows look up those of the trees that left them out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graniteflow.operators.ordering import running_totals
from graniteflow.operators.split import bootstrap_weights
from graniteflow.session import cut_lineage, partitions_for, spread, stored

#: Bins of a feature, cells of a tree, and rows of a batch that make it worth to sum a cell before it is sent.
BINS, CELLS, MANY_ROWS = 32, 1 << 20, 16


def bin_edges(rows: DataFrame, x: str, bins: int = BINS) -> list[np.ndarray]:
    """Per feature of the array column, the least values of all bins but the first.

    A feature of at most ``bins`` values has one for each; others are cut by equal frequency.
    """
    cells = rows.select(F.posexplode(x).alias("j", "x")).groupBy("j", "x").agg(F.count(F.lit(1)).alias("c"))
    counts = cut_lineage(cells)
    sizes = {r["j"]: r["n"] for r in counts.groupBy("j").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = F.col("j").isin([j for j, n in sizes.items() if n <= bins])
    ranked = running_totals(counts, ["x"], {"upto": F.col("c")}, ["j"], totals=True)
    slot = F.when(few, F.col("upto")).otherwise(F.floor((F.col("upto") - F.col("c")) * F.lit(bins) / F.col("upto_total")))
    found = ranked.groupBy("j", slot.alias("slot")).agg(F.min("x").alias("edge")).collect()
    return [np.array(sorted(r["edge"] for r in found if r["j"] == j)[1:]) for j in range(max(sizes, default=-1) + 1)]


def _bytes(matrix: np.ndarray) -> pa.Array:
    """Each row of the matrix as a binary value."""
    n, flat = len(matrix), np.ascontiguousarray(matrix)
    offsets = np.arange(n + 1, dtype=np.int32) * np.int32(flat.nbytes // max(n, 1))
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def _matrix(values: list[bytes], kind) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype=kind).reshape(len(values), -1)


def binned_rows(rows: DataFrame, edges: list[np.ndarray], trees: int, seed: int) -> DataFrame:
    """(key, y, cell, w) of rows (key, y, x): the bins of a row and its weights in all resamples as bytes."""
    kind = {c: rows.schema[c].dataType.simpleString() for c in ("key", "y")}

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.asarray(batch.column(2).flatten()).reshape(batch.num_rows, -1)
                cell = np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]).astype(np.uint8)
                w = bootstrap_weights(batch.column(3).to_pylist(), trees, seed)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _bytes(cell), _bytes(w)], names=["key", "y", "cell", "w"])

    named = rows.select("key", "y", "x", F.col("key").cast("string").alias("name"))
    return spread(named).mapInArrow(run, f"key {kind['key']}, y {kind['y']}, cell binary, w binary")


def _sums(codes: np.ndarray, n: int, w: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of two matrices by code; every code below ``n`` occurs."""
    order = np.argsort(codes, kind="stable")
    heads = np.searchsorted(codes[order], np.arange(n))
    return np.add.reduceat(w[order], heads, axis=0, dtype=float), np.add.reduceat(s[order], heads, axis=0)


def _weighted(w: list[bytes], s: list[bytes], trees: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and weighted labels: of a row (its weights and its label) or of a cell's rows, summed before."""
    whole = np.array([len(v) > 8 or trees == 1 and len(u) == 8 for u, v in zip(w, s, strict=True)], dtype=bool)
    out = np.zeros((len(w), trees)), np.zeros((len(w), trees))
    for mine, kind in ((~whole, np.uint8), (whole, np.float64)):
        at = np.flatnonzero(mine)
        if len(at):
            out[0][at] = _matrix([w[i] for i in at], kind)
            labels = _matrix([s[i] for i in at], np.float64)
            out[1][at] = labels if kind is np.float64 else out[0][at] * labels
    return out


def cell_sums(rows: DataFrame, trees: int, parts: int) -> DataFrame:
    """(p, tree, cells, w, s): per part of the cells and tree, all cells with the sums of their weights and weighted labels.

    A cell with many rows in a batch is summed before it is sent, so a common cell is no large part.
    """
    def thinned(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column(1).cast(pa.float64()).to_numpy(zero_copy_only=False)
            if np.isnan(y).any():
                raise ValueError("a label is null or not a number")
            coded = batch.column(0).dictionary_encode()
            codes = np.asarray(coded.indices)
            many = np.bincount(codes) >= MANY_ROWS
            alone = np.flatnonzero(~many[codes])
            take = pa.array(alone)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(2).take(take), _bytes(y[alone, None])], names=["cell", "w", "s"])
            if many.any():
                at = np.flatnonzero(many[codes])
                w = _matrix(batch.column(2).take(pa.array(at)).to_pylist(), np.uint8)
                sums = _sums((np.cumsum(many) - 1)[codes[at]], int(many.sum()), w, w * y[at, None])
                yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(np.flatnonzero(many))), *map(_bytes, sums)], names=["cell", "w", "s"])

    def summed(batches):
        index, w, s, p = {}, np.zeros((0, trees)), np.zeros((0, trees)), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            p, coded = batch.column(0)[0].as_py(), batch.column(1).dictionary_encode()
            places = np.array([index.setdefault(c, len(index)) for c in coded.dictionary.to_pylist()])
            if len(index) > len(w):
                more = np.zeros((max(len(index), 2 * len(w)) - len(w), trees))
                w, s = np.vstack([w, more]), np.vstack([s, more])
            own = _sums(np.asarray(coded.indices), len(places), *_weighted(batch.column(2).to_pylist(), batch.column(3).to_pylist(), trees))
            w[places] += own[0]
            s[places] += own[1]
        cells, n = b"".join(index), len(index)
        for tree in range(trees if n else 0):
            cells_of = [[p], [tree], [cells], [w[:n, tree].tobytes()], [s[:n, tree].tobytes()]]
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells_of, kinds, strict=True)], names=["p", "tree", "cells", "w", "s"])

    sent = rows.select("cell", "y", "w").mapInArrow(thinned, "cell binary, w binary, s binary")
    dealt = sent.select(_part(parts), "cell", "w", "s").repartitionById(parts, F.col("p"))
    return dealt.mapInArrow(summed, "p int, tree int, cells binary, w binary, s binary")


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("cell"), F.lit(parts)).cast("int").alias("p")


def grow(bins: np.ndarray, w: np.ndarray, s: np.ndarray, per_split: int, depth: int, rng: np.random.Generator) -> np.ndarray:
    """Prediction of one tree for every cell, from the cells' sums of weights and of weighted labels.

    A node is split where the squared error falls most, by one of ``per_split`` features drawn
    for it, as long as it falls; ties go to the first feature and the lowest bin.
    """
    if not w.sum() > 0:
        raise ValueError("a resample is empty: too few rows for a tree")
    out, at, node = np.full(len(bins), s.sum() / w.sum()), np.arange(len(bins)), np.zeros(len(bins), dtype=np.int64)
    for _ in range(depth):
        n, mine = int(node.max()) + 1 if len(node) else 0, bins[at]
        if not n:
            break
        total_w, total_s = np.bincount(node, w[at], n), np.bincount(node, s[at], n)
        whole = total_s * total_s / total_w
        drawn = rng.random((n, bins.shape[1])).argsort(axis=1).argsort(axis=1) < per_split
        best, feature, last = 1e-12 * np.maximum(whole, 1e-300), np.full(n, -1), np.zeros(n, dtype=np.int64)
        for f in range(bins.shape[1]):
            key = node * 256 + mine[:, f]
            order = np.argsort(key, kind="stable")
            heads = np.flatnonzero(np.diff(key[order], prepend=-1))
            own, value = np.divmod(key[order[heads]], 256)
            firsts = np.flatnonzero(np.diff(own, prepend=-1))
            left_w, left_s = (_running(np.add.reduceat(v[at][order], heads), firsts, own) for v in (w, s))
            right_w, right_s = total_w[own] - left_w, total_s[own] - left_s
            open_ = (left_w > 0) & (right_w > 0) & drawn[own, f]
            gain = np.full(len(own), -1.0)
            gain[open_] = left_s[open_] ** 2 / left_w[open_] + right_s[open_] ** 2 / right_w[open_] - whole[own[open_]]
            top = np.maximum.reduceat(gain, firsts)
            hit = np.flatnonzero(gain == top[own])
            hit = hit[np.unique(own[hit], return_index=True)[1]]
            more = top > best
            best[more], feature[more], last[more] = top[more], f, value[hit][more]
        going = feature[node] >= 0
        at, node, mine = at[going], node[going], mine[going]
        right = mine[np.arange(len(at)), feature[node]] > last[node]
        node = np.unique(2 * node + right, return_inverse=True)[1].reshape(-1)
        if len(node):
            out[at] = (np.bincount(node, s[at]) / np.bincount(node, w[at]))[node]
    return out


def _running(values: np.ndarray, firsts: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Running totals that begin anew at ``firsts``."""
    upto = np.cumsum(values)
    return upto - (upto[firsts] - values[firsts])[own]


def grown(sums: DataFrame, features: int, per_split: int, depth: int, seed: int) -> DataFrame:
    """(p, tree, cells, est): each tree's predictions for the cells of every part; tree 0 names the cells."""
    def one(table):
        tree, parts = table["tree"][0].as_py(), table.sort_by("p").to_pylist()
        bins = np.frombuffer(b"".join(r["cells"] for r in parts), np.uint8).reshape(-1, features)
        w, s = (np.frombuffer(b"".join(r[c] for r in parts)) for c in ("w", "s"))
        est = grow(bins, w, s, per_split, depth, np.random.default_rng([seed, tree]))
        ends = np.cumsum([len(r["w"]) // 8 for r in parts])
        return pa.table({
            "p": pa.array([r["p"] for r in parts], pa.int32()), "tree": pa.array([tree] * len(parts), pa.int32()),
            "cells": pa.array([b"" if tree else r["cells"] for r in parts], pa.binary()),
            "est": pa.array([v.tobytes() for v in np.split(est, ends[:-1])], pa.binary()),
        })

    return sums.groupBy("tree").applyInArrow(one, "p int, tree int, cells binary, est binary")


def out_of_bag(rows: DataFrame, trees: DataFrame, features: int, parts: int) -> DataFrame:
    """(key, y, est, n_trees) of rows (key, y, cell, w): the mean over the trees in which the row's weight is 0."""
    kind = {c: rows.schema[c].dataType.simpleString() for c in ("key", "y")}
    none = [F.lit(None).cast(kind[c]).alias(c) for c in ("key", "y")]
    sent = rows.select(_part(parts), F.lit(1).alias("side"), F.lit(0).alias("tree"), "key", "y", "cell", "w")
    known = trees.select("p", F.lit(0).alias("side"), "tree", *none, F.col("cells").alias("cell"), F.col("est").alias("w"))
    both = known.unionByName(sent).repartitionById(parts, F.col("p")).sortWithinPartitions("side", "tree")

    def run(batches):
        held, index, est = [], {}, None
        for batch in batches:
            side = np.asarray(batch.column(1))
            first = int(np.searchsorted(side, 1))
            held += batch.column(6).slice(0, first).to_pylist()
            if first and not index:
                cells = batch.column(5)[0].as_py()
                index = {cells[i : i + features]: i // features for i in range(0, len(cells), features)}
            if first == len(side):
                continue
            if est is None:
                est = np.column_stack([np.frombuffer(v) for v in held])
            part = batch.slice(first)
            place = np.array([index[c] for c in part.column(5).to_pylist()])
            left = _matrix(part.column(6).to_pylist(), np.uint8) == 0
            n = left.sum(axis=1)
            mean = np.where(left, est[place], 0.0).sum(axis=1) / np.maximum(n, 1)
            some = pa.array(n > 0)
            columns = [part.column(3), part.column(4), pa.array(mean), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays([c.filter(some) for c in columns], names=["key", "y", "est", "n_trees"])

    return both.mapInArrow(run, f"key {kind['key']}, y {kind['y']}, est double, n_trees bigint")


def oob(train: DataFrame, trees: int, per_split: int, depth: int, seed: int) -> DataFrame | None:
    """Out-of-bag predictions of rows (key, y, x); None if their cells are too many for a task."""
    edges = bin_edges(train, "x")
    if not edges:
        return train.select("key", "y", F.lit(0.0).alias("est"), F.lit(0).cast("bigint").alias("n_trees")).limit(0)
    rows = stored(binned_rows(train, edges, trees, seed), "binned")
    if np.prod([len(e) + 1.0 for e in edges]) > CELLS and rows.select("cell").distinct().count() > CELLS:
        return None
    parts = partitions_for(rows)
    found = grown(cell_sums(rows, trees, parts), len(edges), per_split, depth, seed)
    return cut_lineage(out_of_bag(rows, cut_lineage(found), len(edges), parts))
