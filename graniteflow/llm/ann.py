"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Vectors are scaled by the largest norm and get one more component that makes them unit
vectors, so that the largest inner product is the least Euclidean distance. A table hashes
a vector to the slots floor((a·x + b) / w) of its normal (2-stable) directions. A query
knows where its neighbours lie likely: with cosine c to it, a neighbour's projection is
normal around c times its own with variance 1 - c². This gives every bucket its chance of
success; buckets are visited from the most likely one down until the chances sum to the
target. The candidates of all tables are merged and ranked by exact inner products.

Buckets next to each other in code are stored as blocks; a block beyond the bound is dealt
over several tasks, and so are the queries that visit it. Every row is indexed. The cosine
of a query's twentieth neighbour is read from a bounded sample of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graniteflow.session import cut_lineage, small_side, spread

#: Rows that the directions' scale, block borders and neighbour cosines are read from.
SAMPLE_ROWS = 2048
#: Bytes of the vectors of a block, and of the queries that meet it at a time.
BLOCK_BYTES = 4 << 20
ROWS_PER_BUCKET, WIDTH, REACH = 300, 1.5, 2


@dataclass
class Model:
    """Hash tables: ``planes`` (tables, dim + 1, k), ``shifts`` (tables, k), borders of blocks in code, and the sample."""

    planes: np.ndarray
    shifts: np.ndarray
    borders: list[np.ndarray]
    norm: float
    sample: np.ndarray
    rank: int
    target: float

    def projected(self, vectors: np.ndarray, table: int) -> np.ndarray:
        unit = vectors / self.norm
        rest = np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(1)))
        return np.column_stack([unit, rest]) @ self.planes[table] + self.shifts[table]

    def codes(self, vectors: np.ndarray, table: int) -> np.ndarray:
        slots = np.clip(np.floor(self.projected(vectors, table) / WIDTH), -REACH, REACH - 1).astype(np.int64) + REACH
        code = np.zeros(len(vectors), np.int64)
        for column in slots.T:
            code = code * (2 * REACH) + column
        return code

    def cosines(self, queries: np.ndarray) -> np.ndarray:
        """Likely cosine of each query's last wanted neighbour, from the sample."""
        length = np.linalg.norm(queries, axis=1) * self.norm
        near = np.partition(queries @ self.sample.T, len(self.sample) - self.rank, axis=1)[:, len(self.sample) - self.rank]
        return np.clip(near / length, -0.999, 0.999999)

    def visits(self, query: np.ndarray, cosine: float, table: int) -> np.ndarray:
        """Codes of the buckets to visit, the most likely first."""
        unit = np.append(query / np.linalg.norm(query), 0.0)
        spot, spread_ = cosine * (unit @ self.planes[table]), math.sqrt(2.0 * (1.0 - cosine * cosine))
        inner = np.arange(-REACH + 1, REACH) * WIDTH
        mass, code = np.ones(1), np.zeros(1, np.int64)
        slack = 0.1 * (1.0 - self.target) / max(1, len(spot))
        for mean, shift in zip(spot, self.shifts[table], strict=True):
            below = [0.5 * (1.0 + math.erf((edge - shift - mean) / spread_)) for edge in inner]
            chance = np.diff([0.0, *below, 1.0])
            mass = np.outer(mass, chance).ravel()
            code = (code[:, None] * (2 * REACH) + np.arange(2 * REACH)).ravel()
            order = np.argsort(-mass, kind="stable")
            total = np.cumsum(mass[order])
            order = order[: np.searchsorted(total, total[-1] - slack) + 1]
            mass, code = mass[order], code[order]
        return code[: np.searchsorted(np.cumsum(mass), self.target) + 1]

    def blocks(self, codes: np.ndarray, table: int) -> np.ndarray:
        return np.searchsorted(self.borders[table], codes, side="right")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _usable(vec: Column) -> Column:
    """Whether a vector has components, all finite, not all zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return vec.isNotNull() & (F.size(vec) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(vec, lambda x: x != 0)


def distinct_vectors(df: DataFrame, id_col: str, vec_col: str, most: int) -> DataFrame:
    """(vec, ids): each usable vector once, with the ``most`` smallest of its ids in order.

    Of equal vectors no others can be among the nearest. Vectors of another length than
    most have take no part; neither do rows with a null id.
    """
    rows = df.where(F.col(id_col).isNotNull() & _usable(F.col(vec_col))).select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("vec"))
    size = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).first()
    rows = rows.where(F.size("vec") == (size["n"] if size else 0))
    ranked = rows.withColumn("_r", F.dense_rank().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("_r") <= most)
    return ranked.groupBy("vec").agg(F.sort_array(F.collect_set("id")).alias("ids"))


def fit(vectors: DataFrame, k: int, tables: int, recall: float, seed: int) -> tuple[Model, int] | None:
    """Model for a table of distinct vectors and its row count; None without rows."""
    vec = F.transform("vec", lambda x: x.cast("double"))
    square = F.aggregate(vec, F.lit(0.0), lambda s, x: s + x * x)
    row = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("square"), F.max(F.size("vec")).alias("dim")).first()
    if not row["n"]:
        return None
    n, dim = row["n"], row["dim"]
    picked = vectors.select("vec", F.xxhash64(F.element_at("ids", 1), F.lit(seed)).alias("h")).orderBy("h").limit(SAMPLE_ROWS).collect()
    sample = np.array([r["vec"] for r in picked], np.float64)
    hashes = max(0, round(math.log(n / ROWS_PER_BUCKET) / math.log(2.5)))
    rng = np.random.default_rng(seed)
    planes, shifts = rng.normal(size=(tables, dim + 1, hashes)), rng.uniform(0, WIDTH, (tables, hashes))
    rank = min(len(sample), math.ceil(k * len(sample) / n) + 1)
    model = Model(planes, shifts, [], math.sqrt(row["square"]), sample, rank, 1.0 - (1.0 - recall) ** (1.0 / tables))
    blocks = math.ceil(n * dim * 4 / BLOCK_BYTES)
    for t in range(tables):
        codes = np.sort(model.codes(sample, t))
        model.borders.append(np.unique(codes[[len(codes) * i // blocks for i in range(1, blocks)]]) if blocks > 1 else codes[:0])
    return model, n


def _entries(model: Model, dim: int):
    """(table, block, code) of each vector, once per table."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            vectors = _matrix(batch.column(0), dim)
            for t in range(len(model.planes)):
                codes = model.codes(vectors, t)
                head = [pa.array(np.full(len(codes), t, np.int32)), pa.array(model.blocks(codes, t).astype(np.int64)), pa.array(codes)]
                yield pa.RecordBatch.from_arrays([*head, batch.column(0), batch.column(1)], names=["table", "block", "code", "vec", "ids"])

    return run


def _probes(model: Model, dim: int):
    """For each query, table and block: the codes to visit there."""
    def run(batches: Iterator[pa.RecordBatch]):
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                batch = whole.slice(a, 256)
                vectors = _matrix(batch.column(0), dim)
                cosines = model.cosines(vectors)
                head, codes, take = [], [], []
                for i, (vector, cosine) in enumerate(zip(vectors, cosines, strict=True)):
                    for t in range(len(model.planes)):
                        seen = model.visits(vector, cosine, t)
                        at = model.blocks(seen, t)
                        for block in np.unique(at):
                            head.append((t, int(block)))
                            codes.append(seen[at == block])
                            take.append(i)
                if head:
                    tables, blocks = zip(*head, strict=True)
                    rest = [batch.column(c).take(pa.array(take)) for c in (0, 1)]
                    columns = [pa.array(tables, pa.int32()), pa.array(blocks, pa.int64()), pa.array(codes, pa.list_(pa.int64())), *rest]
                    yield pa.RecordBatch.from_arrays(columns, names=["table", "block", "codes", "vec", "query_id"])

    return run


def _best(scores: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``most`` largest of each row; of equal ones at the border the first columns."""
    if scores.shape[1] <= most:
        return np.divmod(np.arange(scores.size), scores.shape[1])
    border = np.partition(scores, scores.shape[1] - most, axis=1)[:, scores.shape[1] - most]
    keep = scores >= border[:, None]
    for r in np.nonzero(keep.sum(1) > most)[0]:
        ties = np.nonzero(scores[r] == border[r])[0]
        keep[r, ties[most - (scores[r] > border[r]).sum() :]] = False
    return np.nonzero(keep)


def _search(k: int, dim: int):
    """The ``k`` best of a block's rows for each query that visits it; ids of equal vectors are spread out."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return schema.empty_table()
        ids = rows.column("ids").combine_chunks()
        first = np.asarray(ids.flatten())[np.asarray(ids.offsets)[:-1] - ids.offsets[0].as_py()]
        codes = rows.column("code").to_numpy()
        order = np.lexsort((first, codes))
        codes, vectors = codes[order], _matrix(rows.column("vec").combine_chunks(), dim)[order]
        ids = ids.take(pa.array(order)).to_pylist()
        asked = _matrix(queries.column("vec").combine_chunks(), dim)
        visits = queries.column("codes").combine_chunks()
        wanted, who = np.asarray(visits.flatten()), np.repeat(np.arange(len(asked)), np.diff(np.asarray(visits.offsets)))
        by = np.argsort(wanted, kind="stable")
        wanted, who = wanted[by], who[by]
        there, start = np.unique(codes, return_index=True)
        found = []
        for code, a, b in zip(there, start, [*start[1:], len(codes)], strict=True):
            some = who[np.searchsorted(wanted, code) : np.searchsorted(wanted, code, "right")]
            step = max(1, (1 << 22) // (b - a))
            for s in range(0, len(some), step):
                part = some[s : s + step]
                scores = asked[part] @ vectors[a:b].T
                r, c = _best(scores, k + 1)
                found.append((part[r], c + a, scores[r, c]))
        if not found:
            return schema.empty_table()
        query, row, score = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((row, -score, query))
        query, row, score = query[order], row[order], score[order]
        begin = np.searchsorted(query, query)
        near = np.arange(len(query)) - begin <= k
        names, out = queries.column("query_id").to_pylist(), []
        for q, r, s in zip(query[near].tolist(), row[near].tolist(), score[near].tolist(), strict=True):
            out += [(names[q], i, s) for i in ids[r] if i != names[q]]
        return pa.table([pa.array(c) for c in zip(*out, strict=True)], schema=schema) if out else schema.empty_table()

    return run


def nearest(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, every: int = 20, tables: int = 2,
    recall: float = 0.94, seed: int = 11,
) -> DataFrame:
    """The ``k`` nearest rows found for each row whose id is divisible by ``every``.

    One row per query and neighbour: query_id, rank (from 1), vec_id, score (inner product
    in double precision). Nearest first, ties to the smaller id; rows with the query's id
    are left out. Rows that share an id are one item with several vectors, whose score is
    the largest among them. Vectors that are null, empty, zero, hold null or non-finite
    components or have another length than most take no part; neither do null ids. Equal
    vectors are compared once. ``recall`` is the chance aimed at that a neighbour is found;
    below some hundred rows there is one bucket, so the result is exact.
    """
    out = "query_id bigint, vec_id bigint, score double"
    vectors = cut_lineage(distinct_vectors(df, id_col, vec_col, k + 1))
    fitted = fit(vectors, k, tables, recall, seed)
    if fitted is None:
        return df.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    model, n = fitted
    dim, kind = model.sample.shape[1], vectors.schema["vec"].dataType.simpleString()
    entries = vectors.mapInArrow(_entries(model, dim), f"table int, block bigint, code bigint, vec {kind}, ids array<bigint>")
    per_block = max(1, BLOCK_BYTES // (4 * dim))
    asking = df.where((F.col(id_col) % every == 0) & _usable(F.col(vec_col)) & (F.size(vec_col) == dim))
    asking = cut_lineage(spread(asking.select(F.col(vec_col).alias("vec"), F.col(id_col).cast("bigint").alias("query_id")).distinct()))
    parts = max(1, math.ceil(asking.count() / per_block))
    sizes = entries.groupBy("table", "block").agg(F.ceil(F.count(F.lit(1)) / per_block).cast("int").alias("deals"))
    sizes = small_side(cut_lineage(sizes), sum(len(b) + 1 for b in model.borders), 32)
    rows = entries.join(sizes, ["table", "block"]).withColumn("deal", F.pmod(F.xxhash64(F.element_at("ids", 1)), F.col("deals")).cast("int"))
    rows = rows.select("table", "block", "deal", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "code", "vec", "ids")
    probes = asking.mapInArrow(_probes(model, dim), f"table int, block bigint, codes array<bigint>, vec {kind}, query_id bigint")
    probes = probes.join(sizes, ["table", "block"]).withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)))
    probes = probes.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int"))
    spot = ["table", "block", "deal", "part"]
    pairs = rows.groupBy(*spot).cogroup(probes.groupBy(*spot)).applyInArrow(_search(k, dim), out)
    best = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
