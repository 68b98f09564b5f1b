"""N-gram Jaccard self-join of documents with Bayesian pruning of MinHash candidates.

1. Equal texts are one node. Every node gets a MinHash signature of its word shingles.
2. Nodes meet in buckets of signature bands. Buckets with the same members count once.
3. Within a bucket, signatures are compared a few values at a time; a pair is dropped
   when the posterior probability that its similarity reaches the threshold falls below
   the tolerance. The bucket hands on a spanning forest of the pairs left, never all pairs.
4. Families are the components of these forests. Within a family every pair is verified
   exactly on its shingles, in blocks; a block hands on link counts and a spanning forest.
5. Classes are the components of the verified links.

Buckets and families beyond a block are cut into chunks, and every pair of chunks is a
block, so no task holds a whole large group. A pair at the threshold is missed by all
bands with a chance of 5e-8, and pruned with one of about the tolerance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graniteflow.llm.batches import add_columns
from graniteflow.operators.components import connected_components
from graniteflow.session import cut_lineage, partitions_for, small_side

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS, STEP, TOLERANCE = 32, 4, 16, 1e-6
HASHES = BANDS * ROWS
#: Members of a chunk: of signatures in a bucket, of whole texts in a family.
BUCKET_CHUNK, FAMILY_CHUNK = 1024, 512
_MIX = np.random.default_rng(20)
_A = _MIX.integers(0, 2**32, HASHES, np.uint32) | np.uint32(1)
_B = _MIX.integers(0, 2**32, HASHES, np.uint32)
_WEIGHTS = _MIX.integers(0, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(texts: list[bytes], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the word shingles of all texts, one text after another, and how many each has.

    A text of fewer than ``width`` words, but at least one, is one shingle.
    """
    split = [t.split() for t in texts]
    numbers: dict[bytes, int] = {}
    counts = np.fromiter(map(len, split), np.int64, len(split))
    order = np.fromiter((numbers.setdefault(w, len(numbers)) for w in chain.from_iterable(split)), np.int64, int(counts.sum()))
    words = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))[order]
    sizes = np.where(counts > 0, np.maximum(1, counts - width + 1), 0)
    starts = np.cumsum(counts) - counts
    first = np.repeat(starts, sizes) + np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    spans = np.repeat(np.minimum(counts, width), sizes)
    total = spans.astype(np.uint64) * _WEIGHTS[63]
    for k in range(width):
        inside = k < spans
        total[inside] += words[first[inside] + k] * _WEIGHTS[k]
    return _scramble(total), sizes


def signatures(texts: list[bytes], width: int = SHINGLE) -> list[bytes | None]:
    """MinHash signatures as little-endian 16-bit values; None without a shingle."""
    out: list[bytes | None] = []
    for a in range(0, len(texts), 100):
        hashes, sizes = shingle_hashes(texts[a : a + 100], width)
        small = (hashes >> np.uint64(32)).astype(np.uint32)
        there = np.flatnonzero(sizes)
        starts = (np.cumsum(sizes) - sizes)[there]
        table = np.empty((len(there), HASHES), "<u2")
        for k in range(HASHES if len(there) else 0):
            low = np.minimum.reduceat(small * _A[k] + _B[k], starts)
            table[:, k] = (low ^ (low >> np.uint32(16))) & np.uint32(0xFFFF)
        rows: list[bytes | None] = [None] * len(sizes)
        for i, sig in zip(there.tolist(), table, strict=True):
            rows[i] = sig.tobytes()
        out += rows
    return out


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(values compared, fewest equal ones to go on): with a uniform prior, the posterior probability
    of a similarity of at least ``threshold`` after m of n equal values is P(Binomial(n + 1, threshold) <= m)."""
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def surviving(left: np.ndarray, right: np.ndarray, limits: list[tuple[int, int]]) -> np.ndarray:
    """True for pairs (row of ``left``, row of ``right``) that are never pruned."""
    alive = np.ones((len(left), len(right)), bool)
    i, j = np.nonzero(alive)
    matches = np.zeros(len(i), np.int64)
    before = 0
    for n, least in limits:
        matches += (left[i, before:n] == right[j, before:n]).sum(1)
        go = matches >= least
        alive[i[~go], j[~go]] = False
        i, j, matches, before = i[go], j[go], matches[go], n
    return alive


def _forest(count: int, linked) -> Iterator[tuple[int, int]]:
    """(node, root) of a search by ``linked(frontier, unseen) -> matrix``; each node is compared with unseen ones only."""
    unseen = np.arange(count)
    while len(unseen) > 1:
        root, unseen = int(unseen[0]), unseen[1:]
        frontier = np.array([root])
        while len(frontier) and len(unseen):
            now, frontier = frontier[:64], frontier[64:]
            hit = np.zeros(len(unseen), bool)
            for a in range(0, len(unseen), 1024):
                hit[a : a + 1024] = linked(now, unseen[a : a + 1024]).any(0)
            for node in unseen[hit].tolist():
                yield node, root
            frontier = np.concatenate([frontier, unseen[hit]])
            unseen = unseen[~hit]


def _groups(batches, names: list[str], group: str) -> Iterator[dict[str, list]]:
    """Columns of each run of equal ``group``, over batches sorted by it."""
    held: dict[str, list] = {n: [] for n in names}
    current = None
    for batch in batches:
        columns = {n: batch.column(batch.schema.get_field_index(n)) for n in names}
        ids = batch.column(batch.schema.get_field_index(group)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if current is not None and ids[a] != current:
                yield held
                held = {n: [] for n in names}
            current = ids[a]
            for n in names:
                held[n] += columns[n].slice(a, b - a).to_pylist()
    if current is not None:
        yield held


def _blocks(df: DataFrame, group: str, size: str, node: str, chunk: int) -> DataFrame:
    """``_block`` for every pair of chunks that a row's chunk takes part in, and ``_side`` (0 first, 1 second chunk)."""
    chunks = F.greatest(F.lit(1), F.ceil(F.col(size) / chunk)).cast("int")
    mine = F.pmod(F.xxhash64(F.lit(3), F.col(node)), chunks).cast("int")
    spread = df.withColumn("_mine", mine).withColumn("_other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    low, high = F.least("_mine", "_other"), F.greatest("_mine", "_other")
    return spread.withColumn("_block", F.xxhash64(group, low, high)).withColumn("_side", (F.col("_mine") > F.col("_other")).cast("int")).withColumn(
        "_pair", F.struct(F.col(group).alias("g"), low.alias("low"), high.alias("high"))
    ).drop("_mine", "_other")


def _dealt(df: DataFrame) -> DataFrame:
    return df.repartition(partitions_for(df), "_block").sortWithinPartitions("_block")


def _bands(nodes: DataFrame) -> DataFrame:
    """(band, node): a row for each band of each signature."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(-1, BANDS, ROWS).astype(np.uint64)
                value = sig[:, :, 0]
                for k in range(1, ROWS):
                    value = (value << np.uint64(16)) | sig[:, :, k]
                band = _scramble(_scramble(value) + np.arange(1, BANDS + 1, dtype=np.uint64) * _WEIGHTS[7])
                keys = batch.column(0).take(pa.array(np.repeat(np.arange(len(band)), BANDS)))
                yield pa.RecordBatch.from_arrays([pa.array(band.reshape(-1).view(np.int64)), keys], names=["band", "node"])

    return nodes.where("sig IS NOT NULL").select("node", "sig").mapInArrow(run, "band bigint, node binary")


def _families(nodes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(node, label) of the components of pairs that survive the pruning."""
    bands = _bands(nodes)
    kept = bands.groupBy("band").agg(
        F.count(F.lit(1)).alias("_size"), F.bit_xor(F.xxhash64("node")).alias("_x"), F.bit_xor(F.xxhash64(F.lit(9), F.col("node"))).alias("_y")
    ).where("_size > 1").groupBy("_size", "_x", "_y").agg(F.min("band").alias("band"))
    members = _blocks(bands.join(kept.select("band", "_size"), "band"), "band", "_size", "node", BUCKET_CHUNK)
    rows = members.join(nodes.select("node", "sig"), "node").select("_block", "node", "sig")
    limits = least_matches(threshold, tolerance)

    def run(batches):
        for got in _groups(batches, ["node", "sig"], "_block"):
            table = np.frombuffer(b"".join(got["sig"]), "<u2").reshape(-1, HASHES)
            names = got["node"]
            edges = list(_forest(len(names), lambda f, u: surviving(table[f], table[u], limits)))
            if edges:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i] for i, _ in edges], pa.binary()), pa.array([names[j] for _, j in edges], pa.binary())], names=["a", "b"]
                )

    edges = cut_lineage(_dealt(rows).mapInArrow(run, "a binary, b binary"))
    ends = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    return connected_components(ends, edges).select(F.col("id").alias("node"), "label")


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Shared shingles of every two sets: products of incidence matrices, in slices of shared shingles."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for a in range(0, int(shared.sum()), 2048):
        lo, hi = np.searchsorted(column, [a, a + 2048])
        part = np.zeros((len(sets), 2048), np.float32)
        part[owner[lo:hi], column[lo:hi] - a] = 1
        out += part @ part.T
    return out


def _verified(members: DataFrame, threshold: float, width: int) -> DataFrame:
    """(a, b, n): b null and n links counted in one block for node a, or an edge of a block's forest."""

    def run(batches):
        for got in _groups(batches, ["node", "_side", "_same", "text"], "_block"):
            first = {}
            for node, side, same, text in zip(got["node"], got["_side"], got["_same"], got["text"], strict=True):
                first.setdefault(node, (side, same, (text or "").encode()))
            names = list(first)
            hashes, sizes = shingle_hashes([t for _, _, t in first.values()], width)
            sets = [np.unique(h) for h in np.split(hashes, np.cumsum(sizes)[:-1])]
            length = np.array([len(s) for s in sets])
            shared = _overlaps(sets)
            linked = shared >= threshold * (length[:, None] + length[None, :] - shared) - 1e-9
            linked &= (shared > 0) & ~np.eye(len(names), dtype=bool)
            side = np.array([s for s, _, _ in first.values()])
            same = np.array([s for _, s, _ in first.values()])
            # Pairs within a chunk belong to its block with itself.
            own = same[:, None] & same[None, :] | (side[:, None] != side[None, :])
            count = (linked & own).sum(1)
            a = [names[i] for i in np.flatnonzero(count)]
            n = count[count > 0].tolist()
            edges = list(_forest(len(names), lambda f, u: linked[np.ix_(f, u)]))
            if a:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(a + [names[i] for i, _ in edges], pa.binary()),
                        pa.array([None] * len(a) + [names[j] for _, j in edges], pa.binary()), pa.array(n + [0] * len(edges), pa.int64()),
                    ], names=["a", "b", "n"],
                )

    return _dealt(members).mapInArrow(run, "a binary, b binary, n bigint")


def text_node(text) -> F.Column:
    """128-bit key of a text; null is empty."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


def text_classes(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, tolerance: float = TOLERANCE, width: int = SHINGLE,
) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): rows has id and node of every row; nodes has, for each distinct text, node, ``first_id``
    (smallest id with the text), ``n_copies``, ``n_links``, ``class_id``, the smallest id of the class, and
    ``label``, the smallest node of the class.

    Links join different texts whose sets of word shingles have a Jaccard similarity of at
    least ``threshold``. Texts without a word have no links; null is the empty text.
    """
    source = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("node", text_node(F.col("text")))
    rows = cut_lineage(add_columns(source, "text", "sig binary", lambda: lambda texts: [pa.array(signatures(texts, width), pa.binary())], ["_id", "node"]))
    nodes = cut_lineage(rows.groupBy("node").agg(F.min("_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies"), F.max("sig").alias("sig")))
    family = cut_lineage(_families(nodes, threshold, tolerance))
    sizes = family.groupBy("label").agg(F.count(F.lit(1)).alias("_size"))
    members = family.join(sizes, "label").join(nodes.select("node", "first_id"), "node")
    members = cut_lineage(_blocks(members, "label", "_size", "node", FAMILY_CHUNK))
    members = members.select(
        F.col("node").alias("_node"), "first_id", "_block", "_side", (F.col("_pair.low") == F.col("_pair.high")).alias("_same")
    )
    members = small_side(members, members.count(), 128)
    texts = source.join(members, (F.col("node") == F.col("_node")) & F.col("_id").eqNullSafe(F.col("first_id")))
    found = cut_lineage(_verified(texts.select("_block", "node", "_side", "_same", "text"), threshold, width))
    edges = cut_lineage(found.where("b IS NOT NULL").select("a", "b"))
    ends = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    classes = connected_components(ends, edges).select(F.col("id").alias("node"), "label")
    links = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n_links"))
    nodes = nodes.drop("sig").join(classes, "node", "left").join(links, "node", "left").withColumn("label", F.coalesce("label", "node"))
    lowest = nodes.groupBy("label").agg(F.min("first_id").alias("class_id"))
    nodes = nodes.join(lowest, "label").select("node", "first_id", "n_copies", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), "class_id", "label")
    return rows.select("_id", "node"), cut_lineage(nodes)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``df``: id, class_id, n_links (different texts linked to its text), n_copies (rows with its text).

    Repeated rows are copies; a class whose ids are all null has a null class_id; an empty
    table gives no rows; other columns are not read.
    """
    rows, nodes = text_classes(df, id_col, text_col, **options)
    return rows.join(nodes, "node").select(F.col("_id").alias(id_col), "class_id", "n_links", "n_copies")


def keep_one_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each class of ``near_duplicates``, with all its columns: the one with the smallest id
    (null only if all are), of these the one with the smallest key of its text."""
    rows, nodes = text_classes(df, id_col, text_col, **options)
    chosen = nodes.groupBy("label").agg(F.min(F.struct(F.col("first_id").isNull(), "first_id", "node")).alias("_best")).select("_best.*")
    same = rows.groupBy("_id", "node").agg(F.count(F.lit(1)).alias("_rows"))
    chosen = cut_lineage(
        chosen.select(F.col("node").alias("_node"), F.col("first_id").alias("_first")).join(
            same, (F.col("node") == F.col("_node")) & F.col("_id").eqNullSafe(F.col("_first"))
        ).select("_node", "_first", "_rows")
    )
    chosen = small_side(chosen, chosen.count(), 64)
    source = df.select(F.struct("*").alias("_row"), text_node(F.col(text_col)).alias("_of"), F.col(id_col).alias("_key"))

    def taken(one: bool) -> DataFrame:
        return source.join(chosen.where((F.col("_rows") == 1) == one), (F.col("_of") == F.col("_node")) & F.col("_key").eqNullSafe(F.col("_first")))

    # Of repeated rows, equal in id and text, any one stays.
    repeated = taken(False).groupBy("_of").agg(F.first("_row").alias("_row"))
    return taken(True).select("_row.*").unionByName(repeated.select("_row.*"))
