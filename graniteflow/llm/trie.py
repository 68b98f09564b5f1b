"""Prefix trie of conversations: every distinct run of leading turns is a node.

A turn is a token of 40 bytes: the SHA-256 of its role and text, and its number of words.
Conversations with equal turns are one path with its members. The paths are sorted in
ranges; every task cuts its sorted stream into range shards of bounded size. A shard
numbers its tokens (its dictionary), puts the paths into ternary search trees, the median
first so that the search of a child stays balanced, and sums members, leaves and savings
in one pass over the nodes from the last to the first, without recursion. Only nodes on a
shard's first and last path can have members in another shard; they stay open and are the
paths of the next round, in which neighbouring shards meet, until one shard holds all that
is open. A very common turn is thus one node of many shards, never one task.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graniteflow.llm.mixing import WORD, word_count
from graniteflow.llm.sqltext import sql_crc32
from graniteflow.session import cut_lineage, partitions_for, small_side

#: A shard ends at so many paths or tokens, but has at least so many paths.
SHARD_PATHS, SHARD_TOKENS, LEAST_PATHS = 20_000, 200_000, 16
#: Member ids are joined to texts by ranges of so many ids before they meet.
ID_RANGE = 4096
NONE = sha256(b"").hexdigest()

_AT = "array<struct<convs:bigint,low:bigint,kids:bigint,leaves:bigint,saved:bigint,ends:string>>"
_OUT = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, "
    f"ends_sha256 string, key string, parent_key string, path array<binary>, at {_AT}"
)
_NODE = _OUT.split(", path ")[0]


def turn_token(role: Column, text: Column) -> Column:
    """40 bytes of a turn: digest of role and text, then the words of the text."""
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(F.unhex(digest), F.unhex(F.lpad(F.hex(word_count(text)), 16, "0")))


def conversation_paths(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, path): the tokens of each conversation in the order of the turns.

    Null turns come first; equal turns are ordered by role, then by token. Null roles and
    texts are empty. Rows with a null id belong to no conversation. Texts stay where they are.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv_id"), F.struct(F.col(turn_col).alias("turn"), role.alias("role"), turn_token(role, text).alias("token")).alias("t")
    )
    in_order = F.sort_array(F.collect_list("t"))
    return turns.groupBy("conv_id").agg(F.transform(in_order, lambda t: t["token"]).alias("path"))


def regrown(paths: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of conversation c - c % ``every``; h = CRC-32 of c modulo ``most``.

    A conversation to take turns from that is absent or shorter gives what it has. ``%`` has
    the sign of c, as in SQL.
    """
    stored = cut_lineage(paths)
    heads = stored.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_base"), F.slice("path", 1, most - 1).alias("_head"))
    own = stored.withColumn("_base", F.col("conv_id") - F.col("conv_id") % every)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    head = F.coalesce(F.slice("_head", F.lit(1), h), F.array().cast("array<binary>"))
    tail = F.slice("path", h + 1, F.greatest(F.size("path") - h, F.lit(0)))
    return own.join(heads, "_base", "left").select("conv_id", F.concat(head, tail).alias("path"))


class _Shard:
    """Ternary search trees of one range shard."""

    def __init__(self, items: list):
        """``items``: (path, at) in order, ``at`` a dict from depth to a partial sum."""
        names = sorted({t for path, _ in items for t in path})
        code = {t: i for i, t in enumerate(names)}
        self.names, self.paths = names, [[code[t] for t in path] for path, _ in items]
        self.token, self.parent, self.depth = [-1], [-1], [0]
        self.first, self.left, self.right = [-1], [-1], [-1]
        self.sums: list[list] = [[0, None, 0, 0, 0, ""]]
        spans = [(0, len(items))]
        for a, b in spans:  # the list grows: medians first, level by level
            if a < b:
                middle = (a + b) // 2
                nodes = self._put(self.paths[middle])
                for d, part in items[middle][1].items():
                    self._add(nodes[d], part)
                spans += [(a, middle), (middle + 1, b)]

    def _node(self, token: int, parent: int) -> int:
        for column, value in ((self.token, token), (self.parent, parent), (self.depth, self.depth[parent] + 1), (self.first, -1), (self.left, -1), (self.right, -1)):
            column.append(value)
        self.sums.append([0, None, 0, 0, 0, ""])
        return len(self.token) - 1

    def _put(self, path: list[int]) -> list[int]:
        """Nodes of a path from the root down; absent ones are made."""
        at, out, token, left, right = 0, [0], self.token, self.left, self.right
        for t in path:
            p = self.first[at]
            if p < 0:
                p = self.first[at] = self._node(t, at)
            while token[p] != t:
                side = left if t < token[p] else right
                if side[p] < 0:
                    side[p] = self._node(t, at)
                p = side[p]
            at = p
            out.append(p)
        return out

    def _add(self, node: int, part) -> None:
        s = self.sums[node]
        s[0] += part[0]
        s[1] = part[1] if s[1] is None else s[1] if part[1] is None else min(s[1], part[1])
        s[2] += part[2]
        s[3] += part[3]
        s[4] += part[4]
        s[5] = s[5] or part[5]

    def close(self, last: bool, keyed: bool) -> tuple[list, list]:
        """(finished nodes, open paths) of the shard; unless it is the last one, its first and last path stay open.

        Open nodes have a key, a digest of their tokens from the root; ``keyed`` gives it to all nodes.
        """
        ends = [] if last else [self._put(self.paths[0]), self._put(self.paths[-1])][: 1 if len(self.paths) == 1 else 2]
        is_open = {v for path in ends for v in path}
        sums, parent, low = self.sums, self.parent, [None] * len(self.token)
        for v in range(len(low) - 1, -1, -1):  # children were made after their parents
            if v not in is_open:
                s = sums[v]
                s[3] += s[2] == 0
                if v:
                    s[4] += (s[0] - 1) * int.from_bytes(self.names[self.token[v]][32:], "big")
                    self._add(parent[v], (s[0], s[1], 1, s[3], s[4], ""))
                low[v] = s[1]
        keys: dict[int, bytes] = {}
        for v in range(len(low)) if keyed else sorted(is_open):
            keys[v] = sha256(keys[parent[v]] + self.names[self.token[v]]).digest() if v else b""
        done = []
        for v, least in enumerate(low):
            if least is not None:
                s, waits = sums[v], parent[v] in is_open
                done.append((
                    least, self.depth[v], None if waits or not v else low[parent[v]], s[0], s[2], s[3], s[4], s[5] or NONE,
                    keys[v].hex() if keyed else None, keys[parent[v]].hex() if waits else None,
                ))
        left = []
        for path in ends:
            left.append(([self.names[self.token[v]] for v in path[1:]], [sums[v] for v in path]))
            for v in path:  # a node of both paths is carried by the first
                sums[v] = [0, None, 0, 0, 0, ""]
        return done, left


def _frame(done: list, left: list) -> pa.RecordBatch:
    """One batch of finished nodes and open paths."""
    n, m = len(done), len(left)
    kinds = [pa.int64()] * 7 + [pa.string()] * 3
    columns = [pa.array([*c, *[None] * m], t) for c, t in zip(zip(*done, strict=True) if done else [()] * 10, kinds, strict=True)]
    part = pa.struct([("convs", pa.int64()), ("low", pa.int64()), ("kids", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string())])
    fields = [f.name for f in part]
    columns.append(pa.array([None] * n + [p for p, _ in left], pa.list_(pa.binary())))
    columns.append(pa.array([None] * n + [[dict(zip(fields, s, strict=True)) for s in at] for _, at in left], pa.list_(part)))
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _NODE.split(", ")] + ["path", "at"])


def _first_paths(batches):
    """(path, its members at the end) from rows (path, n, low, ids) sorted by path and ids; ids are hashed as they stream by."""
    path = hasher = None
    for batch in batches:
        for r in range(0, batch.num_rows, 500):
            for tokens, n, low, ids in zip(*(c.to_pylist() for c in batch.slice(r, 500).columns[:4]), strict=True):
                if path is not None and tokens == path:
                    hasher.update(b"," + ids.encode())
                    count, least = count + n, min(least, low)
                    continue
                if path is not None:
                    yield path, {len(path): (count, least, 0, 0, 0, hasher.hexdigest())}
                path, count, least, hasher = tokens, n, low, sha256(ids.encode())
    if path is not None:
        yield path, {len(path): (count, least, 0, 0, 0, hasher.hexdigest())}


def _open_paths(batches):
    """(path, partial sums by depth) from rows (path, at)."""
    for batch in batches:
        for r in range(batch.num_rows):
            path, at = (c[0].as_py() for c in batch.slice(r, 1).columns)
            yield path, {d: tuple(x.values()) for d, x in enumerate(at) if x["convs"] or x["kids"]}


def _shards(read, last: bool, keyed: bool, most_paths: int, most_tokens: int, least: int):
    """Function over sorted batches: cuts them into range shards and yields finished nodes and open paths."""
    def run(batches):
        shard, tokens = [], 0
        for path, at in read(batches):
            full = len(shard) >= most_paths or tokens >= most_tokens
            if full and len(shard) >= least and not last:
                yield _frame(*_Shard(shard).close(last, keyed))
                shard, tokens = [], 0
            shard.append((path, at))
            tokens += len(path) + 1
        if shard:
            yield _frame(*_Shard(shard).close(last, keyed))

    return run


def prefix_nodes(paths: DataFrame, most_paths: int = SHARD_PATHS, most_tokens: int = SHARD_TOKENS, least: int = LEAST_PATHS) -> DataFrame:
    """One row per node of the trie of ``paths`` (conv_id, path): see ``prefix_trie``.

    A range shard ends at ``most_paths`` paths or ``most_tokens`` tokens, but has ``least`` paths.
    """
    limits = most_paths, most_tokens, least
    ids = F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")))
    members = cut_lineage(paths.groupBy("path", F.floor(F.col("conv_id") / ID_RANGE).alias("at")).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"), ids.alias("ids")
    ))
    width = partitions_for(paths)
    ordered = members.repartitionByRange(width, "path").sortWithinPartitions("path", "at").select("path", "n", "low", "ids")
    rounds = [cut_lineage(ordered.mapInArrow(_shards(_first_paths, False, False, *limits), _OUT))]
    before = None
    while True:
        rest = rounds[-1].where(F.col("path").isNotNull()).select("path", "at")
        n, tokens = rest.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("path") + 1), F.lit(0))).first()
        if not n:
            break
        # A round that closes too little is followed by the last one.
        last = n <= least or (n <= most_paths and tokens <= most_tokens) or (before is not None and 10 * n > 9 * before)
        shards = max(1, min(width, n // (4 * least), max(n // most_paths, tokens // most_tokens)))
        rest = (rest.coalesce(1) if last else rest.repartitionByRange(shards, "path")).sortWithinPartitions("path")
        rounds.append(cut_lineage(rest.mapInArrow(_shards(_open_paths, last, True, *limits), _OUT)))
        before = n
        if last:
            break
    found = [r.where(F.col("path").isNull()).drop("path", "at") for r in rounds]
    nodes = found[0]
    for more in found[1:]:
        nodes = nodes.unionByName(more)
    late = rounds[-1].where("false").drop("path", "at") if len(found) == 1 else found[1]
    for more in found[2:]:
        late = late.unionByName(more)
    late = late.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_low"))
    late = small_side(late, late.count(), 100)
    settled = nodes.where(F.col("parent_key").isNull())
    waiting = nodes.where(F.col("parent_key").isNotNull()).join(late, "parent_key").withColumn("parent_conv_id", F.col("_low"))
    return settled.unionByName(waiting.drop("_low")).drop("key", "parent_key")


def prefix_trie(df: DataFrame, **columns) -> DataFrame:
    """Trie of the rebuilt conversations of a table of turns.

    One row per node: conv_id (its smallest member), depth, parent_conv_id (of the root: null), n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256 (of the ids of the conversations that end there).

    Null roles and texts are empty, rows with a null id belong to no conversation, equal
    turn numbers are ordered by role and token, repeated rows are turns of their own, an
    empty table has no node. Texts of any length are one token. A conversation's tokens
    (40 bytes a turn) are held in one row. The member ids of one path are hashed in one
    sequence, as SHA-256 demands, from joined texts of 4,096 possible ids that stream by.
    """
    return prefix_nodes(regrown(conversation_paths(df, **columns)))


TRIE_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
k AS (
  SELECT conv_id, turn, role, sha256(strlen(role) || ':' || role || text) AS k, len(regexp_extract_all(text, '{WORD}')) AS w FROM t),
own AS (
  SELECT conv_id, list({{'k': k, 'w': w}} ORDER BY turn NULLS FIRST, role, k) AS path, {sql_crc32("conv_id::VARCHAR")} % 4 AS h FROM k GROUP BY conv_id),
r AS MATERIALIZED (
  SELECT o.conv_id, list_concat(coalesce(b.path[1:o.h], []), o.path[o.h + 1:]) AS path
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
p AS (SELECT conv_id, path[1:d] AS pre, d, len(path) AS n FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM r)),
n AS MATERIALIZED (
  SELECT pre, d, min(conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN d > 0 THEN (count(*) - 1) * pre[d].w ELSE 0 END AS own,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends
  FROM p GROUP BY pre, d),
c AS MATERIALIZED (SELECT pre[1:d - 1] AS pre, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1),
m AS MATERIALIZED (SELECT n.*, coalesce(c.kids, 0) AS kids FROM n LEFT JOIN c ON c.pre = n.pre),
s AS (
  SELECT pre[1:k] AS pre, sum(own) AS saved, count(*) FILTER (kids = 0) AS leaves
  FROM (SELECT pre, own, kids, unnest(range(0, d + 1)) AS k FROM m) GROUP BY 1)
SELECT m.conv_id, m.d::BIGINT AS depth, u.conv_id AS parent_conv_id, m.n_convs, m.kids AS n_children, s.leaves AS n_leaves,
  s.saved::BIGINT AS saved_tokens, m.ends AS ends_sha256
FROM m JOIN s ON s.pre = m.pre LEFT JOIN m u ON m.d > 0 AND u.pre = m.pre[1:m.d - 1] AND u.d = m.d - 1
"""
