"""Nearest neighbours, Merkle manifest and conversation trie against brute force and odd tables."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from graniteflow.llm import ann, merkle, queries, trie

SMALL = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ neighbours
def brute(rows, k, every=20):
    """{query: [(score, id)…]} of rows (id, vector), nearest first."""
    size = defaultdict(int)
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    for _, v in ok:
        size[len(v)] += 1
    dim = max(size, key=lambda n: (size[n], n), default=0)
    ok = [(i, np.array(v, float)) for i, v in ok if len(v) == dim]
    out = {}
    for q in {i for i, _ in ok if i % every == 0}:
        best = {}
        for j, v in ok:
            if j != q:
                best[j] = max(best.get(j, -math.inf), *(float(w @ v) for i, w in ok if i == q))
        out[q] = sorted(((s, j) for j, s in best.items()), key=lambda x: (-x[0], x[1]))[:k]
    return out


def lists(df):
    got = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(got[r["query_id"]]) + 1
        got[r["query_id"]].append((r["score"], r["vec_id"]))
    return dict(got)


def test_few_rows_are_searched_exactly(spark):
    rng = random.Random(3)
    rows = [(i, [float(rng.randint(-3, 3)) for _ in range(4)]) for i in range(120)]
    rows += [(200 + i, [1.0, 2.0, 0.0, 1.0]) for i in range(60)]  # copies, and ties between whole-number scores
    rows += [(40, None), (60, []), (80, [0.0] * 4), (100, [1.0, None, 2.0, 3.0]), (140, [1.0, math.nan, 0.0, 0.0]), (160, [math.inf, 0.0, 0.0, 0.0])]
    rows += [(180, [1.0, 2.0]), (None, [9.0] * 4), (20, rows[20][1]), (20, [3.0, 3.0, 3.0, 3.0]), (0, [0.5, 0.5, -1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns({c: F.lit("x") for c in ("vec", "ids", "id", "block", "code")})
    want = brute(rows, 20)
    assert lists(ann.nearest(df)) == want and len(want) > 5
    few = df.where("vec_id < 9 OR vec_id IN (20, 220)")
    assert lists(ann.nearest(few)) == brute([r for r in rows if r[0] is not None and (r[0] < 9 or r[0] in (20, 220))], 20)
    assert ann.nearest(df.where("false")).count() == 0 and ann.nearest(df.where("vec_id IN (40, 60, 80)")).columns == ["query_id", "rank", "vec_id", "score"]


@pytest.mark.parametrize("kind", ["even", "norms", "groups"])
def test_recall_and_scores(spark, monkeypatch, kind):
    monkeypatch.setattr(ann, "BLOCK_BYTES", 4 * 24 * 300)  # many blocks, dealt and split
    rng = np.random.default_rng(1)
    x = rng.standard_normal((2500, 24))
    if kind == "norms":
        x *= rng.uniform(0.2, 3.0, (2500, 1))
    if kind == "groups":  # a third of the rows lie in one place
        x[:900] = x[0] + 0.05 * x[:900]
        x[900:] = x[900:1000].repeat(16, axis=0) + 0.3 * x[900:]
    ids = np.random.default_rng(2).permutation(2500)
    df = spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x, strict=True)], "vec_id bigint, embedding array<double>")
    got = lists(ann.nearest(df))
    place = {int(i): n for n, i in enumerate(ids)}
    assert set(got) == {i for i in range(0, 2500, 20)}
    hits = 0
    for q, found in got.items():
        s = x @ x[place[q]]
        assert len(found) == 20 and len({j for _, j in found}) == 20 and found == sorted(found, key=lambda f: (-f[0], f[1]))
        assert all(abs(score - s[place[j]]) < 1e-9 for score, j in found)
        s[place[q]] = -np.inf
        hits += len({int(ids[n]) for n in np.argsort(-s)[:20]} & {j for _, j in found})
    assert hits / (20 * len(got)) >= 0.9


def test_registered_search_finds_most(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got, want = lists(queries.QUERIES["op11_nearest_neighbours"](spark, SMALL)), brute(rows, 20)
    assert got.keys() == want.keys()
    assert sum(len({j for _, j in got[q]} & {j for _, j in want[q]}) for q in want) >= 0.9 * 20 * len(want)


# ------------------------------------------------------------------ manifest
def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def grown(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def manifest(rows):
    """Rows (doc_id, leaf, subroot, root, proof digest, folded root, verified) by the definition."""
    groups = defaultdict(list)
    for d, text, lang, source, n in rows:
        groups[source].append((d, leaf((d, source, lang, n, text)), leaf((d, source, lang, n, None if text is None else text.replace("\n", "")))))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: grown([x[1] for x in sorted(groups[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]) for s in order}
    top = grown([trees[s][-1][0] for s in order])

    def climb(levels, pos, node, proof):
        for level in levels[:-1]:
            run = range(pos - pos % 3, min(pos - pos % 3 + 3, len(level)))
            proof += [level[i] for i in run if i != pos]
            node = sha(*(node if i == pos else level[i] for i in run))
            pos //= 3
        return node

    out = []
    for seat, s in enumerate(order):
        for pos, (d, digest, copy) in enumerate(sorted(groups[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))):
            proof = []
            start = copy if d is not None and zlib.crc32(str(d).encode()) % 2 == 0 else digest
            node = climb(top, seat, climb(trees[s], pos, start, proof), proof)
            out.append((d, digest, trees[s][-1][0], top[-1][0], sha(*proof), node, node == top[-1][0]))
    return out


key = lambda row: tuple((x is None, x) for x in row)


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_of_odd_rows(spark, odd_docs, odd_rows, no_docs, levels):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted(map(tuple, merkle.tampered_check(odd_docs, levels).select(names).collect()), key=key)
    assert got == sorted(manifest(odd_rows), key=key)
    assert {r[-1] for r in got} == {True, False}
    assert merkle.tampered_check(no_docs).count() == 0
    one = odd_docs.where("doc_id = 15")
    assert [r["subroot"] == r["root"] == r["leaf"] and r["proof_sha256"] == sha() for r in merkle.tampered_check(one).collect()] == [True]


def test_proofs_hold_the_nodes(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b", sha(str(i))) for i in range(40)], "id long, g string, digest string")
    made = merkle.Manifest(df, F.col("g"), ["id"], ["id"])
    assert made.root.count() == 1 and made.group_roots.count() == 2
    for r in made.proofs().collect():
        node = r["digest"]
        for side in r["proof"]:
            node = sha(side["left"], node, side["right"])
        assert node == r["root"]


# ---------------------------------------------------------------------- trie
def turns_of(rows):
    """{conv: [(role, text)…]} rebuilt by the definition; equal turn numbers by role, then by token."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0), role, digest, text))
    own = {c: [(role, text) for _, role, _, text in sorted(t)] for c, t in own.items()}
    h = lambda c: zlib.crc32(str(c).encode()) % 4
    return {c: own.get(c - int(math.fmod(c, 20)), [])[: h(c)] + t[h(c) :] for c, t in own.items()}


def nodes_of(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out, kids = [], defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in kids[p]) or 1
        saved[p] = sum(saved[q] for q in kids[p]) + ((len(members[p]) - 1) * words(p[-1][1]) if p else 0)
        ends = ",".join(str(c) for c in sorted(members[p]) if len(convs[c]) == len(p))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids[p]), leaves[p], saved[p], sha(ends)))
    return out


def odd_turns():
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "hello there", "", None, "a b  c\n"])) for c in range(90) for t in range(rng.randint(1, 5))]
    rows += [(5000 + c, t, "user", f"common words {t}") for c in range(150) for t in range(3)]  # a very common conversation
    rows += [(5000 + c, 3, "user", f"own {c}") for c in range(0, 150, 7)]
    rows += [(700, t, "user", f"deep {t}") for t in range(300)] + [(701, None, "user", "first"), (701, 1, "b", "tie"), (701, 1, "a", "tie"), (701, 1, "a", "tie")]
    rows += [(None, 0, "user", "no id"), (702, 0, None, "x" * 100_000), (-3, 0, "user", "hi"), (-3, 1, "user", "hi")]
    return rows


@pytest.mark.parametrize("paths, tokens", [(20_000, 200_000), (3, 10**9), (10**9, 30)])
def test_trie_of_odd_conversations(spark, monkeypatch, paths, tokens):
    rows = odd_turns()
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    df = df.withColumns({c: F.lit("x") for c in ("path", "t", "at", "n", "low", "key", "_base", "depth")}).repartition(4)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    monkeypatch.setattr(trie, "ID_RANGE", 16)
    out = trie.prefix_nodes(trie.regrown(trie.conversation_paths(df)), paths, tokens, 2)
    assert sorted(map(tuple, out.select(names).collect()), key=key) == sorted(nodes_of(turns_of(rows)), key=key)
    assert trie.prefix_trie(df.where("false")).count() == 0


def test_search_trees_are_balanced():
    items = [([i.to_bytes(32, "big") + bytes(8)], {1: (1, i, 0, 0, 0, "")}) for i in range(1023)]
    shard = trie._Shard(items)
    deep = {shard.first[0]: 1}
    for v in range(1, len(shard.token)):
        for child in (shard.left[v], shard.right[v]):
            if child >= 0:
                deep[child] = deep[v] + 1
    assert len(deep) == 1023 and max(deep.values()) == 10
