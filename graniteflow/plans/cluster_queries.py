"""Matrix reductions, neighbour search and clustering."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from graniteflow.functions import text as tx
from graniteflow.functions.hashing import hash_int
from graniteflow.operators import cluster, lloyd, metrics, neighbours, reduce
from graniteflow.plans.catalog import query
from graniteflow.plans.text_queries import WEIGHTS
from graniteflow.plans.views import RUNS, cluster_runs, sql_hash, with_sql
from graniteflow.session import cut_lineage, spread


def weights(t):
    """TF-IDF rows per document with min. document frequency 3."""
    words = spread(t.documents.select("doc_id", "text")).select("doc_id", tx.tokens("text").alias("words"))
    return reduce.DocumentRows.tfidf(words, "doc_id", "words", min_df=3, legal=tx.is_legal)


def points(t):
    return t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), "label")


# ----------------------------------------------------------------- reductions
@query("lsi")
def lsi(t):
    x = weights(t)
    scores = reduce.lsi(x, 5).transform(x)
    return scores.select("doc_id", F.posexplode("vec").alias("component", "score"))


@query("lsi_explained_variance")
def lsi_explained_variance(t):
    x = weights(t)
    model = reduce.lsi(x, 5)
    return reduce.explained_variance(model.transform(x), 5, x.total_variance(t.documents.count()))


@query("lsi_residuals", "SELECT CAST(j AS INTEGER) AS component, true AS unit, true AS settled FROM range(5) r(j)")
def lsi_residuals(t):
    """Per component, from the long table: whether its vector has length one and XᵀXv equals σ²v to one part in a million."""
    x = weights(t)
    model = reduce.lsi(x, 5, rounds=20)
    entries = cut_lineage(x.entries())
    image = reduce.times_docs(entries, reduce.times_terms(entries, model.components, 5), 5).withColumnRenamed("vec", "image")
    cells = model.components.join(image, "term").select(F.posexplode(F.arrays_zip("vec", "image")).alias("component", "c"))
    square = F.element_at(F.array(*[F.lit(float(s * s)) for s in model.sigma]), F.col("component") + 1)
    gap = F.col("c.image") - square * F.col("c.vec")
    sums = cells.select("component", square.alias("square"), gap.alias("gap"), F.col("c.vec").alias("v")).groupBy("component", "square").agg(
        F.sum(F.col("v") * F.col("v")).alias("length"), F.sqrt(F.sum(F.col("gap") * F.col("gap"))).alias("gap")
    )
    return sums.select("component", (F.abs(F.col("length") - 1) < 1e-9).alias("unit"), (F.col("gap") < 1e-6 * F.col("square")).alias("settled"))


@query("explained_variance", with_sql("""
v AS (SELECT j-1 AS component, var_pop(CAST(embedding[j] AS DOUBLE)) AS v FROM embeddings CROSS JOIN (SELECT unnest(range(1, 65)) AS j) GROUP BY 1)""", """
SELECT CAST(component AS INTEGER) AS component, round(v/sum(v) OVER (), 6) AS ratio,
       round(sum(v) OVER (ORDER BY v DESC, component)/sum(v) OVER (), 6) AS cumulated FROM v"""))
def explained_variance(t):
    out = reduce.explained_variance(points(t), 64)
    return out.select("component", F.round("ratio", 6).alias("ratio"), F.round("cumulated", 6).alias("cumulated"))


def _sql_nmf():
    unit = lambda seed, key, j: f"(({sql_hash(seed, key, str(j))} + 1)/4294967296.0)"
    return [WEIGHTS, f"""
x AS MATERIALIZED (SELECT doc_id, term, w FROM weights),
w0 AS MATERIALIZED (SELECT doc_id, {unit(0, 'doc_id', 0)} AS a, {unit(0, 'doc_id', 1)} AS b FROM (SELECT DISTINCT doc_id FROM x)),
h0 AS MATERIALIZED (SELECT term, {unit(1, 'term', 0)} AS a, {unit(1, 'term', 1)} AS b FROM (SELECT DISTINCT term FROM x)),
gh AS (SELECT sum(a*a) AS aa, sum(a*b) AS ab, sum(b*b) AS bb FROM h0),
nw AS (SELECT doc_id, sum(w*a) AS a, sum(w*b) AS b FROM x JOIN h0 USING (term) GROUP BY 1),
w1 AS MATERIALIZED (SELECT doc_id, w0.a*nw.a/(w0.a*aa + w0.b*ab) AS a, w0.b*nw.b/(w0.a*ab + w0.b*bb) AS b
  FROM w0 JOIN nw USING (doc_id) CROSS JOIN gh),
gw AS (SELECT sum(a*a) AS aa, sum(a*b) AS ab, sum(b*b) AS bb FROM w1),
nh AS (SELECT term, sum(w*a) AS a, sum(w*b) AS b FROM x JOIN w1 USING (doc_id) GROUP BY 1),
h1 AS MATERIALIZED (SELECT term, h0.a*nh.a/(h0.a*aa + h0.b*ab) AS a, h0.b*nh.b/(h0.a*ab + h0.b*bb) AS b
  FROM h0 JOIN nh USING (term) CROSS JOIN gw)"""]


@query("nmf_step", with_sql(*_sql_nmf(), "SELECT term, round(a, 6) AS h0, round(b, 6) AS h1 FROM h1"))
def nmf_step(t):
    model = reduce.nmf(weights(t), 2, 1)
    return model.h.select("term", F.round(F.col("vec")[0], 6).alias("h0"), F.round(F.col("vec")[1], 6).alias("h1"))


@query("frobenius_error", with_sql(*_sql_nmf(), """
dense AS (SELECT w1.doc_id, h1.term, w1.a*h1.a + w1.b*h1.b AS p FROM w1 CROSS JOIN h1)""", """
SELECT round(sqrt(sum((coalesce(w, 0) - p)**2)), 4) AS error FROM dense LEFT JOIN x USING (doc_id, term)"""))
def frobenius_error(t):
    x = weights(t)
    model = reduce.nmf(x, 2, 1)
    error = reduce.frobenius_error(x, model.w, model.h, 2)
    return t.spark.createDataFrame([(error,)], "error double").select(F.round("error", 4).alias("error"))


@query("pca2")
def pca2(t):
    rows = points(t).withColumn("features", array_to_vector("vec"))
    model = reduce.pca2(rows)
    return model.transform(rows).select("id", vector_to_array("pca")[0].alias("x"), vector_to_array("pca")[1].alias("y"))


# ----------------------------------------------------------------- neighbours
SQL_DIST = """
p AS (SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
d AS MATERIALIZED (SELECT a.id AS a, b.id AS b, list_distance(a.v, b.v) AS w FROM p a CROSS JOIN p b)"""


@query("knn_graph", with_sql(SQL_DIST, """
SELECT a AS id, b AS neighbour, round(w, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(w, 9), b) AS rank FROM d WHERE a <> b) WHERE rank <= 5"""))
def knn_graph(t):
    out = neighbours.knn_graph(points(t), "id", "vec", 5)
    return out.select("id", "neighbour", F.round("distance", 6).alias("distance"), "rank")


@query("knn_graph_cosine", """
WITH p AS (SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
d AS (SELECT a.id AS a, b.id AS b, 1 - list_cosine_similarity(a.v, b.v) AS w FROM p a CROSS JOIN p b WHERE a.id <> b.id)
SELECT a AS id, b AS neighbour, round(w, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(w, 9), b) AS rank FROM d) WHERE rank <= 5""")
def knn_graph_cosine(t):
    out = neighbours.knn_graph(points(t), "id", "vec", 5, metric="cosine")
    return out.select("id", "neighbour", F.round("distance", 6).alias("distance"), "rank")


@query("eps_join", with_sql(SQL_DIST, "SELECT a AS pid, b AS peer, round(w, 6) AS distance FROM d WHERE a < b AND w <= 1.1"))
def eps_join(t):
    out = neighbours.eps_pairs(points(t), "id", "vec", 1.1)
    return out.select("pid", "peer", F.round("distance", 6).alias("distance"))


EPS, MIN_PTS = 1.15, 5
SQL_REACH = """
core AS MATERIALIZED (SELECT a AS id FROM d WHERE w <= {eps} GROUP BY 1 HAVING count(*) >= {n}),
link AS MATERIALIZED (SELECT a, b FROM d WHERE w <= {eps} AND a IN (FROM core) AND b IN (FROM core)),
walk AS (SELECT id, id AS label FROM core UNION SELECT link.b, walk.label FROM walk JOIN link ON link.a = walk.id WHERE walk.label < link.b),
comp AS (SELECT id, min(label) AS label FROM walk GROUP BY 1)"""


@query("dbscan", with_sql(SQL_DIST, SQL_REACH.format(eps=EPS, n=MIN_PTS), f"""
reach AS (SELECT d.a AS id, min(label) AS label FROM d JOIN comp ON d.b = comp.id WHERE w <= {EPS} GROUP BY 1)""", """
SELECT p.id, coalesce(reach.label, -1) AS label, p.id IN (FROM core) AS is_core FROM p LEFT JOIN reach USING (id)"""))
def dbscan(t):
    return cluster.dbscan(points(t), "id", "vec", EPS, MIN_PTS)


@query("density_clusters", with_sql(SQL_DIST, SQL_REACH.format(eps=1.2, n=7), """
sized AS (SELECT *, count(*) OVER (PARTITION BY label) AS n FROM comp)""", """
SELECT p.id, CASE WHEN n >= 10 THEN label ELSE -1 END AS label FROM p LEFT JOIN sized USING (id)"""))
def density_clusters(t):
    return cluster.density_clusters(points(t), "id", "vec", 1.2, 6, 10)


@query("single_linkage", with_sql(SQL_DIST, """
r AS MATERIALIZED (SELECT a, b, round(w, 9) AS w FROM d WHERE a <> b),
prim AS (
  SELECT 0 AS step, id, (SELECT min(id) FROM p) AS via, CASE WHEN id = (SELECT min(id) FROM p) THEN NULL ELSE r.w END AS w
  FROM p LEFT JOIN r ON r.a = (SELECT min(id) FROM p) AND r.b = p.id
  UNION ALL
  SELECT step + 1, q.id, CASE WHEN r.w < q.w THEN q.pick ELSE q.via END, CASE WHEN q.id = q.pick THEN NULL ELSE least(q.w, r.w) END
  FROM (SELECT *, arg_min(id, w) OVER () AS pick FROM prim WHERE w IS NOT NULL) q LEFT JOIN r ON r.a = q.pick AND r.b = q.id),
picked AS (SELECT step, arg_min(id, w) AS id FROM prim WHERE w IS NOT NULL GROUP BY 1),
tree AS MATERIALIZED (SELECT least(prim.id, via) AS a, greatest(prim.id, via) AS b, w FROM prim JOIN picked USING (step, id)),
kept AS MATERIALIZED (SELECT a, b FROM (SELECT *, row_number() OVER (ORDER BY w DESC, a DESC, b DESC) AS k FROM tree) WHERE k > 9),
link AS (SELECT a, b FROM kept UNION ALL SELECT b, a FROM kept),
walk AS (SELECT id, id AS label FROM p UNION SELECT link.b, walk.label FROM walk JOIN link ON link.a = walk.id WHERE walk.label < link.b)""", """
SELECT id, min(label) AS label FROM walk GROUP BY 1"""))
def single_linkage(t):
    return cluster.single_linkage(points(t), "id", "vec", 10)


# -------------------------------------------------------------------- k-means
def start_centres(t, k=5):
    rows = points(t).orderBy(hash_int("id", seed=21), "id").limit(k).collect()
    return [r["vec"] for r in rows]


SQL_START = f"""
pts AS (SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY {sql_hash(21, 'id')}, id) - 1 AS INTEGER) AS c, v FROM pts
       ORDER BY {sql_hash(21, 'id')}, id LIMIT 5)"""


def _sql_assign(n):
    return f"""
a{n} AS MATERIALIZED (SELECT id, v, c, d FROM (
  SELECT pts.id, pts.v, c{n}.c, list_distance(pts.v, c{n}.v) AS d,
         row_number() OVER (PARTITION BY pts.id ORDER BY list_distance(pts.v, c{n}.v), c{n}.c) AS k FROM pts CROSS JOIN c{n}) WHERE k = 1),
m{n} AS (SELECT c, j, avg(v[j]) AS m FROM a{n} CROSS JOIN (SELECT unnest(range(1, 65)) AS j) GROUP BY ALL),
c{n + 1} AS MATERIALIZED (SELECT c, list(m ORDER BY j) AS v FROM m{n} GROUP BY 1)"""


@query("kmeans_steps", with_sql(SQL_START, _sql_assign(0), _sql_assign(1), _sql_assign(2), """
SELECT id, c AS cluster, round(d*d, 6) AS d2 FROM a2"""))
def kmeans_steps(t):
    centres, _ = cluster.lloyd_steps(points(t), start_centres(t), "vec", 2)
    return cluster.kmeans_assign(points(t), centres, "vec").select("id", "cluster", F.round("d2", 6).alias("d2"))


@query("kmeans_assign", with_sql(SQL_START, _sql_assign(0), "SELECT c AS cluster, count(*) AS n, round(sum(d*d), 6) AS cost FROM a0 GROUP BY 1"))
def kmeans_assign(t):
    rows = cluster.kmeans_assign(points(t), start_centres(t), "vec")
    return rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("d2"), 6).alias("cost"))


@query("kmeans")
def kmeans(t):
    data = lloyd.dense_rows(points(t), "id", "vec")
    run = lloyd.best(lloyd.many_starts(data, [5]), 5)
    return lloyd.assign(data, [run]).select("id", F.col("clusters")[0].alias("cluster"))


@query("kmeans_descent", "SELECT CAST(k AS INTEGER) AS k, CAST(s AS INTEGER) AS start, true AS falls, true AS settled, true AS fixed FROM (SELECT unnest([5, 10]) AS k) CROSS JOIN range(35) r(s)")
def kmeans_descent(t):
    """Per start: whether its cost never rose, it settled, and the cost computed anew from plain distances to the means of its clusters is its last."""
    rows = points(t)
    data = lloyd.dense_rows(rows, "id", "vec")
    runs = lloyd.many_starts(data, [5, 10])
    costs = lloyd.cluster_costs(lloyd.assign(data, runs).join(rows.select("id", "vec"), "id"), [r.k for r in runs])
    falls = lambda r: all(b <= a * (1 + 1e-12) for a, b in zip(r.costs, r.costs[1:], strict=False))
    about = t.spark.createDataFrame([(i, r.k, r.start, falls(r), r.settled, r.costs[-1]) for i, r in enumerate(runs)], "run int, k int, start int, falls boolean, settled boolean, last double")
    return about.join(costs, "run").select("k", "start", "falls", "settled", (F.abs(F.col("cost") - F.col("last")) < 1e-6 * F.col("last")).alias("fixed"))


@query("kmeans_tfidf")
def kmeans_tfidf(t):
    data = weights(t)
    run = lloyd.best(lloyd.many_starts(data, [4]), 4)
    found = lloyd.assign(data, [run]).join(t.documents.select("doc_id", "lang"), "doc_id")
    return metrics.cluster_score_table(found.select("lang", F.col("clusters")[0].cast("bigint").alias("pred")), "lang", "pred")


@query("hierarchical")
def hierarchical(t):
    rows = points(t).withColumn("features", array_to_vector("vec"))
    return cluster.hierarchical(rows, 8).transform(rows).select("id", F.col("prediction").alias("cluster"))


@query("majority_map", with_sql(RUNS, """
SELECT run_id, pred, truth, n FROM (SELECT run_id, pred, truth, count(*) AS n,
  row_number() OVER (PARTITION BY run_id, pred ORDER BY count(*) DESC, truth) AS k FROM runs GROUP BY run_id, pred, truth) WHERE k = 1"""))
def majority_map(t):
    return cluster.majority_map(cluster_runs(t), "pred", "truth", ["run_id"])


@query("align_labels")
def align_labels(t):
    return cluster.align_labels(cluster_runs(t), "pred", "truth", ["run_id"])
