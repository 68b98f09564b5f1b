"""Classifiers, tree models, networks, stored models and searches."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from graniteflow.functions.embedding import embed_batch, pool_layers
from graniteflow.operators import classify, cluster, convex, lloyd, metrics, neural, reduce, regress, split, stats, text_grid, tuning, vectorize
from graniteflow.plans.catalog import query
from graniteflow.plans.cluster_queries import points
from graniteflow.plans.regress_queries import KEYS, LINEAR, Z, scaled_prices
from graniteflow.plans.sqltools import sql_gram, sql_solve
from graniteflow.plans.text_queries import plural_lemmas
from graniteflow.plans.views import NET_PRICE, sql_unit, with_sql
from graniteflow.session import cut_lineage, scratch_path, spread
from graniteflow.sources.writers import load_model, save_model

# --------------------------------------------- documents as three numbers
DOC_X = ["size", "accents", "spaces"]


def doc_numbers(t):
    n = F.length("text")
    share = lambda pattern: F.try_divide(F.length(F.regexp_replace("text", pattern, "")), n)
    return spread(t.documents.select("doc_id", "lang", "text")).select(
        "doc_id", "lang", F.ln(n + 1).alias("size"), share("[^àâäçèéêëîïôöùûüßñáíóú]").alias("accents"), share("[^ ]").alias("spaces")
    )


DOCS = """docs AS (SELECT doc_id, lang, ln(length(text)+1) AS size,
  length(regexp_replace(text, '[^àâäçèéêëîïôöùûüßñáíóú]', '', 'g'))/length(text) AS accents,
  length(regexp_replace(text, '[^ ]', '', 'g'))/length(text) AS spaces FROM documents)"""


def _sql_nb():
    mom = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) + 1e-9*w AS v_{c}" for c in DOC_X)
    dens = " - ".join(["ln(n/total)"] + [f"0.5*(ln(2*pi()*v_{c}) + ({c}-m_{c})**2/v_{c})" for c in DOC_X])
    return with_sql(DOCS, f"wide AS (SELECT greatest({', '.join(f'var_pop({c})' for c in DOC_X)}) AS w, count(*) AS total FROM docs)",
                    f"cls AS (SELECT lang, count(*) AS n, any_value(total) AS total, {mom} FROM docs CROSS JOIN wide GROUP BY lang, w)", f"""
SELECT doc_id, arg_max(cls.lang, {dens}) AS prediction FROM docs CROSS JOIN cls GROUP BY doc_id""")


@query("gaussian_nb", _sql_nb())
def gaussian_nb(t):
    rows = doc_numbers(t)
    return classify.GaussianClasses.fit(rows, DOC_X, "lang").transform(rows).select("doc_id", "prediction")


@query("class_weights", """
SELECT doc_id, round((SELECT count(*) FROM documents)::DOUBLE/((SELECT count(DISTINCT lang) FROM documents)*count(*) OVER (PARTITION BY lang)), 6) AS weight
FROM documents""")
def class_weights(t):
    return classify.class_weights(t.documents.select("doc_id", "lang"), "lang").select("doc_id", F.round("weight", 6).alias("weight"))


def labelled_docs(t):
    """Scaled document numbers as a vector, with a binary and a four-class label."""
    rows = vectorize.standard_scale(doc_numbers(t), DOC_X)
    rows = regress.assembled(rows, DOC_X).withColumn("label", (F.col("lang") == "en").cast("double"))
    return StringIndexer(inputCol="lang", outputCol="lang_no", stringOrderType="alphabetAsc").fit(rows).transform(rows)


def _sql_logistic(rounds=10, c=1.0):
    z = "z AS (SELECT doc_id, (lang = 'en')::INT::DOUBLE AS y, " + ", ".join(
        f"({x} - avg({x}) OVER ())/stddev_pop({x}) OVER () AS {x}" for x in DOC_X) + " FROM docs)"
    parts = [DOCS, z, "b0 AS (SELECT 0.0::DOUBLE AS b_0, 0.0::DOUBLE AS b_1, 0.0::DOUBLE AS b_2, 0.0::DOUBLE AS b_3)"]
    terms = ["1.0", *DOC_X]
    for r in range(rounds):
        score = " + ".join(f"b_{i}*{x}" for i, x in enumerate(terms))
        parts.append(f"p{r} AS MATERIALIZED (SELECT z.*, b{r}.*, 1/(1+exp(-({score}))) AS p FROM z CROSS JOIN b{r})")
        cells = [f"sum(p*(1-p)*{terms[i]}*{terms[j]})" + (f" + {1 / c}" if i == j and i else "") + f" AS g_{i}_{j}"
                 for i in range(4) for j in range(i, 4)]
        cells += [f"sum((y-p)*{terms[i]})" + (f" - any_value(b_{i})*{1 / c}" if i else "") + f" AS g_{i}_4" for i in range(4)]
        keep = ", ".join(f"any_value(b_{i}) AS o_{i}" for i in range(4))
        parts.append(f"n{r} AS (SELECT {', '.join(cells)}, {keep} FROM p{r})")
        parts += sql_solve(f"s{r}", f"n{r}", 4)
        parts.append(f"b{r + 1} AS MATERIALIZED (SELECT " + ", ".join(f"o_{i} + b_{i} AS b_{i}" for i in range(4)) + f" FROM s{r})")
    names = ["const", *DOC_X]
    return with_sql(*parts, " UNION ALL ".join(f"SELECT '{n}' AS feature, round(b_{i}, 4) AS coef FROM b{rounds}" for i, n in enumerate(names)))


@query("logistic", _sql_logistic())
def logistic(t):
    model = classify.logistic(labelled_docs(t), "l2", 1.0, max_iter=500, tol=1e-10)
    rows = [("const", float(model.intercept))] + [(c, float(b)) for c, b in zip(DOC_X, model.coefficients)]
    return t.spark.createDataFrame(rows, "feature string, coef double").select("feature", F.round("coef", 4).alias("coef"))


@query("logistic_l1")
def logistic_l1(t):
    rows = cut_lineage(labelled_docs(t))
    found = []
    for c in (0.01, 1.0, 100.0):
        model = classify.logistic(rows, "l1", c, max_iter=500, tol=1e-10)
        found += [(c, n, float(b)) for n, b in zip(DOC_X, model.coefficients)]
    return t.spark.createDataFrame(found, "c double, feature string, coef double")


@query("linear_svm")
def linear_svm(t):
    train, test = split.split(cut_lineage(labelled_docs(t)), "doc_id", 0.2, seed=42)
    runs = [classify.linear_svm(train, c).transform(test).select(F.lit(c).alias("c"), "label", "prediction") for c in (0.01, 100.0)]
    return metrics.binary_metrics(stats.union_all(runs), "label", "prediction", 1.0, ["c"])


@query("one_vs_one")
def one_vs_one(t):
    rows = cut_lineage(classify.class_weights(labelled_docs(t).withColumn("label", F.col("lang_no")), "label"))
    train, test = split.split(rows, "doc_id", 0.2, seed=42)
    model = classify.one_vs_one(train, lambda part: classify.linear_svm(part, 1.0, weight="weight"))
    return model.transform(test).select("doc_id", "lang", "prediction")


@query("one_vs_rest")
def one_vs_rest(t):
    rows = cut_lineage(classify.class_weights(labelled_docs(t).withColumn("label", F.col("lang_no")), "label"))
    train, test = split.split(rows, "doc_id", 0.2, seed=42)
    model = classify.one_vs_rest(train, LogisticRegression(maxIter=500), weight="weight")
    return metrics.macro_metrics(model.transform(test), "label", "prediction")


@query("mlp_classifier")
def mlp_classifier(t):
    shares = {c: F.when(F.col("size") == 0, 0.0).otherwise(F.col(c)) for c in DOC_X[1:]}  # an empty text has none
    rows = vectorize.standard_scale(doc_numbers(t).withColumns(shares), DOC_X).withColumn("x", F.array(*DOC_X))
    index = StringIndexer(inputCol="lang", outputCol="label", stringOrderType="alphabetAsc").fit(rows)
    train, test = split.split(index.transform(rows), "doc_id", 0.2, seed=42)
    model = neural.mlp_classifier(train, "x", "label", 3, [16], max(4, len(index.labels)), rate=0.05, steps=30)
    scored = test.withColumn("prediction", model.predict_class("x").cast("double"))
    return metrics.macro_metrics(scored, "label", "prediction")


@query("mlp_regressor")
def mlp_regressor(t):
    rows = scaled_prices(t).withColumn("x", F.array(*LINEAR))
    model = neural.mlp_regressor(rows, "x", "price", 4, [20], rate=0.02, steps=25)
    return t.spark.createDataFrame([(i, float(v)) for i, v in enumerate(model.history)], "step int, loss double")


@query("autoencoder")
def autoencoder(t):
    rows = points(t)
    model, code = neural.autoencoder(rows, "vec", 64, [32], 4, rate=0.01, steps=20)
    return rows.select("id", F.posexplode(model.predict("vec", 0, code)).alias("j", "value"))


# ------------------------------------------------------------------ inference
def _standin_weights():
    return np.array([[((i * (j + 1)) % 7 - 3) / 7.0 for i in range(64)] for j in range(3)])


def _standin_model():
    w = _standin_weights().T
    return lambda batch: np.asarray(batch, dtype=float) @ w


@query("embed_batch", "SELECT vec_id, " + ", ".join(
    f"round(list_dot_product(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), {[float(v) for v in row]}::DOUBLE[]), 6) AS e{j}"
    for j, row in enumerate(_standin_weights())) + " FROM embeddings")
def embed_batch_query(t):
    rows = t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    out = rows.withColumn("e", embed_batch("x", _standin_model, 64))
    return out.select("vec_id", *[F.round(F.col("e")[j], 6).alias(f"e{j}") for j in range(3)])


def _sql_pool():
    cells = []
    for place, layer in enumerate((3, 2, 1, 0)):
        for j in range(4):
            token = "+".join(f"CAST(embedding[{layer * 16 + token * 4 + j + 1}] AS DOUBLE)" for token in range(4))
            cells.append(f"round(({token})/4, 6) AS p{place * 4 + j}")
    return f"SELECT vec_id, {', '.join(cells)} FROM embeddings"


@query("pool_layers", _sql_pool())
def pool_layers_query(t):
    cut = lambda layer, token: F.slice(F.col("embedding").cast("array<double>"), layer * 16 + token * 4 + 1, 4)
    states = F.array(*[F.array(*[cut(layer, token) for token in range(4)]) for layer in range(4)])
    out = t.embeddings.select("vec_id", pool_layers(states, 4).alias("p"))
    return out.select("vec_id", *[F.round(F.col("p")[j], 6).alias(f"p{j}") for j in range(16)])


# --------------------------------------------------------------- stored model
@query("stored_model", with_sql(NET_PRICE, Z, sql_gram("gram", "z", LINEAR, "price"), *sql_solve("sol", "gram", 5), """
SELECT l_orderkey, l_linenumber, l_partkey, round(b_0 + """ + " + ".join(f"b_{i + 1}*{c}" for i, c in enumerate(LINEAR)) + ", 6) AS prediction FROM z CROSS JOIN sol"))
def stored_model(t):
    rows = scaled_prices(t)
    path = save_model(regress.ols(rows, LINEAR, "price"), scratch_path(t.spark, "ols"))
    return load_model(path).transform(rows).select(*KEYS, F.round("prediction", 6).alias("prediction"))


# ---------------------------------------------------------------- tree models
def _tree_rows(t):
    rows = regress.assembled(scaled_prices(t), LINEAR)
    return rows.withColumn("key", F.concat_ws("-", *KEYS))


@query("random_forest")
def random_forest(t):
    train, test = split.split(_tree_rows(t), "key", 0.2, seed=42)
    model = regress.random_forest("features", "price", trees=10, per_split=3, depth=8).fit(train)
    return metrics.regression_metrics(model.transform(test), "price", "prediction")


@query("tree_report")
def tree_report(t):
    model = regress.random_forest("features", "price", trees=5, per_split=3, depth=4).fit(_tree_rows(t))
    return regress.tree_report(t.spark, model, LINEAR)


@query("gradient_boosting")
def gradient_boosting(t):
    train, test = split.split(_tree_rows(t), "key", 0.2, seed=42)
    model = regress.gbt("features", "price", "ordered", maxIter=8, maxDepth=4).fit(train)
    return metrics.regression_metrics(model.transform(test), "price", "prediction")


@query("oob_error")
def oob_error(t):
    preds = regress.oob_predictions(_tree_rows(t), "key", "features", "price", trees=150, per_split=3, depth=30)
    return regress.oob_error(preds, "price")


# ------------------------------------------------------------------- searches
@query("search_one_param")
def search_one_param(t):
    """Eleven penalties of a linear SVM on five folds, fitted together."""
    rows = cut_lineage(split.with_fold(labelled_docs(t), "doc_id", 5, seed=2))
    table = cut_lineage(convex.rows_of(rows, vector_to_array("features"), "label", fold="fold"))
    problems = [convex.Problem(f"C={c:g}", "squared_hinge", len(DOC_X), "l2", c, fold=f) for c in PENALTIES for f in range(5)]
    found = convex.scores(table, convex.fit(table, problems))
    return tuning.cv_results(found.select(F.col("name").alias("candidate"), "fold", F.col("train_f1").alias("train_score"), F.col("test_f1").alias("test_score")), ["candidate"])


#: Eleven penalties, from 1e-4 to 1e6.
PENALTIES = [10.0**e for e in range(-4, 7)]


@query("convex_residuals", with_sql("c AS (SELECT unnest(range(-4, 7)) AS power)", "f AS (SELECT unnest(range(5)) AS fold)",
    "m AS (SELECT unnest(['squared_hinge/l2', 'logistic/l2', 'logistic/l1']) AS model)",
    "SELECT model, CAST(power AS INTEGER) AS power, CAST(fold AS INTEGER) AS fold, true AS settled FROM m CROSS JOIN c CROSS JOIN f"))
def convex_residuals(t):
    """Whether the gradient of every fit, summed anew over the rows by plain expressions, is a millionth of that at zero."""
    rows = cut_lineage(split.with_fold(labelled_docs(t), "doc_id", 5, seed=2))
    table = cut_lineage(convex.rows_of(rows, vector_to_array("features"), "label", fold="fold"))
    kinds = [("squared_hinge", "l2"), ("logistic", "l2"), ("logistic", "l1")]
    problems = [
        convex.Problem(f"{loss}/{penalty} {e} {f}", loss, len(DOC_X), penalty, 10.0**e, fold=f)
        for loss, penalty in kinds for e in range(-4, 7) for f in range(5)
    ]
    fits = convex.fit(table, problems, tol=1e-7)
    y = 2 * F.col("label") - 1
    weights = [(f.problem.name, f.problem.loss, f.problem.penalty, f.problem.c, f.problem.fold, f.weights.tolist()) for f in fits]
    models = t.spark.createDataFrame(weights, "name string, loss string, penalty string, c double, held int, b array<double>")
    both = table.join(F.broadcast(models), F.col("fold") != F.col("held"))
    margin = y * (sum(F.col("vec")[j] * F.col("b")[j] for j in range(len(DOC_X))) + F.col("b")[len(DOC_X)])
    pull = lambda m: -y * F.when(F.col("loss") == "logistic", 1 / (1 + F.exp(m))).otherwise(2 * F.greatest(F.lit(0.0), 1 - m))
    cells = [F.col("vec")[j] for j in range(len(DOC_X))] + [F.lit(1.0)]
    sums = [F.sum(F.col("c") * pull(at) * x).alias(f"{n}{j}") for n, at in (("g", margin), ("z", F.lit(0.0))) for j, x in enumerate(cells)]
    found = both.groupBy("name", "penalty", "b").agg(*sums)
    gaps = [F.abs(F.col(f"g{len(DOC_X)}"))]
    for j in range(len(DOC_X)):
        g, b = F.col(f"g{j}"), F.col("b")[j]
        edge = F.when(b == 0, F.greatest(F.lit(0.0), F.abs(g) - 1)).otherwise(F.abs(g + F.signum(b)))
        gaps.append(F.when(F.col("penalty") == "l1", edge).otherwise(F.abs(g + b)))
    first = F.greatest(*[F.abs(F.col(f"z{j}")) for j in range(len(cells))])
    part = F.split("name", " ")
    return found.select(part[0].alias("model"), part[1].cast("int").alias("power"), part[2].cast("int").alias("fold"), (F.greatest(*gaps) <= 1e-6 * first).alias("settled"))


@query("pipeline_grid")
def pipeline_grid(t):
    """Cleaner × analyzer × minimum document frequency × reducer × classifier, 96 candidates on five folds."""
    rows = split.with_fold(t.documents.select("doc_id", "text", (F.col("lang") == "en").cast("double").alias("label")), "doc_id", 5, seed=2)
    found = text_grid.search(rows, "text", "label", "fold", 5, plural_lemmas(t), components=10)
    return tuning.cv_results(found.select("candidate", "fold", "train_score", "test_score"), ["candidate"])


@query("text_pipeline")
def text_pipeline(t):
    rows = t.documents.select("doc_id", "text", (F.col("lang") == "en").cast("double").alias("label"))
    train, test = split.split(rows, "doc_id", 0.2, seed=42)
    model = classify.text_pipeline(LogisticRegression(maxIter=30), clean=True, reducer="lsi", components=5, rounds=2).fit(train)
    return metrics.binary_metrics(model.transform(test), "label", "prediction", 1.0)


@query("random_search")
def random_search(t):
    rows = split.with_fold(scaled_prices(t), KEYS, 5, seed=8)
    grams = {k[0]: g for k, g in regress.gram_table(rows, LINEAR, "price", ["fold"]).items()}
    total = sum(grams.values())

    def score(params):
        scores = [-regress.mse_from_gram(g, regress.ridge_from_gram(total - g, params["alpha"])) for g in grams.values()]
        return float(np.mean(scores))

    drawn = tuning.draw(t.spark, {"alpha": tuning.log_uniform(1e-2, 1e5)}, 12, seed=3)
    found = tuning.random_search(score, drawn)
    return t.spark.createDataFrame([(i, r["params"]["alpha"], r["score"]) for i, r in enumerate(found)], "trial int, alpha double, score double")


@query("clustering_grid")
def clustering_grid(t):
    """Inputs × clusterings, all scored in one job: per input three k of k-means, a hierarchy, two radii and two density groups."""
    raw = cut_lineage(points(t).withColumn("features", array_to_vector("vec")))
    inputs = {"raw": raw.select("id", "vec", "features", "label")}
    wide = reduce.pca2(raw, k=32).transform(raw).select("id", vector_to_array("pca").alias("vec"), "label")
    wide = cut_lineage(wide)
    for k in GRID_COMPONENTS:
        part = wide.withColumn("vec", F.slice("vec", 1, k))
        inputs[f"pca{k}"] = part.withColumn("features", array_to_vector("vec"))
    runs = [run for one in tuning.in_threads([lambda n=n, r=r: _clusterings(n, r) for n, r in inputs.items()], 5) for run in one]
    return metrics.cluster_score_table(stats.union_all(runs), "truth", "pred", ["run_id"])


#: Leading principal components that serve as inputs beside the raw vectors.
GRID_COMPONENTS = (2, 4, 8, 12, 16, 20, 24, 28, 32)


def _clusterings(name, rows):
    """Eight labelled runs of one input; radii follow the mean distance of rows to the middle."""
    truth = rows.select("id", F.col("label").alias("truth"))
    named = lambda table, run, pred: cut_lineage(table.join(truth, "id").select(F.lit(f"{name}/{run}").alias("run_id"), "truth", pred.cast("bigint").alias("pred")))
    data = lloyd.dense_rows(rows, "id", "vec")
    found = lloyd.many_starts(data, [10, 20, 50])
    best = [lloyd.best(found, k) for k in (10, 20, 50)]
    assigned = lloyd.assign(data, best)
    runs = [named(assigned, f"kmeans{r.k}", F.col("clusters")[i]) for i, r in enumerate(best)]
    runs.append(named(cluster.hierarchical(rows, 20).transform(rows).select("id", "prediction"), "hierarchical", F.col("prediction")))
    middle = [r[0] for r in rows.select(F.posexplode("vec").alias("j", "x")).groupBy("j").agg(F.avg("x").alias("m")).orderBy("j").select("m").collect()]
    scale = rows.agg(F.avg(F.sqrt(cluster.squared_distance("vec", middle)))).first()[0]
    ready = cluster.prepare(rows.select("id", "vec"), "id", "vec")
    for share in (0.3, 0.6):
        runs.append(named(cluster.dbscan(rows, "id", "vec", share * scale, 5, ready), f"dbscan{share}", F.col("label")))
        runs.append(named(cluster.density_clusters(rows, "id", "vec", share * scale, 5, 10, ready), f"density{share}", F.col("label")))
    return runs
