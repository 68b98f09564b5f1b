"""Recommender queries on the two rating views."""

from __future__ import annotations

from pyspark.sql import functions as F

from graniteflow.operators import recommend, split, stats
from graniteflow.operators.metrics import auc
from graniteflow.plans.catalog import query
from graniteflow.plans import views
from graniteflow.plans.views import FOLDED, PART_RATINGS, RATINGS, with_sql
from graniteflow.session import cut_lineage, stored


def _r6(df, keep, cols):
    return df.select(*keep, *[F.round(c, 6).alias(c) for c in cols])


def ratings(t):
    """The rating view, worked out once: the operators below read it several times."""
    return cut_lineage(views.ratings(t))


def part_ratings(t):
    return cut_lineage(views.part_ratings(t))


def folded(rows):
    return split.with_fold(rows, ["user", "item"], 10, seed=7)


SIMS = """
mom AS (SELECT {keys} a."user" AS u, b."user" AS v, count(*) AS n, sum(a.rating) AS sx, sum(b.rating) AS sy,
        sum(a.rating*a.rating) AS sxx, sum(b.rating*b.rating) AS syy, sum(a.rating*b.rating) AS sxy
        FROM train a JOIN train b ON a.item = b.item AND a."user" <> b."user" {on} GROUP BY ALL),
sims AS (SELECT {out} u, v, n, CASE WHEN n*sxx-sx*sx <= 1e-9 OR n*syy-sy*sy <= 1e-9 THEN 0.0
         ELSE round((n*sxy-sx*sy)/sqrt((n*sxx-sx*sx)*(n*syy-sy*sy)), 9) END AS sim FROM mom)"""
SIMS_ONE = SIMS.format(keys="", on="", out="")
SIMS_FOLD = SIMS.format(keys="a.fold,", on="AND a.fold = b.fold", out="fold,")


@query("pearson_similarity", with_sql(RATINGS, "train AS (SELECT * FROM ratings)", SIMS_ONE, """
SELECT u AS "user", v AS peer, n, sim, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY u ORDER BY sim DESC, v) AS rank FROM sims) WHERE rank <= 20"""))
def pearson_similarity(t):
    out = recommend.pearson_similarity(ratings(t), 20)
    return out.select("user", "peer", "n", "sim", "rank")


KNN = """
near AS (SELECT t.*, s.v, s.sim, r.rating - m.mean AS dev,
         row_number() OVER (PARTITION BY {tkeys} t."user", t.item ORDER BY s.sim DESC, s.v) AS rank
  FROM test t JOIN train r ON r.item = t.item {on_r} JOIN sims s ON s.u = t."user" AND s.v = r."user" AND s.sim > 0 {on_s}
  JOIN means m ON m."user" = r."user" {on_m}),
ests AS (SELECT {tkeys} t."user", t.item, t.rating, kk.k,
    CASE WHEN um.mean IS NULL OR NOT EXISTS (SELECT 1 FROM train x WHERE x.item = t.item {on_x})
         THEN (SELECT avg(rating) FROM train y {where_y})
         ELSE um.mean + coalesce(nn.num/nn.den, 0) END AS est
  FROM test t CROSS JOIN ks kk LEFT JOIN means um ON um."user" = t."user" {on_um}
  LEFT JOIN (SELECT {keys} "user", item, k, sum(sim*dev) AS num, sum(sim) AS den FROM near CROSS JOIN ks WHERE rank <= k GROUP BY ALL) nn
    ON nn."user" = t."user" AND nn.item = t.item AND nn.k = kk.k {on_nn}),
preds AS (SELECT * REPLACE (greatest(0.5, least(5.0, est)) AS est) FROM ests)"""
KNN_ONE = KNN.format(keys="", tkeys="", on_r="", on_s="", on_m="", on_x="", where_y="", on_um="", on_nn="")
KNN_FOLD = KNN.format(
    keys="fold,", tkeys="t.fold,", on_r="AND r.fold = t.fold", on_s="AND s.fold = t.fold", on_m="AND m.fold = t.fold",
    on_x="AND x.fold = t.fold", where_y="WHERE y.fold = t.fold", on_um="AND um.fold = t.fold", on_nn="AND nn.fold = t.fold",
).replace('t.*,', 't.fold, t."user", t.item, t.rating,')
ONE_SPLIT = """train AS (SELECT "user", item, rating FROM folded WHERE fold <> 0),
test AS (SELECT "user", item, rating FROM folded WHERE fold = 0),
means AS (SELECT "user", avg(rating) AS mean FROM train GROUP BY 1)"""
ALL_FOLDS = """train AS (SELECT f.f AS fold, "user", item, rating FROM folded JOIN (SELECT CAST(unnest(range(10)) AS INTEGER) AS f) f ON f.f <> fold),
test AS (SELECT fold, "user", item, rating FROM folded),
means AS (SELECT fold, "user", avg(rating) AS mean FROM train GROUP BY ALL)"""


def _ks(ks):
    return f"ks AS (SELECT CAST(unnest({list(ks)}) AS INTEGER) AS k)"


def _one_split(rows):
    rows = folded(rows)
    pick = lambda c: rows.where(c).select("user", "item", "rating")
    return pick("fold <> 0"), pick("fold = 0")


@query("knn_predict", with_sql(RATINGS, FOLDED, ONE_SPLIT, SIMS_ONE, _ks([20]), KNN_ONE,
                               'SELECT "user", item, rating, k, round(est, 6) AS est FROM preds'))
def knn_predict(t):
    train, test = _one_split(ratings(t))
    return recommend.knn_predict(train, test, 20).select("user", "item", F.col("rating"), "k", F.round("est", 6).alias("est"))


SWEEP = list(range(2, 101, 2))


def knn_fold_predictions(rows, ks):
    return recommend.knn_folds(folded(rows).withColumn("train", F.lit(True)), ks)


SQL_SWEEP = with_sql(RATINGS, FOLDED, ALL_FOLDS, SIMS_FOLD, _ks(SWEEP), KNN_FOLD, "{body}")


@query("knn_sweep", SQL_SWEEP.replace("{body}", """
SELECT k, round(avg(rmse), 6) AS rmse, round(avg(mae), 6) AS mae FROM (
  SELECT k, fold, sqrt(avg((rating-est)**2)) AS rmse, avg(abs(rating-est)) AS mae FROM preds GROUP BY ALL) GROUP BY 1"""))
def knn_sweep(t):
    preds = knn_fold_predictions(ratings(t), SWEEP)
    gap = F.col("rating") - F.col("est")
    per_fold = preds.groupBy("k", "fold").agg(F.sqrt(F.avg(gap * gap)).alias("rmse"), F.avg(F.abs(gap)).alias("mae"))
    return per_fold.groupBy("k").agg(F.round(F.avg("rmse"), 6).alias("rmse"), F.round(F.avg("mae"), 6).alias("mae"))


SUBSETS = """
item_stats AS (SELECT item, count(*) AS n, var_pop(rating) AS v FROM ratings GROUP BY 1),
subsets AS (SELECT item, 'popular' AS subset FROM item_stats WHERE n > {above}
  UNION ALL SELECT item, 'unpopular' FROM item_stats WHERE n <= {above}
  UNION ALL SELECT item, 'high_variance' FROM item_stats WHERE n >= {count} AND round(v, 9) >= {var})"""


@query("knn_subset_rmse", SQL_SWEEP.replace("{body}", ", " + SUBSETS.format(above=73, count=60, var=2.3) + """
SELECT k, fold, subset, count(*) AS n, round(sqrt(avg((rating-est)**2)), 6) AS rmse FROM preds JOIN subsets USING (item) GROUP BY ALL""").replace(
    "preds AS (SELECT * REPLACE (greatest(0.5, least(5.0, est)) AS est) FROM ests)\n,", "preds AS (SELECT * REPLACE (greatest(0.5, least(5.0, est)) AS est) FROM ests),"))
def knn_subset_rmse(t):
    rows = ratings(t)
    subsets = recommend.subset_items(rows, 73, 60, 2.3)
    return _r6(recommend.subset_rmse(knn_fold_predictions(rows, SWEEP), subsets, ["k", "fold"]), ["k", "fold", "subset", "n"], ["rmse"])


@query("item_subsets", with_sql(PART_RATINGS, SUBSETS.format(above=30, count=25, var=2.2), "SELECT item, subset FROM subsets"))
def item_subsets(t):
    return recommend.subset_items(part_ratings(t), 30, 25, 2.2)


@query("subset_test_rows", with_sql(PART_RATINGS, FOLDED, SUBSETS.format(above=30, count=25, var=2.2), """
SELECT subset, fold, count(*) AS n FROM folded JOIN subsets USING (item) GROUP BY ALL"""))
def subset_test_rows(t):
    found = part_ratings(t)
    rows, subsets = folded(found), recommend.subset_items(found, 30, 25, 2.2)
    parts = [
        recommend.subset_filter(rows, subsets, s).withColumn("subset", F.lit(s))
        for s in ("popular", "unpopular", "high_variance")
    ]
    return stats.union_all(parts).groupBy("subset", "fold").agg(F.count(F.lit(1)).alias("n"))


def _naive(train_only):
    source = "WHERE fold <> 0" if train_only else ""
    return with_sql(PART_RATINGS, FOLDED, f"""means AS (SELECT "user", avg(rating) AS est FROM folded {source} GROUP BY 1)""", f"""
SELECT "user", item, rating, round(coalesce(est, (SELECT avg(rating) FROM folded {source})), 6) AS est
FROM folded LEFT JOIN means USING ("user") WHERE fold = 0""")


def _naive_plan(t, train_only):
    out = recommend.user_mean_filter(folded(part_ratings(t)), F.col("fold") == 0, train_only)
    return out.select("user", "item", "rating", F.round("est", 6).alias("est"))


@query("user_mean_filter", _naive(True))
def user_mean_filter(t):
    return _naive_plan(t, True)


@query("user_mean_filter_all_rows", _naive(False))
def user_mean_filter_all_rows(t):
    return _naive_plan(t, False)


@query("naive_subset_rmse", with_sql(PART_RATINGS, FOLDED, SUBSETS.format(above=30, count=25, var=2.2),
       """means AS (SELECT "user", avg(rating) AS est FROM ratings GROUP BY 1)""", """
SELECT fold, subset, count(*) AS n, round(sqrt(avg((rating-est)**2)), 6) AS rmse
FROM folded JOIN means USING ("user") JOIN subsets USING (item) GROUP BY ALL"""))
def naive_subset_rmse(t):
    found = part_ratings(t)
    rows = folded(found)
    preds = rows.join(stats.user_mean(rows).withColumnRenamed("mean_rating", "est"), "user")
    subsets = recommend.subset_items(found, 30, 25, 2.2)
    return _r6(recommend.subset_rmse(preds, subsets, ["fold"]), ["fold", "subset", "n"], ["rmse"])


@query("filter_users", with_sql(PART_RATINGS, FOLDED, """
good AS (SELECT "user" FROM folded WHERE fold = 0 GROUP BY 1 HAVING count(*) >= 4 AND count(*) FILTER (rating >= 3) > 0)""", """
SELECT "user", item, round(rating, 6) AS rating FROM folded JOIN good USING ("user") WHERE fold = 0"""))
def filter_users(t):
    test = folded(part_ratings(t)).where("fold = 0").drop("fold")
    return _r6(recommend.filter_users(test, 4, 3.0), ["user", "item"], ["rating"])


@query("precision_recall_at_t", with_sql(PART_RATINGS, FOLDED, """
est AS (SELECT item, round(avg(rating), 6) AS est FROM ratings GROUP BY 1),
ranked AS (SELECT fold, "user", rating, count(*) OVER (PARTITION BY fold, "user") AS n_rated,
             sum((rating >= 3)::INT) OVER (PARTITION BY fold, "user") AS n_liked,
             row_number() OVER (PARTITION BY fold, "user" ORDER BY est DESC, item) AS rank
           FROM folded JOIN est USING (item)),
per AS (SELECT fold, t, "user", CAST(sum((rating >= 3 AND rank <= t)::INT) AS DOUBLE) AS hits, any_value(n_liked) AS n_liked
        FROM ranked JOIN (SELECT unnest(range(1, 26)) AS t) ON n_rated >= t AND n_liked > 0 GROUP BY ALL)""", """
SELECT fold, CAST(t AS INTEGER) AS t, count(*) AS n_users, round(avg(hits/t), 6) AS precision, round(avg(hits/n_liked), 6) AS recall
FROM per GROUP BY ALL"""))
def precision_recall_at_t(t):
    rows = part_ratings(t)
    est = rows.groupBy("item").agg(F.round(F.avg("rating"), 6).alias("est"))
    out = recommend.precision_recall_at_t(folded(rows).join(est, "item"), 25, 3.0, ["fold"])
    return _r6(out, ["fold", "t", "n_users"], ["precision", "recall"])


THRESHOLDS = [2.5, 3.0, 3.5, 4.0]


@query("knn_threshold_auc", with_sql(RATINGS, FOLDED, ONE_SPLIT, SIMS_ONE, _ks([20]), KNN_ONE + """,
long AS (SELECT th.threshold, CASE WHEN rating >= th.threshold THEN 1.0 ELSE 0.0 END AS y, round(est, 6) AS s
         FROM preds CROSS JOIN (SELECT CAST(unnest([2.5, 3.0, 3.5, 4.0]) AS DOUBLE) AS threshold) th)""", """
SELECT a.threshold, round(CAST(sum(a.y*(1-b.y)*CASE WHEN a.s > b.s THEN 1.0 WHEN a.s = b.s THEN 0.5 ELSE 0 END)/sum(a.y*(1-b.y)) AS DOUBLE), 6) AS auc
FROM long a JOIN long b ON a.threshold = b.threshold GROUP BY 1"""))
def knn_threshold_auc(t):
    from graniteflow.functions.columns import binarise_all

    train, test = _one_split(ratings(t))
    preds = recommend.knn_predict(train, test, 20).withColumn("s", F.round("est", 6))
    return _r6(auc(binarise_all(preds, "rating", THRESHOLDS), "s", "positive", ["threshold"]), ["threshold"], ["auc"])


def _sql_bias():
    step_i = """i{r} AS (SELECT item, sum(rating - mu - bu)/(10.0 + count(*)) AS bi FROM folded JOIN mean ON true JOIN u{p} USING ("user") GROUP BY 1),
u{r} AS (SELECT "user", sum(rating - mu - bi)/(15.0 + count(*)) AS bu FROM folded JOIN mean ON true JOIN i{r} USING (item) GROUP BY 1)"""
    return with_sql(PART_RATINGS, FOLDED, "mean AS (SELECT avg(rating) AS mu FROM ratings)",
                    'u0 AS (SELECT DISTINCT "user", 0.0::DOUBLE AS bu FROM ratings)',
                    step_i.format(r=1, p=0), step_i.format(r=2, p=1), """
SELECT 'item' AS side, item AS id, round(bi, 6) AS bias FROM i2 UNION ALL SELECT 'user', "user", round(bu, 6) FROM u2""")


@query("bias_tables", _sql_bias())
def bias_tables(t):
    _, items, users = recommend.bias_tables(stored(part_ratings(t), "ratings"))
    side = lambda d, name, key, b: d.select(F.lit(name).alias("side"), F.col(key).alias("id"), F.round(b, 6).alias("bias"))
    return side(items, "item", "item", "bi").unionByName(side(users, "user", "user", "bu"))


@query("nmf_recommender")
def nmf_recommender(t):
    train, test = _one_split(part_ratings(t))
    model = recommend.nmf_recommender(train, 8, iterations=5)
    return recommend.nmf_predict(model, train, test).agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg((F.col("rating") - F.col("est")) ** 2)).alias("rmse")
    )


@query("biased_mf")
def biased_mf(t):
    train, test = _one_split(stored(part_ratings(t), "ratings"))
    return recommend.biased_mf(train, test, 4, iterations=5).agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg((F.col("rating") - F.col("est")) ** 2)).alias("rmse")
    )


@query("factor_genres")
def factor_genres(t):
    model = recommend.nmf_recommender(part_ratings(t), 4, iterations=3)
    genres = F.concat_ws("|", "p_type", F.replace("p_name", F.lit(" "), F.lit("|")))
    items = t.part.select(F.col("p_partkey").alias("item"), genres.alias("genres"))
    return recommend.top_factor_items(model.itemFactors, items, 10)
