"""Classifier, ranking, regression and clustering scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from graniteflow.functions import columns as cx
from graniteflow.operators import metrics, stats
from graniteflow.plans.catalog import query
from graniteflow.plans.views import RUNS, SCORED, YEARLY, cluster_runs, scored_docs, with_sql, yearly


def _r6(df, keep, cols):
    return df.select(*keep, *[F.round(c, 6).alias(c) for c in cols])


@query("binary_metrics", with_sql(SCORED, """
c AS (SELECT count(*) AS n, sum((y=pred)::INT) AS hit, sum((y=1 AND pred=1)::INT)*1.0 AS tp, sum((pred=1)::INT) AS pp,
             sum((y=1)::INT) AS ap FROM scored)""", """
SELECT round(CAST(hit AS DOUBLE)/n, 6) AS accuracy, round(CAST(tp AS DOUBLE)/pp, 6) AS precision,
       round(CAST(tp AS DOUBLE)/ap, 6) AS recall, round(2*CAST(tp AS DOUBLE)/(pp+ap), 6) AS f1 FROM c"""))
def binary_metrics(t):
    return _r6(metrics.binary_metrics(scored_docs(t), "y", "pred", 1.0), [], ["accuracy", "precision", "recall", "f1"])


MACRO = """
labels_of AS (SELECT DISTINCT lang AS label FROM {src} UNION SELECT DISTINCT guess FROM {src}),
per AS (SELECT label, sum((lang=label AND guess=label)::INT) AS tp, sum((lang=label)::INT) AS ap, sum((guess=label)::INT) AS pp
        FROM {src} CROSS JOIN labels_of GROUP BY 1)"""
GUESS = """guessed AS (SELECT doc_id, lang,
  CASE WHEN regexp_matches(text, '[äöüß]') THEN 'de' WHEN regexp_matches(text, '[èêàçî]') THEN 'fr'
       WHEN regexp_matches(text, '[ñáíóú¿¡]') THEN 'es' ELSE 'en' END AS guess FROM documents)"""


def guessed_language(t):
    guess = (
        F.when(F.rlike("text", F.lit("[äöüß]")), "de").when(F.rlike("text", F.lit("[èêàçî]")), "fr")
        .when(F.rlike("text", F.lit("[ñáíóú¿¡]")), "es").otherwise("en")
    )
    return t.documents.select("doc_id", "lang", guess.alias("guess"))


@query("macro_metrics", with_sql(GUESS, MACRO.format(src="guessed"), """
SELECT round(sum(tp)*1.0::DOUBLE/sum(ap), 6) AS accuracy,
       round(avg(coalesce(tp::DOUBLE/nullif(pp,0), 0)), 6) AS precision,
       round(avg(coalesce(tp::DOUBLE/nullif(ap,0), 0)), 6) AS recall,
       round(avg(coalesce(2*tp::DOUBLE/nullif(ap+pp,0), 0)), 6) AS f1 FROM per"""))
def macro_metrics(t):
    return _r6(metrics.macro_metrics(guessed_language(t), "lang", "guess"), [], ["accuracy", "precision", "recall", "f1"])


@query("confusion", with_sql(GUESS, """grid AS (SELECT a.l AS lang, b.l AS guess FROM (SELECT unnest(['en','fr','de','es','it']) AS l) a
  CROSS JOIN (SELECT unnest(['en','fr','de','es','it']) AS l) b)""", """
SELECT grid.lang, grid.guess, count(doc_id) AS n FROM grid LEFT JOIN guessed USING (lang, guess) GROUP BY ALL"""))
def confusion(t):
    return stats.filled_contingency(guessed_language(t), "lang", "guess", ["en", "fr", "de", "es", "it"])


ROC = """
SELECT score AS threshold, round(sum(q) OVER w / sum(q) OVER (), 6) AS fpr, round(sum(p) OVER w / sum(p) OVER (), 6) AS tpr
FROM (SELECT score, sum(y) AS p, sum(1-y) AS q FROM scored GROUP BY 1)
WINDOW w AS (ORDER BY score DESC)"""


@query("roc_curve", with_sql(SCORED, ROC))
def roc_curve(t):
    return _r6(metrics.roc_curve(scored_docs(t), "score", "y"), ["threshold"], ["fpr", "tpr"])


SQL_AUC = """(sum((a.y*(1-b.y))*CASE WHEN a.{s} > b.{s} THEN 1.0 WHEN a.{s} = b.{s} THEN 0.5 ELSE 0 END)
  / sum(a.y*(1-b.y)))"""


@query("auc", with_sql(SCORED, f"SELECT round(CAST({SQL_AUC.format(s='score')} AS DOUBLE), 6) AS auc FROM scored a CROSS JOIN scored b"))
def auc(t):
    return metrics.auc(scored_docs(t), "score", "y").select(F.round("auc", 6).alias("auc"))


BINS = [64.0, 256.0, 1024.0, 4096.0]


@query("binarise_thresholds", " UNION ALL ".join(
    f"SELECT CAST({b} AS DOUBLE) AS threshold, CAST(sum(CASE WHEN n_chars >= {b} THEN 1 ELSE 0 END) AS DOUBLE) AS positives, count(*) AS n FROM documents"
    for b in BINS))
def binarise_thresholds(t):
    rows = cx.binarise_all(t.documents.select("doc_id", F.col("n_chars").cast("double").alias("x")), "x", BINS)
    return rows.groupBy("threshold").agg(F.sum("positive").alias("positives"), F.count(F.lit(1)).alias("n"))


COMPARE = SCORED + """,
long AS (SELECT 'coarse' AS model, score AS s, y, noise FROM scored UNION ALL SELECT 'fine', noise, y, noise FROM scored
         UNION ALL SELECT 'toxic', CAST(toxic AS DOUBLE), y, noise FROM scored)"""


@query("roc_compare", with_sql(COMPARE, f"""
SELECT a.model, round(CAST({SQL_AUC.format(s='s')} AS DOUBLE), 6) AS auc FROM long a JOIN long b ON a.model = b.model GROUP BY 1"""))
def roc_compare(t):
    cells = F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("s"))
        for m, c in (("coarse", "score"), ("fine", "noise"), ("toxic", "toxic"))
    ])
    long = scored_docs(t).select("y", F.inline(cells))
    return _r6(metrics.auc(long, "s", "y", ["model"]), ["model"], ["auc"])


YEAR_MEAN = """means AS (SELECT n_lines, avg(o_totalprice) AS est FROM yearly GROUP BY 1)"""


@query("regression_metrics", with_sql(YEARLY, YEAR_MEAN, """
SELECT year, count(*) AS n, round(sqrt(avg((o_totalprice-est)**2)), 4) AS rmse, round(avg(abs(o_totalprice-est)), 4) AS mae,
       round(avg((o_totalprice-est)**2), 0) AS mse, round(-avg((o_totalprice-est)**2), 0) AS neg_mse
FROM yearly JOIN means USING (n_lines) GROUP BY 1"""))
def regression_metrics(t):
    rows = yearly(t)
    means = rows.groupBy("n_lines").agg(F.avg("o_totalprice").alias("est"))
    out = metrics.regression_metrics(rows.join(means, "n_lines"), "o_totalprice", "est", ["year"])
    return out.select("year", "n", *[F.round(c, 4).alias(c) for c in ("rmse", "mae")], *[F.round(c, 0).alias(c) for c in ("mse", "neg_mse")])


ENTROPY = """
cells AS (SELECT run_id, truth, pred, count(*) AS c FROM runs GROUP BY ALL),
tot AS (SELECT run_id, CAST(sum(c) AS DOUBLE) AS n FROM cells GROUP BY 1),
ta AS (SELECT run_id, truth, CAST(sum(c) AS DOUBLE) AS a FROM cells GROUP BY ALL),
pb AS (SELECT run_id, pred, CAST(sum(c) AS DOUBLE) AS b FROM cells GROUP BY ALL),
mi AS (SELECT run_id, sum(c/n*ln(c*n/(a*b))) AS mi FROM cells JOIN tot USING (run_id) JOIN ta USING (run_id, truth)
       JOIN pb USING (run_id, pred) GROUP BY 1),
ht AS (SELECT run_id, -sum(a/n*ln(a/n)) AS ht FROM ta JOIN tot USING (run_id) GROUP BY 1),
hp AS (SELECT run_id, -sum(b/n*ln(b/n)) AS hp FROM pb JOIN tot USING (run_id) GROUP BY 1),
ent AS (SELECT run_id, mi, ht, hp, mi/ht AS hom, mi/hp AS com FROM mi JOIN ht USING (run_id) JOIN hp USING (run_id))"""
RAND = """
cp AS (SELECT run_id, sum(c*(c-1)/2.0) AS s FROM cells GROUP BY 1),
ap AS (SELECT run_id, sum(a*(a-1)/2.0) AS s FROM ta GROUP BY 1),
bp AS (SELECT run_id, sum(b*(b-1)/2.0) AS s FROM pb GROUP BY 1),
ari AS (SELECT run_id, (cp.s - ap.s*bp.s/(n*(n-1)/2.0)) / ((ap.s+bp.s)/2.0 - ap.s*bp.s/(n*(n-1)/2.0)) AS ari
        FROM cp JOIN ap USING (run_id) JOIN bp USING (run_id) JOIN tot USING (run_id))"""
EMI = """
grid AS (SELECT run_id, a, b, n, unnest(range(CAST(greatest(1, a+b-n) AS BIGINT), CAST(least(a,b) AS BIGINT)+1)) AS m
         FROM ta JOIN pb USING (run_id) JOIN tot USING (run_id)),
emi AS (SELECT run_id, sum(m/n*ln(n*m/(a*b))*exp(lgamma(a+1)+lgamma(b+1)+lgamma(n-a+1)+lgamma(n-b+1)-lgamma(n+1)
          -lgamma(m+1)-lgamma(a-m+1)-lgamma(b-m+1)-lgamma(n-a-b+m+1))) AS emi FROM grid GROUP BY 1)"""


@query("entropy_scores", with_sql(RUNS, ENTROPY, """
SELECT run_id, round(hom, 6) AS homogeneity, round(com, 6) AS completeness, round(2*hom*com/(hom+com), 6) AS v_measure FROM ent"""))
def entropy_scores(t):
    out = metrics.entropy_scores(cluster_runs(t), "truth", "pred", ["run_id"])
    return _r6(out, ["run_id"], ["homogeneity", "completeness", "v_measure"])


@query("adjusted_rand", with_sql(RUNS, ENTROPY, RAND, "SELECT run_id, round(ari, 6) AS adjusted_rand FROM ari"))
def adjusted_rand(t):
    return _r6(metrics.adjusted_rand(cluster_runs(t), "truth", "pred", ["run_id"]), ["run_id"], ["adjusted_rand"])


@query("adjusted_mutual_info", with_sql(RUNS, ENTROPY, EMI, """
SELECT run_id, round((mi-emi)/((ht+hp)/2.0-emi), 6) AS adjusted_mutual_info FROM ent JOIN emi USING (run_id)"""))
def adjusted_mutual_info(t):
    out = metrics.adjusted_mutual_info(cluster_runs(t), "truth", "pred", ["run_id"])
    return _r6(out, ["run_id"], ["adjusted_mutual_info"])


SCORES = ["homogeneity", "completeness", "v_measure", "adjusted_rand", "adjusted_mutual_info"]


@query("cluster_score_table", with_sql(RUNS, ENTROPY, RAND, EMI, """
SELECT run_id, round(hom, 6) AS homogeneity, round(com, 6) AS completeness, round(2*hom*com/(hom+com), 6) AS v_measure,
       round(ari, 6) AS adjusted_rand, round((mi-emi)/((ht+hp)/2.0-emi), 6) AS adjusted_mutual_info
FROM ent JOIN ari USING (run_id) JOIN emi USING (run_id)"""))
def cluster_score_table(t):
    return _r6(metrics.cluster_score_table(cluster_runs(t), "truth", "pred", ["run_id"]), ["run_id"], SCORES)


@query("best_runs", with_sql(RUNS, ENTROPY, RAND, "SELECT run_id, round(ari, 6) AS adjusted_rand FROM ari ORDER BY 2 DESC, 1 LIMIT 2"))
def best_runs(t):
    return adjusted_rand(t).orderBy(F.desc("adjusted_rand"), "run_id").limit(2)


@query("pred_actual", with_sql(YEARLY, YEAR_MEAN, """
SELECT o_orderkey, o_totalprice AS actual, round(est, 4) AS predicted, round(est - o_totalprice, 4) AS error
FROM yearly JOIN means USING (n_lines)"""))
def pred_actual(t):
    rows = yearly(t)
    means = rows.groupBy("n_lines").agg(F.avg("o_totalprice").alias("est"))
    out = metrics.pred_actual(rows.join(means, "n_lines"), "o_totalprice", "est", ["o_orderkey"])
    return out.select("o_orderkey", "actual", F.round("predicted", 4).alias("predicted"), F.round("error", 4).alias("error"))
