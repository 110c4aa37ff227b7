"""Evaluation of deterministic prediction tables."""

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..operators import classify, evaluate as E, regress
from .registry import R, query, r8, rounded, table, with_views

SCORE_SQL = "floor(l_quantity + l_discount * 100 + 0.5e0)"
PREDS_SQL = f"""preds AS MATERIALIZED (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, {SCORE_SQL} AS score, CAST({SCORE_SQL} > 30 AS INTEGER) AS prediction FROM lineitem)"""
MULTI_SQL = f"""multi AS MATERIALIZED (SELECT CASE l_returnflag WHEN 'A' THEN 0e0 WHEN 'N' THEN 1e0 ELSE 2e0 END AS label,
  CASE WHEN {SCORE_SQL} <= 20 THEN 0e0 WHEN {SCORE_SQL} <= 45 THEN 1e0 ELSE 2e0 END AS prediction FROM lineitem)"""


def _score():
    return F.floor(F.col("l_quantity") + F.col("l_discount") * 100 + F.lit(0.5)).cast("double")


def preds(spark, d):
    """Label: returned; score and prediction: from quantity and discount."""
    return table(spark, d, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), _score().alias("score"), (_score() > 30).cast("int").alias("prediction")
    )


def multi(spark, d):
    flag = F.col("l_returnflag")
    return table(spark, d, "lineitem").select(
        F.when(flag == "A", 0.0).when(flag == "N", 1.0).otherwise(2.0).alias("label"),
        F.when(_score() <= 20, 0.0).when(_score() <= 45, 1.0).otherwise(2.0).alias("prediction"),
    )


@query(
    "binary_confusion",
    f"""WITH {PREDS_SQL}, c AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
    count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 1 AND prediction = 0) AS fn FROM preds),
    r AS (SELECT *, (tp + tn) / (tp + fp + tn + fn) AS accuracy, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall FROM c)
    SELECT tp, fp, tn, fn, {R('accuracy')} AS accuracy, {R('precision')} AS precision, {R('recall')} AS recall,
    {R('2 * precision * recall / (precision + recall)')} AS f1 FROM r""",
)
def binary_confusion(spark, d):
    return rounded(E.binary_confusion(preds(spark, d)), "accuracy", "precision", "recall", "f1")


@query(
    "binary_auc",
    f"""WITH {PREDS_SQL}, g AS (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM preds GROUP BY 1),
    t AS (SELECT sum(p) AS tp, sum(n) AS tn FROM g),
    c AS (SELECT score, p, n, sum(p) OVER w AS cp, sum(n) OVER w AS cn FROM g WINDOW w AS (ORDER BY score DESC)),
    pts AS (SELECT score, cp / tp AS rec, cp / (cp + cn) AS prec, tp, tn FROM c, t),
    l AS (SELECT rec, prec, coalesce(lag(rec) OVER o, 0e0) AS rec0, coalesce(lag(prec) OVER o, prec) AS prec0 FROM pts WINDOW o AS (ORDER BY score DESC))
    SELECT (SELECT {R('sum(n * (cp - p / 2e0)) / (any_value(tp) * any_value(tn))')} FROM c, t) AS auc_roc,
    (SELECT {R('sum((rec - rec0) * (prec + prec0) / 2)')} FROM l) AS auc_pr""",
)
def binary_auc(spark, d):
    df = preds(spark, d).select(F.col("label").cast("double").alias("label"), "score")
    return rounded(E.binary_auc(df, "label", "score"), "auc_roc", "auc_pr")


@query("confusion_matrix", f"WITH {MULTI_SQL} SELECT label, prediction, count(*) AS count FROM multi GROUP BY 1, 2")
def confusion_matrix(spark, d):
    return E.confusion_matrix(multi(spark, d))


_PER = f"""{MULTI_SQL}, per AS MATERIALIZED (SELECT label AS class, count(*) FILTER (prediction = label) AS hit, count(*) AS support,
  (SELECT count(*) FROM multi m WHERE m.prediction = multi.label) AS predicted FROM multi GROUP BY 1),
  pr AS MATERIALIZED (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hit / predicted END AS p, hit / support AS r FROM per),
  pf AS MATERIALIZED (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM pr)"""


@query("class_metrics", f"WITH {_PER} SELECT class, {R('p')} AS precision, {R('r')} AS recall, {R('f')} AS f1, support FROM pf")
def class_metrics(spark, d):
    return rounded(E.class_metrics(multi(spark, d)).drop("hit"), "precision", "recall", "f1")


@query(
    "multiclass_metrics",
    f"""WITH {_PER} SELECT {R('sum(hit) / sum(support)')} AS accuracy, {R('sum(f * support) / sum(support)')} AS f1,
    {R('sum(p * support) / sum(support)')} AS weighted_precision, {R('sum(r * support) / sum(support)')} AS weighted_recall FROM pf""",
)
def multiclass_metrics(spark, d):
    return rounded(E.multiclass_metrics(multi(spark, d)), "accuracy", "f1", "weighted_precision", "weighted_recall")


@query(
    "regression_metrics",
    f"""WITH e AS (SELECT l_discount AS y, l_tax AS p FROM lineitem)
    SELECT {R('sqrt(avg((p - y) * (p - y)))')} AS rmse, {R('avg(abs(p - y))')} AS mae, {R('1 - avg((p - y) * (p - y)) / var_pop(y)')} AS r2,
    {R('avg(p - y)')} AS mean_error, {R('avg((p - y) * (p - y))')} AS mse, {R('100 * avg(abs((p - y) / y)) FILTER (y <> 0)')} AS mape FROM e""",
)
def regression_metrics(spark, d):
    out = E.regression_metrics(table(spark, d, "lineitem"), "l_discount", "l_tax")
    return rounded(out, *out.columns)


PRICE_SQL = "SELECT o_orderkey, o_totalprice AS label, 150000e0 + 1000 * month(o_orderdate) AS prediction FROM orders"


def _prices(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("label"), (F.lit(150000.0) + 1000 * F.month("o_orderdate")).alias("prediction")
    )


@query("residuals", f"SELECT *, {R('label - prediction')} AS residual FROM ({PRICE_SQL})")
def residuals(spark, d):
    return rounded(E.residuals(_prices(spark, d)), "residual")


@query("prediction_bounds", f"SELECT least(min(label), min(prediction)) AS lo, greatest(max(label), max(prediction)) AS hi FROM ({PRICE_SQL})")
def prediction_bounds(spark, d):
    return E.prediction_bounds(_prices(spark, d))


@query("sample_predictions", f"SELECT * FROM ({PRICE_SQL}) ORDER BY o_orderkey LIMIT 10")
def sample_predictions(spark, d):
    return E.sample_predictions(_prices(spark, d), ["o_orderkey"])


def clustered(spark, d):
    """Embeddings with their label as the cluster."""
    return table(spark, d, "embeddings").select(
        "vec_id", F.col("label").cast("int").alias("prediction"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )


@query(
    "clustering_metrics",
    f"""WITH x AS MATERIALIZED (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
    m AS MATERIALIZED (SELECT label AS k, i, avg(v) AS a FROM x GROUP BY 1, 2),
    sq AS MATERIALIZED (SELECT vec_id, label, sum(v * v) AS s FROM x GROUP BY 1, 2),
    q AS MATERIALIZED (SELECT label AS k, avg(s) AS q, count(*) AS n FROM sq GROUP BY 1),
    dot AS MATERIALIZED (SELECT x.vec_id, x.label, m.k, sum(x.v * m.a) AS d FROM x JOIN m ON x.i = m.i GROUP BY 1, 2, 3),
    dist AS MATERIALIZED (SELECT dot.vec_id, dot.label, dot.k, q.n, sq.s - 2 * dot.d + q.q AS e FROM dot JOIN sq ON dot.vec_id = sq.vec_id JOIN q ON q.k = dot.k),
    ab AS (SELECT vec_id, max(CASE WHEN label = k THEN e * n / (n - 1) END) AS a, min(CASE WHEN label <> k THEN e END) AS b FROM dist GROUP BY 1)
    SELECT CAST(label AS INTEGER) AS cluster, count(*) AS size, {R('count(*) / (SELECT count(*) FROM embeddings)')} AS share,
    (SELECT count(DISTINCT label) FROM embeddings) AS clusters, (SELECT {R('avg((b - a) / greatest(a, b))')} FROM ab) AS silhouette
    FROM embeddings GROUP BY 1""",
)
def clustering_metrics(spark, d):
    return rounded(E.clustering_metrics(clustered(spark, d)), "share", "silhouette")


@query("cluster_sizes", f"SELECT label AS cluster, count(*) AS size, {R('count(*) / (SELECT count(*) FROM embeddings)')} AS share FROM embeddings GROUP BY 1")
def cluster_sizes(spark, d):
    return rounded(E.cluster_sizes(clustered(spark, d)), "share")


@query(
    "compare_models",
    f"""WITH e AS (SELECT l_returnflag AS model, l_discount AS y, l_tax AS p FROM lineitem)
    SELECT model, {R('sqrt(avg((p - y) * (p - y)))')} AS rmse, {R('avg(abs(p - y))')} AS mae, CAST(NULL AS DOUBLE) AS accuracy FROM e GROUP BY 1""",
)
def compare_models(spark, d):
    e = F.col("l_tax") - F.col("l_discount")
    grouped = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("model")).agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"))
    long = grouped.selectExpr("model", "inline(array(named_struct('metric', 'rmse', 'value', rmse), named_struct('metric', 'mae', 'value', mae)))")
    return rounded(E.compare_models(long, ["rmse", "mae", "accuracy"], "rmse"), "rmse", "mae")
