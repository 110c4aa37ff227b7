"""Grids from moments, families of generalized models, three classes, stored chains, clusters and projections by row."""

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from ..functions.scale import durable, scratch_path
from ..operators import classify, cluster as U, linear_path, prepare as P, regress, selection as S, tuning as T
from .modelling import CL, FLAT_BUCKET, TWO, X3, _flat, _points, _sides, _targets, two_feature_fit
from .registry import R, checks_frame, constant_checks, day, md5_bucket, query, rounded, station_flat, station_wide, table, with_views

# -- the grid of linear models ------------------------------------------------------------

_RIDGE = {0.0: "0e0", 0.01: "1e-2", 0.1: "1e-1", 0.3: "3e-1"}


@query(
    "tune_linear",
    with_views(
        "station_flat",
        f"SELECT CAST(reg AS DOUBLE) AS regParam, 0e0 AS elasticNetParam, {R('avg(rmse)')} AS score FROM err GROUP BY reg",
        f"""t AS MATERIALIZED (SELECT temp_min AS x1, temp_max AS x2, temp_mean AS y, {FLAT_BUCKET} % 3 AS f FROM station_flat WHERE {FLAT_BUCKET} < 3435973836),
        m AS MATERIALIZED (SELECT k.f, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, stddev_pop(x1) AS s1, stddev_pop(x2) AS s2, stddev_pop(y) AS sy,
          covar_pop(x1, x2) / stddev_pop(x1) / stddev_pop(x2) AS g12, covar_pop(x1, y) / stddev_pop(x1) / stddev_pop(y) AS r1, covar_pop(x2, y) / stddev_pop(x2) / stddev_pop(y) AS r2
          FROM t JOIN (SELECT DISTINCT f FROM t) k ON t.f <> k.f GROUP BY k.f),
        b AS MATERIALIZED (SELECT m.*, reg, 1 + reg / sy AS d FROM m, (VALUES {', '.join(f'({v})' for v in _RIDGE.values())}) r(reg)),
        c AS MATERIALIZED (SELECT *, (d * r1 - g12 * r2) / (d * d - g12 * g12) * sy / s1 AS b1, (d * r2 - g12 * r1) / (d * d - g12 * g12) * sy / s2 AS b2 FROM b),
        err AS MATERIALIZED (SELECT reg, c.f, sqrt(avg((y - my - b1 * (x1 - m1) - b2 * (x2 - m2)) * (y - my - b1 * (x1 - m1) - b2 * (x2 - m2)))) AS rmse FROM c JOIN t ON t.f = c.f GROUP BY reg, c.f)""",
    ),
)
def tune_linear(spark, d):
    """The ridge points of the grid, whose scores have a closed form; tests compare the others with single fits."""
    result = linear_path.tune_linear(_targets(spark, d, TWO), ["station", "d"], regs=tuple(_RIDGE))
    report = linear_path.path_report(result).filter("elasticNetParam = 0")
    return rounded(report.select("regParam", "elasticNetParam", "score"), "score")


# -- families of generalized models -------------------------------------------------------

FAMILIES = {
    ("binomial", "logit"): ("CASE WHEN l_discount > 0.05 THEN 1e0 ELSE 0e0 END", "ln({m} / (1 - {m}))"),
    ("poisson", "log"): ("CAST(l_linenumber AS DOUBLE)", "ln({m})"),
    ("poisson", "sqrt"): ("CAST(l_linenumber AS DOUBLE)", "sqrt({m})"),
    ("gamma", "log"): ("CAST(l_quantity AS DOUBLE)", "ln({m})"),
}


def _family_sql(family, link, y, of):
    one, zero = of.format(m="avg(y) FILTER (x = 1)"), of.format(m="avg(y) FILTER (x = 0)")
    source = f"(SELECT CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS x, {y} AS y FROM lineitem WHERE {md5_bucket('l_orderkey')} < 3435973836)"
    return f"SELECT '{family}' AS family, '{link}' AS link, {R(f'{one} - ({zero})')} AS slope, {R(zero)} AS intercept FROM {source}"


@query("glm_families", " UNION ALL ".join(_family_sql(*k, *v) for k, v in FAMILIES.items()))
def glm_families(spark, d):
    """With a feature of two values a fit is the link of the two means, whatever the family.

    Rows alike are fitted as one with their number as weight, so the input is read once for each side, not in every step of a fit.
    Gamma with the inverse link is not here: MLlib's fit of it diverges on these rows.
    """
    rows = table(spark, d, "lineitem").selectExpr("l_orderkey", "CASE WHEN l_returnflag = 'N' THEN 1D ELSE 0D END AS x", *[f"{y.replace('1e0', '1D').replace('0e0', '0D')} AS y{i}" for i, (y, _) in enumerate(FAMILIES.values())])
    out = []
    prepared = P.prepare_counted(rows, ["x"], [f"y{i}" for i in range(len(FAMILIES))], ["l_orderkey"])
    for (family, link), p in zip(FAMILIES, prepared.values(), strict=True):
        with p.kept():
            model = regress.glm(p, family, link, reg_param=0.0, max_iter=50).model
        out.append((family, link, float(model.coefficients[0]), float(model.intercept)))
    return rounded(spark.createDataFrame(out, "family string, link string, slope double, intercept double"), "slope", "intercept")


# -- three classes ------------------------------------------------------------------------

_THREE = "CASE WHEN temp_mean < -1 THEN 0 WHEN temp_mean < 1 THEN 1 ELSE 2 END"
_THREE_SQL = with_views(
    "station_flat",
    constant_checks(**_sides(True, True, classes=f"SELECT count(DISTINCT {_THREE}) FROM station_flat WHERE {FLAT_BUCKET} < 3435973836", hits_agree="1", violations="0")),
)


def _three(name, fit):
    @query(name, _THREE_SQL)
    def run(spark, d):
        """Invariants: split sizes and classes recounted; predictions are known classes, accuracy equals a recount, one probability a class."""
        p = P.prepare_classification(_flat(spark, d).withColumn("warmth", F.expr(_THREE)), X3, "warmth", ["station", "d"])
        with p.kept():
            classes = p.train.select(p.label_col).distinct().count()
            r = fit(p)
            hits = F.avg((F.col("prediction") == F.col(p.label_col)).cast("double"))
            outside = F.count_if(~F.col("prediction").isin(0.0, 1.0, 2.0))
            row = r.predictions.agg(F.count("*").alias("n"), hits.alias("hits"), outside.alias("outside")).first()
            bad = row.outside + sum(not 0 <= v <= 1 for v in r.metrics.values())
            if "probability" in r.predictions.columns:
                bad += r.predictions.filter(F.size(vector_to_array("probability")) != 3).count()
            return checks_frame(spark, train_rows=p.train.count(), test_rows=row.n, classes=classes, hits_agree=int(abs(r.metrics["accuracy"] - row.hits) < 1e-9), violations=bad)

    return run


_three("logistic_regression_three", lambda p: classify.logistic_regression(p, multiclass=True))
_three("random_forest_three", classify.random_forest_classifier)
_three("one_vs_rest_three", classify.one_vs_rest)

# -- a stored chain -----------------------------------------------------------------------

_CHAIN = ("ST_1_temp_min", "ST_2_temp_mean")
_FILLED = f"w AS MATERIALIZED (SELECT DATE_PARSED, ST_1_temp_mean AS y, {', '.join(f'coalesce({c}, (SELECT avg({c}) FROM station_wide WHERE ST_1_temp_mean IS NOT NULL)) AS x{i}' for i, c in enumerate(_CHAIN, 1))} FROM station_wide)"


@query(
    "stored_pipeline",
    with_views("station_wide", f"SELECT CAST(DATE_PARSED AS VARCHAR) AS d, {R('b0 + b1 * x1 + b2 * x2')} AS prediction, 0 AS changed FROM w, fit", f"{_FILLED}, {two_feature_fit('x1', 'x2', 'y', 'w', 'y IS NOT NULL')}"),
)
def stored_pipeline(spark, d):
    """Raw rows, gaps and all, through a chain that was stored and loaded again; the unstored chain predicts the same."""
    rows = durable(station_wide(spark, d).select("DATE_PARSED", "ST_1_temp_mean", *_CHAIN))
    fitted = T.fit_pipeline(rows, _CHAIN, (), LinearRegression(labelCol="ST_1_temp_mean", regParam=0.0, solver="normal"))
    root = scratch_path(spark, "models")
    T.save_pipeline(fitted, spark, root, "warmth")
    again = T.load_pipeline(spark, root, "warmth").score(rows).select("DATE_PARSED", "prediction")
    first = fitted.score(rows).select("DATE_PARSED", F.col("prediction").alias("_first"))
    both = again.join(first, "DATE_PARSED").select(day("DATE_PARSED").alias("d"), "prediction", (F.col("prediction") != F.col("_first")).cast("int").alias("changed"))
    return rounded(both, "prediction")


# -- rows with their cluster, rows projected ----------------------------------------------


@query(
    "join_clusters",
    with_views("station_flat", f"SELECT CAST(sum(CASE WHEN {' AND '.join(f'{c} IS NOT NULL' for c in CL)} THEN 1 ELSE 0 END) AS BIGINT) AS rows, count(*) AS days, {R('sum(temp_mean)')} AS total, 3 AS clusters, 0 AS torn FROM station_flat"),
)
def join_clusters(spark, d):
    """Every row of the original table with its cluster. Rows of equal features are in one cluster."""
    flat = station_flat(spark, d)
    found = U.kmeans(_points(spark, d), 3).predictions
    joined = durable(U.join_clusters(found, flat, ["station", "d"]))
    torn = joined.groupBy(*CL).agg(F.count_distinct("cluster").alias("k")).filter("k > 1").count()
    counts = joined.agg(F.count("*").alias("rows"), F.count_distinct("station", "d").alias("days"), F.sum("temp_mean").alias("total"), F.count_distinct("cluster").cast("int").alias("clusters"))
    return rounded(counts.withColumn("torn", F.lit(torn)), "total")


@query(
    "pca_projection",
    with_views(
        "station_flat",
        f"SELECT station, CAST(d AS VARCHAR) AS d, {R('abs(temp_min * c + temp_max * (hi - a)) / sqrt(c * c + (hi - a) * (hi - a))')} AS first, {R('abs(temp_min * c + temp_max * (lo - a)) / sqrt(c * c + (lo - a) * (lo - a))')} AS second FROM station_flat, e",
        """m AS (SELECT var_samp(temp_min) AS a, var_samp(temp_max) AS b, covar_samp(temp_min, temp_max) AS c FROM station_flat),
        e AS MATERIALIZED (SELECT *, (a + b) / 2 + sqrt((a - b) * (a - b) / 4 + c * c) AS hi, (a + b) / 2 - sqrt((a - b) * (a - b) / 4 + c * c) AS lo FROM m)""",
    ),
)
def pca_projection(spark, d):
    """The projected rows, written out and read back. The sign of a component is not defined, so sizes are compared."""
    projected, _, _ = S.pca(station_flat(spark, d), ["temp_min", "temp_max"], 2)
    values = vector_to_array("pcaFeatures")
    stored = durable(projected.select("station", day("d").alias("d"), F.abs(values[0]).alias("first"), F.abs(values[1]).alias("second")))
    return rounded(stored, "first", "second")
