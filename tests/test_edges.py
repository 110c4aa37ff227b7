"""Edge fixtures: missing values, ties, edges, empty classes, duplicate keys."""

import datetime as dt
import math

import pytest
from pyspark.sql import Window, functions as F

from stationlab import sources as S
from stationlab.functions import cut as C
from stationlab.functions.indexing import dense_index, hash_split
from stationlab.functions.naming import split_name, stations
from stationlab.operators import classify, cleaning as K, cluster as U, evaluate as E, features as X
from stationlab.plans import medallion as M
from stationlab.operators import patterns as P, prepare, profile, recommend, regress, relations, runs as L, selection, series, tuning


def values(df, *cols):
    return [tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()]


def test_names():
    assert split_name("DE_BILT_temp_mean") == ("DE_BILT", "temp_mean")
    assert split_name("humidity") is None and split_name("DATE") is None
    assert stations(["DATE", "B_humidity", "A_temp_max", "A_temp_min"]) == ["A", "B"]


def test_dates_and_numbers(spark, tmp_path):
    rows = [("20000101", "1.5"), ("20000230", "x"), ("bad", ""), ("", "NaN"), (None, None)]
    df = spark.createDataFrame(rows, "d string, v string")
    assert values(df.select(S.parse_date(F.col("d")).alias("d")), "d") == [dt.date(2000, 1, 1), None, None, None, None]
    got = values(S.cast_numeric(df, ["v"]), "v")
    assert got[0] == 1.5 and got[1] is None and got[2] is None and math.isnan(got[3]) and got[4] is None


def test_station_csv(spark, tmp_path):
    p = str(tmp_path / "s.csv")
    with open(p, "w") as f:
        f.write("DATE,MONTH,A_temp_mean,DE_BILT_humidity\n20000102,1,3.5,0.8\n20000103,1,,bad\n")
    df = S.load_station_table(spark, p)
    assert dict(df.dtypes)["A_temp_mean"] == "double" and dict(df.dtypes)["MONTH"] == "string"
    assert sorted(values(df, "YEAR", "DAY", "A_temp_mean"), key=str) == [(2000, 2, 3.5), (2000, 3, None)]
    long = S.melt_stations(df, ["DATE_PARSED"], drop_null=True)
    assert sorted(values(long, "station", "metric", "value")) == [("A", "temp_mean", 3.5), ("DE_BILT", "humidity", 0.8)]


def test_profile_counts_missing_by_type(spark):
    df = spark.createDataFrame([(1.0, "a", None), (float("nan"), "", dt.date(2000, 1, 1)), (None, None, None)], "x double, s string, d date")
    got = {r.column: r.missing for r in profile.profile_table(df).collect()}
    assert got == {"x": 2, "s": 2, "d": 2}
    decimals = df.select(F.lit(1).cast("decimal(9,2)").alias("n"), "s")
    assert [r.column for r in profile.basic_stats(decimals).collect()] == ["n"]


def test_flat_columns(spark):
    df = spark.createDataFrame([(i, 5.0, None, float(i)) for i in range(6)] + [(7, 5.0, None, None)], "id int, flat double, none double, v double")
    flags = K.zscore_outliers(df, threshold=0.1, id_cols=["id"])
    assert not any(values(flags, "flat_outlier")) and not any(values(flags, "none_outlier")) and any(values(flags, "v_outlier"))
    assert K.outliers_remove(df, ["flat"], sequential=False).count() == 7
    assert K.outliers_remove(df, ["flat", "none"]).count() == 7
    assert K.outliers_remove(df, ["v"], z=9).count() == 6 and K.outliers_remove(df, ["v"], z=9, keep_nulls=True).count() == 7
    assert K.outliers_remove(df, ["v"], z=9, sequential=False, keep_nulls=True).count() == 7
    assert {r.feature1 for r in relations.correlation_pairs(df, ["id", "flat", "none", "v"]).collect()} == {"id"}
    filled = K.clean_dataset(df, ["id"], "median", "impute")
    assert values(filled.filter("id = 7"), "v") == [2.0] and filled.filter("none IS NOT NULL").count() == 0
    scaled = K.scaled_columns(K.standardize(df, ["flat", "v"]), ["flat", "v"])
    assert set(values(scaled, "flat_scaled")) == {0.0} and scaled.count() == 6


def test_duplicate_ids_keep_their_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), (None, 50.0), (None, 1.0)] + [("b", 1.0)] * 10, "id string, v double")
    out = K.zscore_outliers(df, id_cols=["id"])
    assert out.count() == df.count() and out.filter("v_outlier").count() == 1


def test_mode_takes_smallest_on_ties(spark):
    df = spark.createDataFrame([(2.0,), (1.0,), (2.0,), (1.0,), (None,)], "v double")
    assert sorted(values(K.impute_mode(df), "v")) == [1.0, 1.0, 1.0, 2.0, 2.0]


def test_bins(spark):
    df = spark.createDataFrame([(-101.0,), (-100.0,), (0.0,), (10.0,), (100.0,), (None,), (float("nan"),)], "v double")
    right = values(df.select(C.cut(F.col("v"), *C.TEMP_BINS).alias("c")), "c")
    assert right == [None, None, "Freezing", "Cold", "Hot", None, None]
    left = values(df.select(C.cut(F.col("v"), *C.TEMP_BINS, right=False).alias("c")), "c")
    assert left == [None, "Freezing", "Cold", "Mild", "Hot", None, None]
    assert values(df.select(X.temp_regime(F.col("v")).alias("c")), "c")[5] == "hot"
    assert values(df.select(X.trend_label(F.col("v")).alias("c")), "c")[5] == "stable"
    assert values(spark.range(1).select(X.season(F.lit(None).cast("int")).alias("s")), "s") == ["winter"]


def test_ties_and_histogram(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "v string")
    assert values(profile.value_counts(df, "v", 2), "value", "share") == [("c", 0.5), ("a", 0.25)]
    flat = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    assert values(profile.histogram(flat, "x", 5), "bin", "count") == [(0, 2)]


def test_homonyms_and_gaps(spark):
    rows = [("X", "P", 2000, 1.0), ("X", "P", 2005, 4.0), ("Y", "P", 2001, 100.0), ("X", "P", 2006, 9.0)]
    df = spark.createDataFrame(rows, "Country string, City string, Year int, T double")
    got = {(r.Country, r.Year): r.prev_year_temp for r in X.yoy_change(df, ["Country", "City"], "Year", "T").collect()}
    assert got == {("X", 2000): None, ("X", 2005): 1.0, ("Y", 2001): None, ("X", 2006): 4.0}
    counted = series.rolling_stats(df, ["Country", "City"], "Year", "T", 2)
    assert {(r.Country, r.Year): r.rolling_mean for r in counted.collect()}[("X", 2006)] == 6.5
    idx = {r.City: r.city_index for r in X.city_index(df.withColumn("City", F.concat("Country", "City"))).collect()}
    assert idx == {"XP": 0.0, "YP": 1.0}
    nulls = X.global_deviation(df.union(spark.createDataFrame([("Z", "Q", None, 5.0)], df.schema)), "Year", "T")
    assert values(nulls.filter("Year IS NULL"), "global_avg_temp") == [None]


def test_anomaly_needs_spread(spark):
    df = spark.createDataFrame([("a", i, 0.1 + 0.2) for i in range(20)] + [("b", i, 100.0 if i == 9 else float(i % 2)) for i in range(20)], "k string, t int, v double")
    out = K.moving_anomalies(df, ["k"], "t", ["v"], 5, chunk=4)
    assert [(r.k, r.t) for r in out.filter("v_anomaly").collect()] == [("b", 9)]


@pytest.mark.parametrize("offset", [0.0, 1e8])
def test_anomalies_with_a_moment_of_most_rows(spark, offset):
    """The frames of moments against a plain window over the rows."""
    import random

    r = random.Random(6)
    rows = [("a", 50 if r.random() < 0.8 else r.randint(0, 100), offset + r.gauss(0, 1) * r.choice([1, 1, 1, 5])) for _ in range(800)]
    rows += [(None, None, 1.0), (None, None, 90.0), (None, 3, None), (None, 4, float("nan")), (None, 5, 2.0), ("one", 1, 5.0)] + [(None, 5, 2.5)] * 9
    df = spark.createDataFrame(rows, "k string, t int, v double").repartition(6)
    w = Window.partitionBy("k").orderBy("t").rangeBetween(-5, 5)
    v = F.when(~F.isnan("v"), F.col("v"))
    far = (F.max(v).over(w) > F.min(v).over(w)) & (F.abs(v - F.avg(v).over(w)) > 2 * F.stddev_samp(v).over(w))
    plain = df.withColumn("v_anomaly", F.coalesce(far, F.lit(False)))
    key = lambda x: tuple(map(str, x))
    want = sorted(key(x) for x in plain.collect())
    assert sorted(key(x) for x in K.moving_anomalies(df, ["k"], "t", ["v"], 5, chunk=7).collect()) == want
    assert sum(x[-1] == "True" for x in want) > 5
    alone = K.moving_anomalies(df.drop("k"), [], "t", ["v"], 5)
    assert alone.count() == len(rows) and alone.columns == ["t", "v", "v_anomaly"]


def test_metrics(spark):
    perfect = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (1.0, 1.0)], "label double, prediction double")
    m = E.binary_confusion(perfect).first()
    assert (m.accuracy, m.precision, m.recall, m.f1) == (1, 1, 1, 1)
    never = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (2.0, 0.0), (0.0, 7.0)], "label double, prediction double")
    per = {r["class"]: (r.precision, r.recall, r.f1) for r in E.class_metrics(never).collect()}
    assert per[1.0] == (0, 0, 0) and per[2.0] == (0, 0, 0) and 7.0 not in per
    none = E.binary_confusion(never.filter("label = 0 AND prediction = 0")).first()
    assert none.precision == 0 and none.f1 == 0
    zero = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "label double, prediction double")
    r = E.regression_metrics(zero).first()
    assert r.mape == 50 and r.mean_error == 0 and r.mse == 1
    assert E.regression_metrics(zero.filter("label = 2")).first().r2 is None
    ranked = spark.createDataFrame([("a", "rmse", 2.0), ("b", "rmse", 1.0), ("c", "mae", 0.1)], "model string, metric string, value double")
    assert values(E.compare_models(ranked, ["rmse", "mae"], "rmse"), "model") == ["b", "a", "c"]


def test_baskets(spark):
    rows = [("a", "x", 1), ("a", None, 1), ("a", "x", 2), ("b", "x", 1), (None, None, None)]
    df = spark.createDataFrame(rows, "p string, q string, r int")
    baskets = P.build_baskets(df, ["p", "q", "r", "absent"])
    assert values(baskets, "items")[1] == ["p=a", "r=1"] and values(baskets, "items")[4] == []
    twice = P.build_baskets(df.withColumn("p", F.lit("a")), ["p", "p"])
    assert set(map(tuple, values(twice, "items"))) == {("p=a",)}
    mined = P.mine(baskets, 0.4, 0.6)
    support = {tuple(r["items"]): r.support for r in mined.itemsets.collect()}
    assert support[("p=a",)] == 0.6 and support[("p=a", "q=x")] == 0.4
    assert {(tuple(r.antecedent), r.consequent[0]): r.confidence for r in mined.rules.collect()}[(("p=a",), "q=x")] == pytest.approx(2 / 3)
    assert " -> " in P.top_rules(mined.rules, 1).first().rule


def test_dense_index_and_split(spark):
    df = spark.range(5000).select((F.col("id") * 7 % 5000).alias("v")).repartition(16)
    ids = dense_index(df, ["v"]).collect()
    assert all(r["index"] == r.v for r in ids) and len(ids) == 5000
    a, b = hash_split(df, ["v"]), hash_split(df.repartition(3), ["v"])
    assert sorted(values(a[0], "v")) == sorted(values(b[0], "v")) and a[0].count() + a[1].count() == 5000


@pytest.fixture(scope="module")
def planted(spark):
    def noise(seed):
        return F.xxhash64("id", F.lit(seed)) % 1000 / 1000.0

    df = spark.range(600).select("id", noise(1).alias("x"), noise(2).alias("z"), (F.col("id") % 3).cast("int").alias("g"))
    df = df.withColumns({"y": 2 * F.col("x") + noise(3) * 0.01, "label": (F.col("x") > 0).cast("int"), "a": F.col("g") * 10 + F.col("x"), "b": F.col("g") * -10 + F.col("z")})
    return df.withColumn("text", F.when(F.col("label") == 1, "wet").otherwise("dry"))


def test_planted_models(spark, planted, tmp_path):
    p = prepare.prepare_regression(planted, ["x", "z"], "y", ["id"])
    fit = regress.linear_regression(p, reg_param=0.0)
    assert fit.metrics["r2"] > 0.99 and fit.model.coefficients[0] == pytest.approx(2, abs=0.02)
    with pytest.raises(ValueError):
        regress.glm(p, "poisson", "inverse")
    c = prepare.prepare_classification(planted, ["x", "z"], "text", ["id"])
    trees = classify.random_forest_classifier(c, 5)
    assert trees.metrics["accuracy"] > 0.95
    top = E.feature_importance(spark, trees.model, ["x", "z"]).first()
    assert top.feature == "x"
    bayes = classify.naive_bayes(c)
    assert bayes.details["model_type"] == "gaussian" and bayes.metrics["accuracy"] > 0.9
    with pytest.raises(ValueError):
        classify.gbt_classifier(prepare.prepare_classification(planted, ["x", "z"], "g", ["id"]))
    assert selection.select_by_model(planted, ["z", "x"], "label", num_top_features=1).features == ["x"]
    assert selection.select_univariate(planted, ["z", "x"], "y", num_top_features=1).features == ["x"]
    tuned = tuning.tune_classifier(c, "logistic_regression", grid={"regParam": [0.0, 5.0]}, fold_keys=["id"])
    report = tuning.tuning_report(tuned).collect()
    assert [r.is_best for r in report] == [True, False] and tuned.metrics["accuracy"] > 0.95
    tuning.save_model(trees.model, str(tmp_path), "rf", "forest")
    again = tuning.load_model(spark, str(tmp_path), "rf", "forest").transform(c.test)
    assert values(again.orderBy("id"), "prediction") == values(trees.predictions.orderBy("id"), "prediction")


def test_optimal_k_on_blobs(planted):
    points = prepare.prepare_clustering(planted, ["a", "b"])
    out = U.optimal_k(points, k_range=(2, 5))
    assert values(out.filter("is_best"), "k") == [3]
    with pytest.raises(ValueError):
        U.optimal_k(points, "nothing")
    r = U.kmeans(points, 3)
    assert sorted(x["size"] for x in E.cluster_sizes(r.predictions, "cluster").collect()) == [200, 200, 200]
    assert U.center_table(r, ["a", "b"]).count() == 6
    halves = U.bisecting_kmeans(points, 3)
    assert sorted(x["size"] for x in E.cluster_sizes(halves.predictions, "cluster").collect()) == [200, 200, 200]
    middle = {x.feature: x.s for x in U.center_table(halves, ["a", "b"]).groupBy("feature").agg(F.sum("center").alias("s")).collect()}
    assert all(abs(v) < 1e-6 for v in middle.values())


def test_recommendations(spark):
    rows = [(f"u{u}", f"i{i}", float((u * i) % 5)) for u in range(12) for i in range(8)] * 2
    r = recommend.prepare_ratings(spark.createDataFrame(rows, "u string, i string, r double"), "u", "i", "r")
    assert r.train.count() + r.test.count() == 96
    m = recommend.als_train(r, rank=3, max_iter=3)
    top = recommend.recommend_top_n(m, r, 2)
    assert {x["count"] for x in top.groupBy("u").count().collect()} == {2}


def test_run_log(spark, tmp_path):
    root = str(tmp_path / "log")
    a = L.log_experiment(spark, root, "exp", {"kind": "lr"}, {"reg": 0.1}, {"auc": 0.5, "note": "text", "flag": True})
    b = L.log_experiment(spark, root, "exp", {}, {"reg": 0.2}, {})
    for step, v in ((1, 0.7), (2, 0.9)):
        more = spark.createDataFrame([(a, "auc", v, step, dt.datetime(2100, 1, step))], L.SCHEMAS["metrics"])
        S.write_layer(more, f"{root}/metrics", "append")
    tables = [L.log_table(spark, root, n) for n in ("runs", "params", "metrics")]
    details = {r.run_id: r for r in L.run_details(*tables).collect()}
    assert details[a].metrics == {"auc": 0.9} and details[b].metrics is None and details[a].params["info_kind"] == "lr"
    flat = {r.run_id: r for r in L.experiment_summary(*tables, experiment="exp").collect()}
    assert flat[a].metric_auc == 0.9 and flat[b].metric_auc is None and flat[b].param_reg == "0.2"
    assert values(L.experiment_summary(*tables), "experiment", "runs") == [("exp", 2)]


def test_csv_to_gold(spark, tmp_path):
    weather, city, root = tmp_path / "w.csv", tmp_path / "c.csv", str(tmp_path / "root")
    days = [dt.date(2000, 1, 1) + dt.timedelta(i) for i in range(40)]
    with open(weather, "w") as f:
        f.write("DATE,MONTH,A_temp_mean,A_humidity,A_precipitation,DE_BILT_temp_mean\n")
        for i, d in enumerate(days):
            f.write(f"{d:%Y%m%d},{d.month},{i % 9},0.{i % 7},{i % 3},{'' if i % 10 == 3 else i % 5}\n")
    with open(city, "w") as f:
        f.write("Country,City,Year,AvgYearlyTemp,PrevTemp,TempChange\n")
        for y in range(1990, 2005):
            f.write(f"X,P,{y},{y % 7},{'' if y == 1990 else (y - 1) % 7},{'' if y == 1990 else y % 7 - (y - 1) % 7}\nX,Q,{y},,,\n")
    M.build_bronze(spark, root, str(weather), str(city))
    M.build_silver(spark, root)
    M.build_gold(spark, root)
    got = {(r.layer, r["name"]): r.rows for r in S.layer_inventory(spark, root).collect()}
    assert got[("bronze", "temperature_data")] == 30 and got[("silver", "temperature_clean")] == 15
    assert got[("gold", "weather_features")] == 40 and got[("gold", "DE_BILT_temp_prediction")] == 40
    sets = S.read_layer(spark, S.layer_path(root, "gold", "A_rain_prediction"))
    assert "A_will_rain" in sets.columns and "A_has_rain" not in sets.columns and "A_precipitation" not in sets.columns
    target = S.read_layer(spark, S.layer_path(root, "gold", "A_temp_prediction")).columns
    assert "A_temp_humidity_interaction" not in target and "A_humidity_lag1" in target
    views = S.register_layers(spark, root)
    assert "gold_weather_features" in views
    assert S.sql_query(spark, "SELECT count(*) AS n, 'gold.x' AS t FROM gold_weather_features").first() == (40, "gold.x")


def test_layers_need_a_known_name(spark, tmp_path):
    with pytest.raises(ValueError):
        S.layer_path("r", "lead", "x")
    assert S.layer_inventory(spark, str(tmp_path / "nothing")).count() == 0
    with pytest.raises(Exception):
        S.read_layer(spark, str(tmp_path / "missing"))


def test_hot_key_is_split(spark):
    """One series holds most rows: its window work is spread, and the answer is the plain one."""

    df = spark.range(6000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        F.col("id").cast("int").alias("t"),
        (F.col("id") % 17).cast("double").alias("v"),
    )
    out = X.lag_features(df, "t", ["v"], keys=["k"], chunk=250)
    plain = df.withColumns({f"v_lag{i}": F.lag("v", i).over(Window.partitionBy("k").orderBy("t")) for i in X.LAGS})
    assert sorted(map(tuple, out.select(plain.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_all_named_columns_are_correlated(spark):
    df = spark.createDataFrame([tuple(float((i * k) % 29) for k in range(1, 26)) for i in range(40)], ", ".join(f"c{k} double" for k in range(25)))
    assert relations.correlation_pairs(df, [f"c{k}" for k in range(25)], limit=None).count() == 300


def test_autocorrelation_of_series_far_apart(spark):
    rows = [(k, t, base + [0.0, 1.0][t % 2]) for k, base in (("a", 0.0), ("b", 1e9)) for t in range(200)]
    df = spark.createDataFrame(rows, "k string, t int, v double").withColumn("d", F.date_add(F.lit("2000-01-01").cast("date"), F.col("t")))
    got = {(r.k, r.lag): r.autocorrelation for r in series.autocorrelation(df, ["k"], "d", "v", 3).collect()}
    assert len(got) == 6 and all(abs(got["a", h] - got["b", h]) < 1e-6 for h in (1, 2, 3)) and got["a", 1] < -0.9


def test_a_parameter_logged_twice(spark):
    run = spark.createDataFrame([("r", "e", None, "FINISHED")], "run_id string, experiment string, ts timestamp, status string")
    params = spark.createDataFrame([("r", "lr", "0.1"), ("r", "lr", "0.2")], "run_id string, key string, value string")
    metrics = spark.createDataFrame([], "run_id string, key string, value double, step int, ts timestamp")
    assert L.run_details(run, params, metrics).first().params == {"lr": "0.2"}
    assert L.experiment_summary(run, params, metrics, "e").first().param_lr == "0.2"


def test_fine_split_ratio(spark):
    a, b = hash_split(spark.range(20_000), ["id"], 0.996)
    assert 40 <= b.count() <= 130 and a.count() + b.count() == 20_000
    with pytest.raises(ValueError):
        hash_split(spark.range(2), ["id"], 1.0)
