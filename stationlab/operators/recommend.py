"""Forecast-accuracy ratings and ALS recommendations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import attach_row
from ..functions.indexing import dense_index, hash_split
from ..functions.retrieval import top_items
from ..functions.scale import durable
from . import evaluate as E
from .prepare import SEED, TRAIN_RATIO


# Id columns of the indexed ratings.
USER, ITEM = "_user", "_item"


def accuracy_of(error: Column) -> Column:
    return 1 / (1 + F.abs(error))


def station_accuracy(long: DataFrame, date_col: str, base: str | None = None, metric: str = "temp_mean") -> DataFrame:
    """How well each station foretells the base station on the same day.

    ``(date, station, actual, predicted, error, accuracy)``; base defaults to the first name.
    The base is one row per date. It is stored first, so its size is known and the other stations
    are not shuffled by date when it is small.
    """
    rows = long.filter((F.col("metric") == metric) & F.col("value").isNotNull()).select("station", date_col, "value")
    if base is None:
        d = attach_row(rows, rows.agg(F.min("station").alias("base")), "_s")
        is_base = F.col("station") == F.col("_s.base")
    else:
        d, is_base = rows, F.col("station") == base
    actual = durable(d.filter(is_base).select(date_col, F.col("value").alias("actual")))
    other = d.filter(~is_base).select(date_col, "station", F.col("value").alias("predicted"))
    error = F.col("predicted") - F.col("actual")
    return other.join(actual, date_col).select(
        date_col, "station", "actual", "predicted", error.alias("error"), accuracy_of(error).alias("accuracy")
    )


def city_accuracy(city: DataFrame) -> DataFrame:
    """Last year's value as this year's forecast: (Country, City, Year, error, accuracy)."""
    error = F.abs(F.col("AvgYearlyTemp") - F.col("PrevTemp"))
    rows = city.filter(F.col("AvgYearlyTemp").isNotNull() & F.col("PrevTemp").isNotNull())
    return rows.select("Country", "City", "Year", error.alias("error"), accuracy_of(error).alias("accuracy"))


def union_tables(*tables: DataFrame) -> DataFrame:
    """All rows of all tables, columns matched by name."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


@dataclass
class Ratings:
    """Indexed ratings with both id tables."""

    train: DataFrame
    test: DataFrame
    users: DataFrame
    items: DataFrame
    user_col: str
    item_col: str


def index_entities(df: DataFrame, user_col: str, item_col: str) -> tuple[DataFrame, DataFrame]:
    """Dense ids of users and items: (value, _user) and (value, _item)."""
    return dense_index(df, [user_col], USER), dense_index(df, [item_col], ITEM)


def prepare_ratings(
    df: DataFrame, user_col: str, item_col: str, rating_col: str, train_ratio: float = TRAIN_RATIO
) -> Ratings:
    """One mean rating per (user, item), dense int ids, hash split on the pair."""
    mean = (
        df.filter(F.col(rating_col).isNotNull() & ~F.isnan(F.col(rating_col).cast("double")))
        .groupBy(user_col, item_col)
        .agg(F.avg(rating_col).alias("rating"))
    )
    users, items = index_entities(mean, user_col, item_col)
    indexed = mean.join(users, user_col).join(items, item_col)
    triples = durable(
        indexed.select(
            user_col, item_col, F.col(USER).cast("int"), F.col(ITEM).cast("int"), F.col("rating").cast("float")
        )
    )
    train, test = hash_split(triples, [user_col, item_col], train_ratio)
    return Ratings(train, test, users, items, user_col, item_col)


def _als(rank: int = 10, max_iter: int = 10, reg_param: float = 0.01) -> ALS:
    return ALS(
        rank=rank, maxIter=max_iter, regParam=reg_param, userCol=USER, itemCol=ITEM, ratingCol="rating",
        coldStartStrategy="drop", seed=SEED,
    )


def als_train(r: Ratings, rank: int = 10, max_iter: int = 10, reg_param: float = 0.01) -> E.ModelResult:
    """Factorise the training ratings; rmse and mae on the test ratings both sides know."""
    model = _als(rank, max_iter, reg_param).fit(r.train)
    predictions = model.transform(r.test)
    metrics = E.regression_metrics(predictions, "rating").select("rmse", "mae").first().asDict()
    return E.ModelResult(model, predictions, metrics)


def als_tune(
    r: Ratings,
    ranks: Sequence[int] = (5, 10, 20),
    iters: Sequence[int] = (5, 10),
    regs: Sequence[float] = (0.01, 0.1),
    folds: int = 3,
    parallelism: int = 2,
) -> E.ModelResult:
    """Cross-validated grid search on rmse."""
    als = _als()
    grid = ParamGridBuilder().addGrid(als.rank, list(ranks)).addGrid(als.maxIter, list(iters)).addGrid(als.regParam, list(regs)).build()
    rmse = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction")
    cv = CrossValidator(estimator=als, estimatorParamMaps=grid, evaluator=rmse, numFolds=folds, parallelism=parallelism, seed=SEED)
    kept = r.train.persist()
    try:
        model = cv.fit(kept)
    finally:
        kept.unpersist()
    predictions = model.bestModel.transform(r.test)
    metrics = E.regression_metrics(predictions, "rating").select("rmse", "mae").first().asDict()
    return E.ModelResult(model, predictions, metrics, {"grid": grid})


def recommend_top_n(result: E.ModelResult, r: Ratings, n: int = 10, users: DataFrame | None = None) -> DataFrame:
    """The ``n`` best items of every user, or of ``users`` (a table with the user column), with their original names:
    (user, item, predicted_rating)."""
    model = result.model.bestModel if hasattr(result.model, "bestModel") else result.model
    wanted = model.userFactors
    if users is not None:
        ids = r.users.join(users.select(r.user_col).distinct(), r.user_col).select(F.col(USER).alias("id"))
        wanted = wanted.join(ids, "id", "left_semi")
    best = top_items(wanted, model.itemFactors, n).toDF(USER, ITEM, "_score")
    named = best.join(r.users, USER).join(r.items, ITEM)
    return named.select(r.user_col, r.item_col, F.col("_score").cast("float").cast("double").alias("predicted_rating"))
