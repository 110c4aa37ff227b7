"""Shared preparation of training data."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.columns import require
from ..functions.indexing import hash_split
from ..functions.scale import durable

# Split and seed of all trainers.
TRAIN_RATIO = 0.8
SEED = 42


@dataclass
class Prepared:
    """Train and test rows with a ``features`` vector and a numeric label."""

    train: DataFrame
    test: DataFrame
    label_col: str
    feature_cols: list[str]
    stages: PipelineModel
    features_col: str = "features"
    weight_col: str | None = None

    @contextmanager
    def kept(self) -> Iterator[Prepared]:
        """Keep both sides in executor memory and disk while several fits or metrics read them."""
        for df in (self.train, self.test):
            df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            yield self
        finally:
            for df in (self.train, self.test):
                df.unpersist()


def assemble_features(df: DataFrame, feature_cols: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vector; rows with a missing feature are dropped."""
    require(df, feature_cols)
    return VectorAssembler(inputCols=list(feature_cols), outputCol=out, handleInvalid="skip").transform(df)


def index_labels(df: DataFrame, label_col: str, out: str | None = None) -> DataFrame:
    """Numeric index of a text label: most frequent first, ties alphabetical; unseen labels get their own index."""
    out = out or f"{label_col}_index"
    return StringIndexer(inputCol=label_col, outputCol=out, handleInvalid="keep").fit(df).transform(df)


def split_train_test(
    df: DataFrame, keys: Sequence[str] = (), train_ratio: float = TRAIN_RATIO, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Hash split on ``keys``; without keys Spark's seeded random split (depends on row placement)."""
    if keys:
        return hash_split(df, keys, train_ratio)
    train, test = df.randomSplit([train_ratio, 1 - train_ratio], seed=seed)
    return train, test


def prepare_classification(
    df: DataFrame, feature_cols: Sequence[str], label_col: str, keys: Sequence[str] = (), train_ratio: float = TRAIN_RATIO
) -> Prepared:
    """Split, index the label (text) on the training side only, and assemble."""
    require(df, [*feature_cols, label_col])
    rows = df.filter(F.col(label_col).isNotNull())
    stages: list = []
    label = label_col
    if isinstance(df.schema[label_col].dataType, T.StringType):
        label = f"{label_col}_index"
        stages.append(StringIndexer(inputCol=label_col, outputCol=label, handleInvalid="keep"))
    else:
        label = f"{label_col}_index"
        rows = rows.withColumn(label, F.col(label_col).cast("double"))
    stages.append(VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="skip"))
    train, test = split_train_test(rows, keys, train_ratio)
    fitted = Pipeline(stages=stages).fit(train)

    def apply(rows: DataFrame) -> DataFrame:
        # plain numbers: the column's metadata would add a class for labels never seen in training
        return fitted.transform(rows).withColumn(label, F.col(label) + F.lit(0.0))

    return Prepared(apply(train), apply(test), label, list(feature_cols), fitted)


def prepare_regression(
    df: DataFrame, feature_cols: Sequence[str], label_col: str, keys: Sequence[str] = (), train_ratio: float = TRAIN_RATIO
) -> Prepared:
    """Split and assemble; rows without a label are dropped."""
    require(df, [*feature_cols, label_col])
    rows = df.filter(F.col(label_col).isNotNull()).withColumn("label", F.col(label_col).cast("double"))
    train, test = split_train_test(rows, keys, train_ratio)
    fitted = Pipeline(stages=[VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="skip")]).fit(train)
    return Prepared(fitted.transform(train), fitted.transform(test), "label", list(feature_cols), fitted)


def prepare_counted(
    df: DataFrame, feature_cols: Sequence[str], label_cols: Sequence[str], keys: Sequence[str] = (), train_ratio: float = TRAIN_RATIO
) -> dict[str, Prepared]:
    """``prepare_regression`` for several labels: every row is read once, rows alike become one whose ``weight`` is their number."""
    require(df, [*feature_cols, *label_cols])
    assembler = VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="skip")
    count = F.count("*").cast("double").alias("weight")
    sides = [durable(side.groupBy(*feature_cols, *label_cols).agg(count)) for side in split_train_test(df, keys, train_ratio)]
    out = {}
    for name in label_cols:
        rows = [s.filter(F.col(name).isNotNull()).withColumn("label", F.col(name).cast("double")) for s in sides]
        fitted = Pipeline(stages=[assembler]).fit(rows[0])
        out[name] = Prepared(fitted.transform(rows[0]), fitted.transform(rows[1]), "label", list(feature_cols), fitted, weight_col="weight")
    return out


def prepare_clustering(df: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """Add ``features`` and ``scaledFeatures`` (zero mean, unit deviation)."""
    require(df, feature_cols)
    stages = [
        VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="skip"),
        StandardScaler(inputCol="features", outputCol="scaledFeatures", withMean=True, withStd=True),
    ]
    return Pipeline(stages=stages).fit(df).transform(df)
