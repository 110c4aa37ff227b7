"""From raw documents to a training mix: five stages over the documents table.

language -> near_duplicates -> repeats -> benchmark -> mix. Each stage takes (spark, docs, sf_dir) and returns a DataFrame;
:func:`run` writes it as Parquet in the shared folder and reads it again for the next. All stages but the last return the
columns of documents. There is no SQL twin (a trained network and 64-bit hashes decide); tests/llm holds a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationlab.functions.scale import scratch_path
from stationlab.llm import decontaminate, language, mixing, recompression, simhash
from stationlab.llm.common import residue, table

#: Texts whose best language has less than this probability are rejected, as are texts without a letter.
MIN_SCORE = 0.3
#: Texts with this Jaccard similarity of their five-word shingles, or more, are near duplicates.
MIN_SIMILARITY = 0.8


def keep_told_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told. The network learns from four fifths of the labelled rows."""
    net = language.fit_language(docs.filter(residue(F.col("doc_id"), 5) != 0))
    told = docs.select(F.struct(*docs.columns).alias("row"), language.language_of(net, F.col("text")).alias("told"))
    return told.filter((F.col("told.lang_pred") != language.UNDETERMINED) & (F.col("told.score") >= MIN_SCORE)).select("row.*")


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by five-word shingles."""
    return simhash.drop_near_duplicates(docs, size=5, min_similarity=MIN_SIMILARITY)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-word windows of smaller documents; texts that lose every word go."""
    return recompression.drop_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover less than a twentieth."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: rows by repetition."""
    return mixing.mix(docs)


STAGES = [
    ("language", keep_told_languages),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("repeats", drop_repeats),
    ("benchmark", drop_contaminated),
    ("mix", mix_sources),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
