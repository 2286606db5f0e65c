"""Review sentiment: tokens, hashed term counts, logistic regression."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from clicklake.functions.scalars import decoded_label
from clicklake.functions.text import has_text, split_tokens
from clicklake.sources.commits import commit, committed, folder_names, remove_path

# The model settings.
FEATURES = 25
ITERATIONS = 10
REGULARISATION = 0.001


def tokens(df: DataFrame, text: str, into: str = "words") -> DataFrame:
    """Lower-case tokens between white space, rows without text left out.

    The tokens of Spark's ``Tokenizer``, by built-in expressions; the model itself uses that stage,
    as it has to be saved with it.
    """
    return df.filter(F.col(text).isNotNull()).withColumn(into, split_tokens(F.col(text)))


def token_counts(df: DataFrame, text: str) -> DataFrame:
    """Occurrences of each token.

    The split stands inside ``explode``: from a column, Spark would infer a filter on its size and
    split the text again for that.
    """
    split = df.filter(F.col(text).isNotNull()).select(F.explode(split_tokens(F.col(text))).alias("word"))
    return split.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def term_counts(df: DataFrame, words: str, into: str = "features", buckets: int = FEATURES) -> DataFrame:
    """Token counts hashed into a fixed number of buckets."""
    return HashingTF(inputCol=words, outputCol=into, numFeatures=buckets).transform(df)


def vector_sum(vector: str):
    """Sum of a vector column's entries."""
    return F.aggregate(vector_to_array(F.col(vector)), F.lit(0.0), lambda total, x: total + x)


def review_pipeline(text: str = "reviewBody", label: str = "label") -> Pipeline:
    return Pipeline(
        stages=[
            Tokenizer(inputCol=text, outputCol="words"),
            HashingTF(inputCol="words", outputCol="features", numFeatures=FEATURES),
            LogisticRegression(labelCol=label, maxIter=ITERATIONS, regParam=REGULARISATION),
        ]
    )


def fit_reviews(reviews: DataFrame, text: str = "reviewBody", label: str = "label") -> PipelineModel:
    """Fit on the reviews that have a text and a label, reading those two columns once.

    The classifier goes over its input many times. What it needs, a short vector and a label per
    review, is kept while it is fitted, so the texts are read and split only once.
    """
    usable = reviews.filter(has_text(F.col(text)) & F.col(label).isNotNull()).select(text, label)
    *preparing, classifier = review_pipeline(text, label).getStages()
    prepared = PipelineModel(preparing).transform(usable).select("features", label)
    prepared.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return PipelineModel([*preparing, classifier.fit(prepared)])
    finally:
        prepared.unpersist()


def split_reviews(reviews: DataFrame, key: str, held_out: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows by a hash of the review id: the same split on every run."""
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(10_000))
    kept_out = F.coalesce(bucket < int(held_out * 10_000), F.lit(False))
    return reviews.filter(~kept_out), reviews.filter(kept_out)


MODELS = StructType([StructField("version", IntegerType())])


def model_versions(spark: SparkSession, path: str) -> list[int]:
    """The versions of a model that count, oldest first; one short record for each save there was."""
    noted = {row.version for row in committed(spark, f"{path}/finished", MODELS).collect()}
    there = {int(name.split("=")[1]) for name in folder_names(spark, f"{path}/versions")}
    return sorted(noted & there)


def save_model(model: PipelineModel, path: str, keep: int = 3) -> int:
    """Save a model as a new version below ``path``; returns its number.

    A version counts once it is noted, after all its files, so whoever loads meanwhile gets the one before, whole.
    The last ``keep`` versions stay for readers that hold on to one. One save works on a path at a time.
    """
    spark = SparkSession.active()
    noted = [row.version for row in committed(spark, f"{path}/finished", MODELS).collect()]
    version = max(noted, default=0) + 1
    # Overwrites what a save that failed has left under this number.
    model.write().overwrite().save(f"{path}/versions/version={version}")
    commit(spark, f"{path}/finished", MODELS, version=version)
    for old in model_versions(spark, path)[:-keep]:
        remove_path(spark, f"{path}/versions/version={old}")
    return version


def load_model(path: str, version: int | None = None) -> PipelineModel:
    """A saved model, by default the latest version that counts."""
    if version is None:
        versions = model_versions(SparkSession.active(), path)
        if not versions:
            raise FileNotFoundError(f"no model below {path}")
        version = versions[-1]
    return PipelineModel.load(f"{path}/versions/version={version}")


def scored(df: DataFrame, model: PipelineModel) -> DataFrame:
    """All columns of the model, batch or stream. Rows must have a text."""
    return model.transform(df)


def scored_labels(df: DataFrame, model: PipelineModel, *keep: str) -> DataFrame:
    """The ``keep`` columns and the prediction as ``negative`` or ``positive``."""
    return scored(df, model).select(*keep, decoded_label(F.col("prediction").cast("int")).alias("prediction"))
