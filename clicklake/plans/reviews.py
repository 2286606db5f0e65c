"""Review sentiment: train, score in batch, score a stream."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType

from clicklake.functions.text import has_text
from clicklake.operators.reviews import fit_reviews, load_model, save_model, scored, scored_labels
from clicklake.schemas import LABELLED_REVIEW, REVIEW, extended
from clicklake.sources.readers import read_json
from clicklake.streaming.sinks import split_files
from clicklake.streaming.transforms import CORRUPT, parsed_messages, rejected_messages, valid_messages

# How often scores are written, and the columns they carry.
SCORE_INTERVAL = "2 seconds"
# Batches after which the folders of scores and rejects are folded: about half an hour.
FOLD_EVERY = 1000
REJECTED_REVIEW = extended(REVIEW, **{CORRUPT: StringType()})
REVIEW_IDS = ("customerId", "productId", "reviewId", "reviewDate")


def train_reviews(spark: SparkSession, reviews_path: str, model_path: str) -> PipelineModel:
    """Fit on labelled reviews and save the model as the latest version below ``model_path``."""
    model = fit_reviews(read_json(spark, reviews_path, LABELLED_REVIEW))
    save_model(model, model_path)
    return model


def score_reviews(spark: SparkSession, reviews_path: str, model_path: str) -> DataFrame:
    """Reviews of a file with all columns of the saved model; reviews without text are left out."""
    reviews = read_json(spark, reviews_path, REVIEW).filter(has_text(F.col("reviewBody")))
    return scored(reviews, load_model(model_path))


def score_messages(messages: DataFrame, model: PipelineModel) -> DataFrame:
    """Valid review messages with their decoded prediction; for batch and stream."""
    valid = valid_messages(parsed_messages(messages, REVIEW), "reviewBody")
    return scored_labels(valid, model, *REVIEW_IDS)


def start_scoring(
    messages: DataFrame,
    model: PipelineModel,
    scores_path: str,
    rejects_path: str,
    checkpoint: str,
    interval: str | None = SCORE_INTERVAL,
    drain: bool = False,
    fold_every: int | None = FOLD_EVERY,
) -> StreamingQuery:
    """Score a stream of review messages; those that cannot be scored go to a table of their own.

    Both are read by :func:`clicklake.streaming.sinks.batch_files`, as their folders are folded from time to time.
    """
    outputs = {
        scores_path: lambda batch: scored_labels(valid_messages(batch, "reviewBody"), model, *REVIEW_IDS),
        rejects_path: lambda batch: rejected_messages(batch, "reviewBody"),
    }
    return split_files(parsed_messages(messages, REVIEW), outputs, checkpoint, interval, drain, fold_every)
