"""From raw documents to encoded training text, in stages that each write their rows.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows the one before it kept. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from clicklake.llm import byte_bpe, minhash_join, mixing, quality_gam, repeats
from clicklake.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject (score of 0.7 or more)."""
    model = quality_gam.train_quality(docs, table(spark, sf_dir, "labels"))
    return quality_gam.score_quality(docs, model, score="__score").filter(F.col("__score") >= 0.7).select(docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the document with the smallest id."""
    gone = minhash_join.near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what they repeat of earlier ones, and their new length; a null text stays null."""
    cut = repeats.without_repeats(docs, kept="__kept", as_text=True)
    cut = cut.withColumn("text", F.when(F.col("text").isNotNull(), F.col("__kept")))
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document. Rows that share an id are taken equally often."""
    times = mixing.mix(docs).groupBy(F.col("doc_id").alias("__id")).agg(F.max("times").alias("__times"))
    taken = docs.join(times.filter("__times > 0").hint("merge"), docs["doc_id"].eqNullSafe(F.col("__id")))
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "__times"))).select(docs.columns)


def encode_texts(
    spark: SparkSession, docs: DataFrame, sf_dir: str, ranks: str = public_tokenizers.path("byte_bpe_50k.tiktoken")
) -> DataFrame:
    """Token ids of each text, in place of the text; a row whose ids do not decode to its text is an error."""
    rank_table = byte_bpe.read_ranks(ranks)
    sha256 = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    encoded = byte_bpe.encode(docs.withColumn("__sha256", sha256), rank_table, public_tokenizers.PATTERN)
    same = F.sha2(byte_bpe.decoded(F.col("ids"), rank_table), 256).eqNullSafe(F.col("__sha256"))
    wrong = F.raise_error(F.concat(F.lit("ids do not decode to the text of document "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    n_tokens = F.when(same, F.size("ids").cast("bigint")).otherwise(wrong.cast("bigint"))
    return encoded.withColumn("n_tokens", n_tokens).drop("packed", "__sha256")


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("repeats", cut_repeats),
    ("mixing", mix_sources),
    ("encoding", encode_texts),
]

# The model of the first stage and the encoding of the last are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
