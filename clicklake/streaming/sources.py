"""Streaming sources. Each gives rows with a ``value`` string, or rows of a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from clicklake.schemas import TABLES


def line_stream(spark: SparkSession, directory: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of the text files that arrive in a directory."""
    reader = spark.readStream.option("lineSep", "\n")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(directory)


def message_stream(spark: SparkSession, source: str, **options: str) -> DataFrame:
    """Messages of a streaming source with a ``value`` column, such as ``kafka``, as text.

    Option names hold dots (``kafka.bootstrap.servers``): pass them with ``**{...}``.
    """
    return spark.readStream.format(source).options(**options).load().select(F.col("value").cast("string"))


def file_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Rows of the Parquet files that arrive in a directory."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def table_stream(spark: SparkSession, base: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """A warehouse table as a stream of its files.

    The braces make the path a pattern, which Spark takes for a table in one file as well as for a
    table in a folder; a plain path must be a folder.
    """
    return file_stream(spark, f"{base}/{{{name}}}.parquet", TABLES[name], files_per_batch)
