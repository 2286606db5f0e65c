"""Batch sources: JSON, text, in-memory rows, partitioned directories, catalog tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from clicklake.schemas import TABLES

# Spark's JSON writer cuts zone-less timestamps to milliseconds unless told otherwise.
NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines with a declared schema: no inference pass over the data."""
    return spark.read.schema(schema).option("timestampNTZFormat", NTZ_FORMAT).json(path)


def read_json_inferred(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with the schema taken from the data (one extra pass; columns in name order)."""
    return spark.read.json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines, one row each, as ``value``."""
    return spark.read.option("lineSep", "\n").text(path)


def rows_table(spark: SparkSession, rows: Iterable[Sequence], schema: StructType | str) -> DataFrame:
    """A table from rows held by the caller."""
    return spark.createDataFrame(list(rows), schema)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A Parquet table of the warehouse; its declared schema saves the footer-reading job."""
    return spark.read.schema(TABLES[name]).parquet(f"{base}/{name}.parquet")


def read_partitions_after(
    spark: SparkSession, path: str, schema: StructType, partition: StructField, mark
) -> DataFrame:
    """A ``key=value`` directory, keeping partitions later than ``mark``.

    The partition column is declared with its type and the mark is cast to that type, so Spark
    prunes directories before it opens a file.
    """
    full = StructType(schema.fields + [partition])
    return read_json(spark, path, full).filter(
        F.col(partition.name) > F.lit(mark).cast(partition.dataType)
    )


def last_processed(
    spark: SparkSession, path: str, partition: StructField, default, after=None, before=None, required: bool = False
):
    """Highest value of a partition column below ``path``; ``default`` if there is none yet.

    Only values later than ``after`` and below ``before`` count. A folder counts even if its files hold
    no rows, so a folder that is still being filled should be kept out by ``before``.

    Reads the base path (a glob over the partition folders would lose the column) and answers from
    the directory listing: with ``metadataOnly`` on, a maximum over a partition column opens no
    file. A missing path counts as a first run, unless it is ``required``; any other failure is raised.
    """
    listing = spark.newSession()
    listing.conf.set("spark.sql.optimizer.metadataOnly", "true")
    try:
        marks = read_json(listing, path, StructType([partition]))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND" and not required:
            return default
        raise
    if after is not None:
        marks = marks.filter(F.col(partition.name) > F.lit(after).cast(partition.dataType))
    if before is not None:
        marks = marks.filter(F.col(partition.name) < F.lit(before).cast(partition.dataType))
    newest = F.coalesce(F.max(partition.name), F.lit(default).cast(partition.dataType))
    return marks.agg(newest.alias("mark")).first()["mark"]


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
