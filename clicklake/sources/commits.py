"""Commit records: small tables that decide which folders of a larger one count.

A job writes its rows to folders of their own and then appends one record, which Spark's commit makes appear at
once or not at all. Readers go by the records, so rows of a run that failed in between are never seen.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def committed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All records; none before the first."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def commit(spark: SparkSession, path: str, schema: StructType, **record) -> None:
    """Append one record, as one file."""
    row = spark.createDataFrame([tuple(record[name] for name in schema.names)], schema)
    row.coalesce(1).write.mode("append").parquet(path)


def _file(spark: SparkSession, path: str):
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), file


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, from its listing; none if it is missing."""
    files, folder = _file(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(folder)) if files.exists(folder) else []


def path_exists(spark: SparkSession, path: str) -> bool:
    files, file = _file(spark, path)
    return files.exists(file)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Whether there was anything to remove."""
    files, file = _file(spark, path)
    return files.delete(file, True)
