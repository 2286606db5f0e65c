"""Batch sinks and partition layout."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clicklake.sources.readers import NTZ_FORMAT


def rebalance(df: DataFrame, *columns: str) -> DataFrame:
    """Group rows by ``columns`` for writing, with evenly sized tasks.

    ``repartition(column)`` would send all rows of one value to one task; the rebalance hint lets
    AQE split a value that is too large and merge values that are small.
    """
    return df.hint("rebalance", *columns)


def repartition_rows(df: DataFrame, count: int) -> DataFrame:
    return df.repartition(count)


def coalesce_rows(df: DataFrame, count: int) -> DataFrame:
    return df.coalesce(count)


def append_parquet(df: DataFrame, path: str, files: int | None = None) -> None:
    """Append as Parquet; ``files`` asks for that many files, by default AQE sizes them."""
    out = df.repartition(files) if files else rebalance(df)
    out.write.mode("append").parquet(path)


def overwrite_json_partitioned(df: DataFrame, path: str, *partition_by: str) -> None:
    """Replace ``path`` with JSON files in one folder per value of the partition columns."""
    (
        rebalance(df, *partition_by)
        .write.partitionBy(*partition_by)
        .option("timestampNTZFormat", NTZ_FORMAT)
        .mode("overwrite")
        .json(path)
    )


def write_run_partition(
    df: DataFrame, path: str, files: int | None = None, append: bool = False, **partition_values
) -> None:
    """Write one run's rows as JSON below constant partition values, e.g. ``partition_date``.

    The run's own folder is written, so by default a rerun replaces its rows, also if it has none, and
    other runs stay. ``append`` adds to the folder instead. ``files`` fixes the number of files.
    """
    folder = "/".join([path, *(f"{name}={value}" for name, value in partition_values.items())])
    out = df.drop(*partition_values).repartition(files) if files else rebalance(df.drop(*partition_values))
    out.write.mode("append" if append else "overwrite").option("timestampNTZFormat", NTZ_FORMAT).json(folder)
