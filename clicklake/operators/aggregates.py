"""Group and whole-table aggregates. All combine before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clicklake.functions.scalars import day_start


def count_rows(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Rows per group, or of the whole table without keys."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_present(df: DataFrame, column: str, *keys: str, name: str = "count") -> DataFrame:
    """Rows per group in which ``column`` is not null."""
    return df.groupBy(*keys).agg(F.count(column).alias(name))


def sum_avg_count(df: DataFrame, column: str, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum(column).alias("sum"), F.avg(column).alias("avg"), F.count(F.lit(1)).alias("count")
    )


def count_distinct(df: DataFrame, column: str, *keys: str, name: str, as_type: str = "bigint") -> DataFrame:
    """Distinct values per group.

    Spark shuffles first on (keys, column), then counts, so a large group is spread over its
    values and no set of values is held in memory.
    """
    return df.groupBy(*keys).agg(F.count_distinct(column).cast(as_type).alias(name))


def reduce_by_key(df: DataFrame, keys: Sequence[str], **merged: Column) -> DataFrame:
    """Values of each key merged by associative aggregates."""
    return df.groupBy(*keys).agg(*[value.alias(name) for name, value in merged.items()])


def whole(df: DataFrame, **values: Column) -> DataFrame:
    """One row of aggregates over the whole table."""
    return df.agg(*[value.alias(name) for name, value in values.items()])


def summary(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, least and greatest value, typed."""
    return df.agg(
        F.count(column).alias("count"),
        F.mean(column).alias("mean"),
        F.stddev_samp(column).alias("stddev"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )


def summary_text(df: DataFrame, column: str) -> DataFrame:
    """The same as rows of text: ``summary`` and the column."""
    return df.describe(column)


def covariance(df: DataFrame, a: str, b: str) -> DataFrame:
    """Sample covariance."""
    return df.agg(F.covar_samp(a, b).alias("covariance"))


def correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson correlation."""
    return df.agg(F.corr(a, b).alias("correlation"))


def daily_event_count(
    df: DataFrame, event: str, kind: str, ts: str, user: str, name: str = "total", zone: str | None = None
) -> DataFrame:
    """Events of one kind per day and user, most active first."""
    return (
        df.filter(F.col(event) == kind)
        .groupBy(day_start(F.col(ts), zone).alias("day"), user)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.desc(name), "day", user)
    )
