"""Arbitrary code over the rows of a group."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from clicklake.operators.skew import MAX_GROUP_ROWS, large_groups, slice_number
from clicklake.session import shuffle_partitions

GroupFunction = Callable[[tuple, Iterator[pd.DataFrame]], pd.DataFrame]


def map_groups(
    df: DataFrame,
    keys: Sequence[str],
    function: GroupFunction,
    schema: StructType | str,
    spread_by: Sequence[str],
    merge: dict[str, Column],
    max_group_rows: int = MAX_GROUP_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """One record per group, made by Python code that reads the group in batches.

    ``function(key, batches)`` returns a frame with the keys and its results. A group with more
    than ``max_group_rows`` rows is read in slices, rows with equal ``spread_by`` values together;
    ``merge`` joins the records of a group's slices with built-in aggregates. So the function must
    be one whose results over such slices merge, like a distinct count spread by what it counts.
    Use a built-in aggregate wherever there is one.

    Large groups are looked for in ``df``, or in ``sizes`` if that is cheaper to compute and has at
    least as many rows per group.
    """
    counted = df if sizes is None else sizes
    large = large_groups(counted, keys, [c for c in counted.columns if c not in keys] or list(keys), max_group_rows)
    sliced = slice_number(df, keys, spread_by, large, shuffle_partitions(df.sparkSession), "__slice")

    def per_slice(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield function(key[:-1], batches)

    records = sliced.groupBy(*keys, "__slice").applyInPandas(per_slice, schema)
    return records.groupBy(*keys).agg(*[value.alias(name) for name, value in merge.items()])


def distinct_in_groups(
    df: DataFrame, keys: Sequence[str], column: str, name: str, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Distinct values per group through :func:`map_groups`, as int.

    Duplicates are removed by Spark before any row reaches Python, so the function only counts.
    """
    records = StructType([*[df.schema[key] for key in keys], StructField(name, LongType())])

    def count_values(key: tuple, batches: Iterator[pd.DataFrame]) -> pd.DataFrame:
        values = sum(int(batch[column].notna().sum()) for batch in batches)
        return pd.DataFrame([[*key, values]], columns=[*keys, name])

    return map_groups(
        df.select(*keys, column).distinct(),
        keys,
        count_values,
        records,
        spread_by=[column],
        merge={name: F.sum(name).cast("int")},
        max_group_rows=max_group_rows,
        sizes=df.select(*keys, column),
    )
