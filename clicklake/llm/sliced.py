"""Rows in the order of their groups, cut into slices of even size: one group may span many of them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame

from clicklake.session import shuffle_partitions


def slices(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The rows dealt by ranges of ``order`` and sorted by it within each range.

    A range shuffle cuts by rows, so a group that holds a third of them takes a third of the tasks. Only rows
    equal in all of ``order`` stay together.
    """
    return df.repartitionByRange(shuffle_partitions(df.sparkSession), *order).sortWithinPartitions(*order)


def groups(batches: Iterator[pa.RecordBatch], key: str, kinds: dict[str, pa.DataType]) -> Iterator[tuple[object, bool, dict[str, list]]]:
    """``(key, begins, columns)`` for each run of equal keys in each batch, columns as Python lists.

    ``begins`` is False where the run goes on from the batch before. ``kinds`` is filled with the columns' types.
    """
    last: object = groups
    for batch in batches:
        kinds.update(zip(batch.schema.names, batch.schema.types))
        columns = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
        keys = columns[key]
        begin, n = 0, len(keys)
        while begin < n:
            value = keys[begin]
            end = begin + 1
            while end < n and keys[end] == value:
                end += 1
            yield value, value != last or last is groups, {name: values[begin:end] for name, values in columns.items()}
            last, begin = value, end


def batch_of(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    """Rows as a batch with these columns."""
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))
