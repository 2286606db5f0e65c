"""Helpers that the operators share: tables, text as bytes, hashes, the scratch folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from clicklake.session import scratch_path

# Text that one step of a task holds as arrays; a longer single text is a step of its own.
STEP_BYTES = 2 << 20

# White space of the word rule: space, and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

MASK = (1 << 64) - 1


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written below the shared scratch folder and read again: lineage ends here."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column is called so (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def steps(batches: Iterator[pa.RecordBatch], column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``limit`` bytes of text each, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, starts, ends = text_bytes(batch.column(batch.schema.get_field_index(column)))
        total = np.cumsum(ends - starts)
        begin = 0
        while begin < batch.num_rows:
            before = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, before + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each starts and ends in them; null is empty."""
    if pa.types.is_string(texts.type) or pa.types.is_binary(texts.type):
        kind = np.int32
    elif pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
        kind = np.int64
    else:
        raise TypeError(f"texts expected, not {texts.type}")
    if texts.null_count:
        texts = pc.fill_null(texts, pa.scalar("", texts.type))
    _, offsets, data = texts.buffers()
    if offsets is None or not len(texts):
        none = np.zeros(len(texts), np.int64)
        return np.zeros(0, np.uint8), none, none
    at = np.frombuffer(offsets, kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize).astype(np.int64)
    held = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    at -= at[0]
    return held, at[:-1], at[1:]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finaliser of splitmix64)."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def seeded(seed: int, size: int) -> np.ndarray:
    """``size`` fixed 64-bit numbers of a seed."""
    return mixed(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mixed(np.array([seed], np.uint64)))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal integer ``keys`` of batches sorted by them; a run may cross batches."""
    held: list[pa.RecordBatch] = []

    def cut(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        for key in keys:
            values = table.column(key).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks()
        begin = 0
        for end in cut(table).tolist():
            yield table.slice(begin, end - begin)
            begin = end
        held = table.slice(begin).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def map_steps(
    df: DataFrame,
    text: str,
    function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch],
    schema: StructType | str,
) -> DataFrame:
    """``mapInArrow`` over slices whose text is bounded in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, text):
            made = function(step)
            if isinstance(made, pa.RecordBatch):
                yield made
            else:
                yield from made

    return df.mapInArrow(run, schema)
