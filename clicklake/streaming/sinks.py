"""Durable streaming sinks. All need a checkpoint folder, so a stopped query can go on."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructType

from clicklake.schemas import extended
from clicklake.sources.commits import folder_names, path_exists, remove_path
from clicklake.sources.writers import rebalance

BATCH = "batch_id"


def trigger_options(interval: str | None = None, drain: bool = False) -> dict:
    """Arguments for ``trigger``: a fixed interval, or process what is there and stop."""
    if drain:
        return {"availableNow": True}
    return {"processingTime": interval} if interval else {}


def _start(writer, interval, drain) -> StreamingQuery:
    options = trigger_options(interval, drain)
    return (writer.trigger(**options) if options else writer).start()


def append_files(
    df: DataFrame, path: str, checkpoint: str, interval: str | None = None, drain: bool = False
) -> StreamingQuery:
    """Append mode into Parquet files. Spark's file log makes each row appear once."""
    writer = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _start(writer, interval, drain)


def each_batch(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    interval: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Hand each micro-batch to ``write(batch, batch_id)``; it may be called again after a failure."""
    writer = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    return _start(writer, interval, drain)


def write_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    """Replace the folder of one micro-batch, so a repeated batch leaves no duplicates.

    A batch without rows writes nothing.
    """
    if not batch.isEmpty():
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def update_files(
    df: DataFrame, path: str, checkpoint: str, interval: str | None = None, drain: bool = False
) -> StreamingQuery:
    """Update mode: each micro-batch writes the rows that changed. Read by :func:`latest_updates`."""
    return each_batch(
        df, lambda batch, batch_id: write_batch(batch, path, batch_id), checkpoint, "update", interval, drain
    )


def latest_updates(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """Current row of each key: that of the latest micro-batch which changed it."""
    base, log = _base_and_log(spark, path, schema)
    return _latest(log if base is None else base.unionByName(log), schema, keys).select(schema.names)


def _latest(log: DataFrame, schema: StructType, keys: Sequence[str]) -> DataFrame:
    values = [f.name for f in schema.fields if f.name not in keys]
    return log.groupBy(*keys).agg(*[F.max_by(v, BATCH).alias(v) for v in values], F.max(BATCH).alias(BATCH))


_BASE = re.compile(r"to=(\d+)$")


def _base_and_log(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame | None, DataFrame]:
    """The newest finished base below ``path``, if any, and the batches after it."""
    full = extended(schema, **{BATCH: IntegerType()})
    bases = sorted(int(m[1]) for name in folder_names(spark, f"{path}-base") if (m := _BASE.match(name)))
    bases = [b for b in bases if path_exists(spark, f"{path}-base/to={b}/_SUCCESS")]
    # Missing folders are an empty log: the first batches may have been folded and removed.
    log = spark.read.schema(full).parquet(path) if folder_names(spark, path) else spark.createDataFrame([], full)
    if not bases:
        return None, log
    base = spark.read.schema(full).parquet(f"{path}-base/to={bases[-1]}")
    return base, log.filter(F.col(BATCH) > bases[-1])


def compact_updates(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], keep: int = 1) -> int | None:
    """Fold all but the last ``keep`` batches of an update log into one base; returns the batch it goes to.

    The base is written beside the log and counts once Spark has marked it as complete; only then are
    folded batches and older bases removed. A run that fails at any point leaves a log that reads the
    same, and the next one goes on. A running stream may add batches meanwhile: the last ones stay.
    """
    batches = sorted(int(name.split("=")[1]) for name in folder_names(spark, path) if name.startswith(f"{BATCH}="))
    folded = batches[: max(0, len(batches) - keep)]
    if folded:
        base, log = _base_and_log(spark, path, schema)
        log = log.filter(F.col(BATCH) <= folded[-1])
        target = f"{path}-base/to={folded[-1]}"
        if not path_exists(spark, f"{target}/_SUCCESS"):
            _latest(log if base is None else base.unionByName(log), schema, keys).write.mode("overwrite").parquet(target)
        old = [f"{path}-base/{n}" for n in folder_names(spark, f"{path}-base") if n != f"to={folded[-1]}"]
        for folder in [*(f"{path}/{BATCH}={b}" for b in folded), *old]:
            remove_path(spark, folder)
    return folded[-1] if folded else None


# Parts of a folded log, and how many of a level make one of the next.
_PART = re.compile(r"level=(\d+)-from=(\d+)-to=(\d+)$")
FAN = 10


def _parts(spark: SparkSession, path: str) -> list[tuple[int, int, int]]:
    """``(first batch, last batch, level)`` of the finished parts below ``path``, in order, without those a larger one holds."""
    found = []
    for name in folder_names(spark, f"{path}-folded"):
        if (m := _PART.match(name)) and path_exists(spark, f"{path}-folded/{name}/_SUCCESS"):
            found.append((int(m[2]), int(m[3]), int(m[1])))
    return sorted(p for p in found if not any(q != p and q[0] <= p[0] and p[1] <= q[1] and q[2] > p[2] for q in found))


def _part_path(path: str, part: tuple[int, int, int]) -> str:
    return f"{path}-folded/level={part[2]}-from={part[0]}-to={part[1]}"


def _batches(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name.split("=")[1]) for name in folder_names(spark, path) if name.startswith(f"{BATCH}="))


def batch_files(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows written by :func:`write_batch`: the folded parts, and the batches after them."""
    parts = _parts(spark, path)
    last = parts[-1][1] if parts else -1
    rows = spark.createDataFrame([], schema)
    if batches := [b for b in _batches(spark, path) if b > last]:
        rows = spark.read.schema(schema).parquet(*[f"{path}/{BATCH}={b}" for b in batches])
    if parts:
        folded = spark.read.schema(schema).parquet(*[_part_path(path, p) for p in parts])
        rows = folded.unionByName(rows) if batches else folded
    return rows


def fold_batches(spark: SparkSession, path: str, schema: StructType, keep: int = 1, fan: int = FAN) -> list[tuple[int, int, int]]:
    """Fold the batch folders of an append-only log, all but the last ``keep``; returns the parts there are now.

    The batches that are not folded yet become one part, and ``fan`` parts of a level become one of the next, so
    a log of n folds has about ``fan`` parts for each power of ``fan`` in n, and a row is written as often as
    there are levels. A part counts once Spark has marked it as complete, and from then on the batches in
    it do not: one that is repeated after a crash is not read again. Folders that are not needed any more are
    removed by the *next* call, so that what was read just before a fold can still be read.

    A call that fails at any point leaves a log that reads the same. A running stream may add batches
    meanwhile. One call works on a log at a time.
    """
    parts = _parts(spark, path)
    last = parts[-1][1] if parts else -1
    batches = _batches(spark, path)
    kept = {_part_path("", p).split("/")[1] for p in parts}
    for name in folder_names(spark, f"{path}-folded"):
        if name not in kept:
            remove_path(spark, f"{path}-folded/{name}")
    for batch in batches:
        if batch <= last:
            remove_path(spark, f"{path}/{BATCH}={batch}")

    def write(rows: DataFrame, part: tuple[int, int, int]) -> None:
        rebalance(rows).write.mode("overwrite").parquet(_part_path(path, part))

    waiting = [b for b in batches if b > last]
    waiting = waiting[: max(0, len(waiting) - keep)]
    if waiting:
        part = (last + 1, waiting[-1], 0)
        write(spark.read.schema(schema).parquet(*[f"{path}/{BATCH}={b}" for b in waiting]), part)
        parts.append(part)
    level = 0
    while parts and level <= max(p[2] for p in parts):
        some = [p for p in parts if p[2] == level]
        if len(some) >= fan:
            part = (some[0][0], some[-1][1], level + 1)
            write(spark.read.schema(schema).parquet(*[_part_path(path, p) for p in some]), part)
            parts = sorted([p for p in parts if p not in some] + [part])
        level += 1
    return parts


def split_files(
    df: DataFrame,
    outputs: dict[str, Callable[[DataFrame], DataFrame]],
    checkpoint: str,
    interval: str | None = None,
    drain: bool = False,
    fold_every: int | None = None,
) -> StreamingQuery:
    """Several tables from one stream: ``{path: transform}``. The batch is computed once.

    With ``fold_every`` the tables' folders are folded after every so many batches. Read by :func:`batch_files`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for path, transform in outputs.items():
                rows = transform(batch)
                write_batch(rows, path, batch_id)
                if fold_every and batch_id % fold_every == fold_every - 1:
                    fold_batches(batch.sparkSession, path, rows.schema)
        finally:
            batch.unpersist()

    return each_batch(df, write, checkpoint, "append", interval, drain)
