"""Latest version of each record, and merging change records into a snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, key: str, version: str, tie: Sequence[str] | None = None) -> DataFrame:
    """The row with the highest ``version`` of each key.

    Equal versions are decided by ``tie``, by default all other columns, highest first, so the
    result does not depend on the order of reading. Spark limits a row_number window to one row per
    key and task before its shuffle, so many versions of one key do not meet in one task.
    """
    if tie is None:
        tie = [c for c in df.columns if c not in (key, version)]
    newest = Window.partitionBy(key).orderBy(F.desc_nulls_last(version), *[F.desc_nulls_last(c) for c in tie])
    return df.withColumn("__n", F.row_number().over(newest)).filter(F.col("__n") == 1).drop("__n")


def merged_snapshot(
    snapshot: DataFrame, changes: DataFrame, key: str, version: str, tie: Sequence[str] | None = None
) -> DataFrame:
    """A snapshot (one row per key) with change records applied.

    Changes are first reduced to the latest per key. A change replaces the snapshot row unless it
    is older; on equal versions the change wins. Keys new to the snapshot are added.

    While the changes are few, all joins have a small side that Spark can broadcast, and the
    snapshot is read in place without a shuffle.
    """
    columns = snapshot.columns
    newest = latest_per_key(changes.select(columns), key, version, tie)
    arriving = newest.select(*[F.col(c).alias(f"__new_{c}") for c in columns], F.lit(True).alias("__found"))
    newer = F.col("__found") & (
        F.col(version).isNull() | (F.col(f"__new_{version}") >= F.col(version))
    )
    updated = snapshot.join(arriving, F.col(key).eqNullSafe(F.col(f"__new_{key}")), "left").select(
        *[F.when(newer, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    )
    changed = newest.select(F.col(key).alias("__changed"))
    existing = (
        snapshot.select(F.col(key).alias("__existing"))
        .join(changed, F.col("__existing").eqNullSafe(F.col("__changed")), "left_semi")
    )
    added = newest.join(existing, F.col(key).eqNullSafe(F.col("__existing")), "left_anti")
    return updated.unionByName(added)
