"""Finding groups too large for one task, without counting all groups.

Aggregates need none of this: Spark combines before the shuffle. Windows, group functions and outer joins do,
since they bring every row of a group to one task.

Rows are sampled by a hash of their content, so the sample is the same whenever and wherever it is taken, and
a plan may use it in several places. A group counts as large if the sample has ``BOUNDS`` rows of it, which
it has if it holds about ``max_group_rows``. The sampled rows also tell where to cut the group. At most ``LARGEST``
groups are listed, the largest ones as far as the sample shows; one that is missed costs time and changes no result.
Nothing runs before the result is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Rows of one group that one task may sort. Windows spill, so this is about time, not memory.
MAX_GROUP_ROWS = 5_000_000
# Cuts through a large group, and the number of groups that are cut: what is broadcast is at most their product.
BOUNDS = 512
LARGEST = 500

HASH = "__group_hash"
_CUTS = "__cuts"
# Of the search among the cuts, of which there are fewer than twice the first.
_STEPS = [1 << bit for bit in range(12, -1, -1)]


def group_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(key) for key in keys] or [F.lit(0)])


def large_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], max_group_rows: int, bounds: int = BOUNDS
) -> DataFrame:
    """``(hash of the keys, places to cut at)`` of groups with more than about ``max_group_rows`` rows.

    The cuts are places in ``order``, which should tell the rows of a group apart. Without keys the whole table is one
    group. Two keys with the same hash are at
    worst cut without need.
    """
    bounds = min(bounds, max_group_rows + 1)
    row = F.xxhash64(*[F.col(c) for c in [*keys, *order]]).bitwiseAND(F.lit((1 << 63) - 1))
    sample = df.select(group_hash(keys).alias(HASH), F.struct(*order).alias("place"), row.alias("row")).filter(
        F.col("row") <= ((1 << 63) - 1) // max(1, max_group_rows // bounds)
    )
    # Spark limits this window before its shuffle: no task gets more than the bounds of a group from another.
    first = sample.withColumn("n", F.row_number().over(Window.partitionBy(HASH).orderBy("row"))).filter(F.col("n") <= bounds)
    listed = first.groupBy(HASH).agg(
        F.count(F.lit(1)).alias("n"), F.max("row").alias("row"), F.sort_array(F.collect_list("place")).alias(_CUTS)
    )
    # The nearer the hashes of so many rows lie together, the more rows there are.
    return listed.filter(F.col("n") == bounds).orderBy("row", HASH).limit(LARGEST).select(HASH, _CUTS)


def _part(order: Sequence[str]) -> Column:
    """How many cuts are at or before the row, by binary search: one read of a cut for each step."""
    place = F.struct(*order)

    def passed(at: Column, step: Column) -> Column:
        return F.when(F.get(_CUTS, at + step - 1) <= place, at + step).otherwise(at)

    return F.aggregate(F.array(*[F.lit(step) for step in _STEPS]), F.lit(0), passed)


def in_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str], large: DataFrame, name: str) -> DataFrame:
    """Add the hash of the keys and the number of the part: 0 for ordinary groups, else by the cuts of the group."""
    part = F.when(F.col(_CUTS).isNull(), 0).otherwise(_part(order))
    return df.withColumn(HASH, group_hash(keys)).join(F.broadcast(large), HASH, "left").withColumn(name, part).drop(_CUTS)


def large_in_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str], large: DataFrame, name: str) -> DataFrame:
    """The same for the rows of large groups alone. Without any, Spark does not read ``df``."""
    return df.withColumn(HASH, group_hash(keys)).join(F.broadcast(large), HASH).withColumn(name, _part(order)).drop(_CUTS)


def split_by_size(df: DataFrame, keys: Sequence[str], large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the groups outside ``large``, and of those inside."""
    tagged, listed = df.withColumn(HASH, group_hash(keys)), F.broadcast(large.select(HASH))
    return tagged.join(listed, HASH, "left_anti").drop(HASH), tagged.join(listed, HASH, "left_semi").drop(HASH)


def slice_number(
    df: DataFrame, keys: Sequence[str], spread_by: Sequence[str], large: DataFrame, slices: int, name: str
) -> DataFrame:
    """Add a slice number: 0 for ordinary groups, a hash of ``spread_by`` for listed ones."""
    listed = large.select(HASH, F.lit(True).alias("__large"))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in spread_by], F.lit("slice")), F.lit(slices)).cast("int")
    return (
        df.withColumn(HASH, group_hash(keys))
        .join(F.broadcast(listed), HASH, "left")
        .withColumn(name, F.when(F.col("__large"), spread).otherwise(0))
        .drop(HASH, "__large")
    )
