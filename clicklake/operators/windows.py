"""Neighbouring rows and ranks within groups, exact for groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from clicklake.operators.skew import HASH, MAX_GROUP_ROWS, in_parts, large_groups, large_in_parts


def previous_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, str],
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add columns of the previous row of the same group: ``{new name: source column}``.

    ``order`` should end in a unique column: rows equal in ``keys`` and ``order`` fall in any order,
    and stay in one task.
    """
    return _neighbour(df, keys, order, columns, False, max_group_rows)


def next_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, str],
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add columns of the next row of the same group; otherwise as :func:`previous_row`."""
    return _neighbour(df, keys, order, columns, True, max_group_rows)


def _neighbour(df, keys, order, columns, following, max_group_rows):
    """One window over groups, large ones in parts; the row at a part's edge takes its neighbour from the part beside it.

    The last (or first) rows of the parts of large groups are few; they are found by an aggregate and joined by group and part,
    as the window has dealt the rows. Where there is no large group, Spark drops that side when it runs.
    """
    large = large_groups(df, keys, order, max_group_rows)
    dealt = in_parts(df, keys, order, large, "__part").repartition(HASH, "__part")
    direction = F.desc if following else F.asc
    within = Window.partitionBy(HASH, "__part", *keys).orderBy(*[direction(c) for c in order])

    edge_of = F.min_by if following else F.max_by
    taken = F.struct(*[F.col(source).alias(new) for new, source in columns.items()])
    edges = large_in_parts(df, keys, order, large, "__part").groupBy(HASH, "__part", *keys).agg(
        edge_of(taken, F.struct(*order)).alias("edge")
    )
    beside = F.lag("edge").over(Window.partitionBy(HASH, *keys).orderBy(direction("__part")))
    # Groups whose hashes are equal share a list; each row picks its own group's.
    listed = (
        edges.select(HASH, "__part", F.struct(F.struct(*keys).alias("group"), beside.alias("row")).alias("edge"))
        .groupBy(HASH, "__part").agg(F.collect_list("edge").alias("__edges"))
    )
    own = F.get(F.filter("__edges", lambda edge: edge["group"].eqNullSafe(F.struct(*keys))), F.lit(0))["row"]
    marked = dealt.select(
        "*",
        F.lag(F.lit(True)).over(within).isNull().alias("__at_edge"),
        *[F.lag(source).over(within).alias(new) for new, source in columns.items()],
    ).join(listed, [HASH, "__part"], "left")
    return marked.select(
        *df.columns, *[F.when(F.col("__at_edge"), own[new]).otherwise(F.col(new)).alias(new) for new in columns]
    )


# Cuts through a whole table that is numbered; each row carries them while its part is found.
TABLE_CUTS = 512


def numbered_rows(
    df: DataFrame, order: Sequence[str], name: str = "position", descending: bool = False, max_part_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Add the number of each row, from 1, in the order of the whole table.

    A table with more than about ``max_part_rows`` rows is cut at sampled rows into parts, which are counted; a row's
    number is its number in its part and the rows of the parts before it. No window spans the table: the one over
    parts has at most ``TABLE_CUTS`` rows. ``order`` should end in a unique column: equal rows are numbered
    in any order, and stay in one task. Nulls come first, or last if ``descending``.
    """
    cuts = large_groups(df, [], order, max_part_rows, TABLE_CUTS)
    parts = in_parts(df, [], order, cuts, "__part")
    direction = F.desc if descending else F.asc
    before = F.sum("rows").over(Window.orderBy(direction("__part")).rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("rows")).select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*[direction(c) for c in order]))
    return parts.withColumn("__n", within).join(F.broadcast(starts), "__part").select(
        *df.columns, (F.col("__n") + F.col("__before")).alias(name)
    )


def follows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    event: str,
    first: str,
    then: str,
    flag: str = "follows",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Keep the two event kinds and flag each ``then`` that comes right after a ``first``.

    The other kinds are dropped before the neighbours are looked up, so an event of a third kind
    between the two does not break the pair.
    """
    kept = df.filter(F.col(event).isin(first, then))
    with_previous = previous_row(kept, keys, order, {"__previous": event}, max_group_rows)
    pair = (F.col(event) == then) & (F.col("__previous") == first)
    return with_previous.withColumn(flag, F.when(pair, True).otherwise(False)).drop("__previous")


def top_per_group(df: DataFrame, keys: Sequence[str], value: str, n: int) -> DataFrame:
    """Rows whose ``rank()`` by ``value``, highest first, is at most ``n`` in their group.

    Ties are kept, as rank does. A row ranks at most n exactly if it is not below the n-th value,
    so only n rows per group and task travel to find that value (Spark limits a row_number window
    before its shuffle); rows that tie, however many, are then kept by a join against one value per
    group.
    """
    ordered = Window.partitionBy(*keys).orderBy(F.desc(value))
    nth = (
        df.select(*keys, value)
        .withColumn("__n", F.row_number().over(ordered))
        .filter(F.col("__n") <= n)
        .groupBy(*[F.col(k).alias(f"__{k}") for k in keys])
        .agg(F.max(F.when(F.col("__n") == n, F.col(value))).alias("__nth"))
    )
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    # No n-th row, or a null there: every row of the group is in.
    return df.join(nth, same).filter(F.col("__nth").isNull() | (F.col(value) >= F.col("__nth"))).select(df.columns)


def ranked(df: DataFrame, keys: Sequence[str], order: Column | str, name: str = "rank") -> DataFrame:
    """Add ``rank()`` within groups. For groups known to be small, such as one row per key."""
    return df.withColumn(name, F.rank().over(Window.partitionBy(*keys).orderBy(order)))
