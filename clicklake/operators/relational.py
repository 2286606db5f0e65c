"""Projections, filters, joins, unions and sorts with column names as parameters."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clicklake.operators.skew import HASH, MAX_GROUP_ROWS, large_groups, split_by_size
from pyspark.sql.types import StructType


# -- projections ---------------------------------------------------------------------------------


def pick(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.select(*columns)


def with_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column, or overwrite the one of that name."""
    return df.withColumn(name, value)


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def without(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.drop(*columns)


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def pick_positions(df: DataFrame, *positions: int) -> DataFrame:
    """Columns by position, counted from 0."""
    return df.select(*[df.columns[p] for p in positions])


def map_records(df: DataFrame, **fields: Column) -> DataFrame:
    """A new record per row, each field an expression on the old one."""
    return df.select(*[value.alias(name) for name, value in fields.items()])


def conformed(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns matched by name to a record type: reordered, widened, missing ones null."""
    return df.to(schema)


def flattened(df: DataFrame, *structs: str) -> DataFrame:
    """The fields of struct columns as plain columns."""
    return df.select(*[f"{s}.*" for s in structs])


# -- filters -------------------------------------------------------------------------------------


def matching(df: DataFrame, predicate: Column | str | Callable[..., Column], *columns: str) -> DataFrame:
    """Rows for which a Column, SQL text, or a named function of ``columns`` holds.

    All three end up as one Catalyst expression, so they are pushed into the scan alike.
    """
    if callable(predicate) and not isinstance(predicate, Column):
        predicate = predicate(*[F.col(c) for c in columns])
    return df.filter(predicate)


def between(df: DataFrame, column: str, low, high) -> DataFrame:
    """Both ends included."""
    return df.filter(F.col(column).between(low, high))


def one_of(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


# -- joins ---------------------------------------------------------------------------------------


def joined(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "inner",
    hot_partner: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Equi-join. Columns of both sides stay (semi and anti: of the left side only).

    No broadcast hint: Catalyst broadcasts a side whose size it knows to be small, and AQE splits
    the skewed partitions of a sort-merge join, as far as the kind of join lets it:

    - inner: either side;
    - left and right: only the side that is kept whole;
    - full: neither;
    - semi and anti: only the left side, so the right one is reduced to its distinct keys.

    Where a side that cannot be split has keys with very many rows, ``hot_partner`` looks for such keys in a sample of it
    (see :mod:`clicklake.operators.skew`). These are joined by an inner join plus the rows without a partner, which can be
    split, and all others by one plain join. Without such a key Spark drops the first part when it runs. Keys of
    different types are all joined the first way.
    """
    if how in ("left_semi", "semi", "left_anti", "anti"):
        return _by_presence(left, right, left_key, right_key, how)
    if how == "inner" or not hot_partner:
        return left.join(right, left[left_key] == right[right_key], how)
    full = how in ("full", "outer", "full_outer", "fullouter")
    wants_left, wants_right = full or how.startswith("left"), full or how.startswith("right")
    if left.schema[left_key].dataType != right.schema[right_key].dataType:
        return _inner_and_lonely(left, right, left_key, right_key, wants_left, wants_right)
    partners = [(right, right_key)] * wants_left + [(left, left_key)] * wants_right
    found = [large_groups(df, [key], df.columns, max_group_rows).select(HASH) for df, key in partners]
    hot = found[0] if len(found) == 1 else found[0].union(found[1]).distinct()
    (left, hot_left), (right, hot_right) = split_by_size(left, [left_key], hot), split_by_size(right, [right_key], hot)
    plain = left.join(right, left[left_key] == right[right_key], how)
    return plain.union(_inner_and_lonely(hot_left, hot_right, left_key, right_key, wants_left, wants_right))


def _inner_and_lonely(left, right, left_key, right_key, wants_left, wants_right):
    """An outer join as an inner join and the rows without a partner, both of which AQE can split."""
    result = left.join(right, left[left_key] == right[right_key], "inner")
    if wants_left:
        lonely = _by_presence(left, right, left_key, right_key, "left_anti")
        result = result.union(lonely.select(*left.columns, *_nulls(right)))
    if wants_right:
        lonely = _by_presence(right, left, right_key, left_key, "left_anti")
        result = result.union(lonely.select(*_nulls(left), *right.columns))
    return result


def _by_presence(left, right, left_key, right_key, how):
    """Semi or anti join against the distinct keys of the right side."""
    present = right.select(F.col(right_key).alias("__present")).distinct()
    return left.join(present, left[left_key] == present["__present"], how)


def _nulls(df):
    return [F.lit(None).cast(field.dataType).alias(field.name) for field in df.schema.fields]


def joined_keep_left_key(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner equi-join without the right side's copy of the key."""
    return left.join(right, left[left_key] == right[right_key], "inner").drop(right[right_key])


def joined_pairs(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_name: str, right_name: str
) -> DataFrame:
    """Inner equi-join that keeps both records whole, as two struct columns."""
    return left.join(right, left[left_key] == right[right_key], "inner").select(
        F.struct(*[left[c] for c in left.columns]).alias(left_name),
        F.struct(*[right[c] for c in right.columns]).alias(right_name),
    )


def enriched(facts: DataFrame, dimension: DataFrame, key: str, dimension_key: str, *columns: str) -> DataFrame:
    """Facts with attributes of their dimension row, projected to ``columns``."""
    return facts.join(dimension, facts[key] == dimension[dimension_key], "inner").select(*columns)


def lookup(df: DataFrame, table: DataFrame, key: str, table_key: str, how: str = "left") -> DataFrame:
    """Join with a table that is likely small.

    No hint: Catalyst, and AQE once the table's size in bytes is known, send it whole to every executor if
    it is below ``spark.sql.autoBroadcastJoinThreshold``, and shuffle it otherwise.
    """
    return df.join(table, df[key] == table[table_key], how)


# -- sorts and unions ----------------------------------------------------------------------------


def sorted_rows(df: DataFrame, *order: Column | str) -> DataFrame:
    """Sort by ``order``. End it in a unique column: a range shuffle cannot cut between equal rows."""
    return df.orderBy(*order)


def first_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first n rows of a stated order. Each task keeps n rows; there is no full sort."""
    return df.orderBy(*order).limit(n)


def union_all(first: DataFrame, *others: DataFrame, by_name: bool = False) -> DataFrame:
    """All rows, duplicates kept; columns matched by position unless ``by_name``."""
    for other in others:
        first = first.unionByName(other) if by_name else first.union(other)
    return first
