"""Expressions on numbers, times and codes."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

# The review label codes.
LABEL_NAMES = {0: "negative", 1: "positive"}


def epoch_ms_time(ms: Column) -> Column:
    """Milliseconds since 1970 as a timestamp."""
    return F.timestamp_millis(ms.cast("bigint"))


def day_start(ts: Column, zone: str | None = None) -> Column:
    """Midnight of the day, zone-less.

    A zone-less input is cut as it stands. For a timestamp the day is that of the session zone, or
    of ``zone``.
    """
    if zone:
        ts = F.convert_timezone(F.current_timezone(), F.lit(zone), ts.cast("timestamp_ntz"))
    return ts.cast("date").cast("timestamp_ntz")


def decoded_label(code: Column) -> Column:
    """0 and 1 as ``negative`` and ``positive``; anything else stops the query."""
    decoded = F.when(F.lit(False), F.lit(None).cast("string"))
    for value, name in LABEL_NAMES.items():
        decoded = decoded.when(code == value, F.lit(name))
    return decoded.otherwise(
        F.raise_error(F.concat(F.lit("Unknown label: "), F.coalesce(code.cast("string"), F.lit("null"))))
    )


def date_key(day: Column) -> Column:
    """A date as ``yyyyMMdd`` text."""
    return F.date_format(day, "yyyyMMdd")


def arrival_ms() -> Column:
    """Current time in milliseconds; constant within a micro-batch."""
    return F.unix_millis(F.current_timestamp())


def whole_number(text: Column) -> Column:
    """Text as bigint, null where it is none.

    A failed ``try_cast`` costs an exception per row; the pattern keeps most of them from it.
    """
    return F.when(text.rlike(r"^\s*[-+]?[0-9]+\s*$"), text.try_cast("bigint"))


def value_or(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def flag_when(condition: Column) -> Column:
    """True where the condition holds, false elsewhere (a null condition included)."""
    return F.when(condition, True).otherwise(False)


def plus_n(n: int, returns: str = "int") -> Callable[[Column], Column]:
    """A function adding ``n``, run outside the JVM in Arrow batches. Nulls stay null.

    For user code that no built-in expression covers; adding itself is better written ``col + n``.
    """

    @F.arrow_udf(returns)
    def add(values: pa.Array) -> pa.Array:
        return pc.add_checked(values, pa.scalar(n, values.type))

    return add
