"""Named queries over the warehouse tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from clicklake.sources.readers import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name; ``sql`` is left out where SQL cannot say it."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


def clicks_table(spark: SparkSession, base: str) -> DataFrame:
    """Events with ``k``, the product number inside ``props``."""
    return read_table(spark, base, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("bigint")
    )


def texts_table(spark: SparkSession, base: str, *columns: str) -> DataFrame:
    """Columns of the documents."""
    return read_table(spark, base, "documents").select(*columns)


# Clicks in SQL.
CLICKS_SQL = "(SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"

# Parts of a text between single spaces, empty parts at the end dropped.
PARTS_SQL = """CASE WHEN text = '' THEN [''] WHEN rtrim(text, ' ') = '' THEN CAST([] AS VARCHAR[])
     ELSE string_split(rtrim(text, ' '), ' ') END"""

# All words of all documents: with inner empty parts, and without.
ALL_PARTS_SQL = f"(SELECT doc_id, unnest({PARTS_SQL}) AS word FROM documents WHERE text <> '')"
WORDS_SQL = f"(SELECT * FROM {ALL_PARTS_SQL} WHERE word <> '')"
