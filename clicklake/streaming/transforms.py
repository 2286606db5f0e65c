"""Row transforms shared by batch and streams: ``DataFrame -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from clicklake.functions.scalars import arrival_ms
from clicklake.functions.text import has_text, line_word_count, parsed_json, split_spaces


def words(df: DataFrame, line: str = "value", keep_inner_empty: bool = False) -> DataFrame:
    """One row per word of the non-empty lines, as ``word``; other columns are kept.

    With ``keep_inner_empty`` the empty parts between two adjoining spaces count as words.
    """
    others = [c for c in df.columns if c != line]
    parts = df.filter(has_text(F.col(line))).select(*others, F.explode(split_spaces(F.col(line))).alias("word"))
    return parts if keep_inner_empty else parts.filter(F.col("word") != "")


def word_counts(df: DataFrame, line: str = "value", keep_inner_empty: bool = False) -> DataFrame:
    """Occurrences of each word. On a stream: running totals, one state row per distinct word."""
    split = words(df.select(line), line, keep_inner_empty)
    return split.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def windowed_word_counts(
    df: DataFrame, time: str, width: str, delay: str, line: str = "value", keep_inner_empty: bool = False
) -> DataFrame:
    """Occurrences of each word in each window of event time: ``start, end, word, count``.

    On a stream a window is closed, and its state dropped, once a line later than its end by ``delay`` was seen;
    in append mode it is given out then. Lines that come after their window was closed are not counted.
    In batch all windows are given.
    """
    split = words(df.select(line, time).withWatermark(time, delay), line, keep_inner_empty)
    counts = split.groupBy(F.window(time, width), "word").agg(F.count(F.lit(1)).alias("count"))
    return counts.select("window.start", "window.end", "word", "count")


def line_details(df: DataFrame, line: str = "value") -> DataFrame:
    """Non-empty lines with their word count and time of arrival."""
    text = F.col(line)
    return df.filter(has_text(text)).select(
        text.alias("inputLine"),
        line_word_count(text).alias("totalWordCount"),
        arrival_ms().alias("receivedTimestamp"),
    )


CORRUPT = "_corrupt_record"


def parsed_messages(df: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """JSON messages as columns, plus the original text where it did not fit the schema.

    ``inline`` makes each message be parsed once: filters on the fields, pushed below a plain
    projection, would parse it again.
    """
    return df.select(F.inline(F.array(parsed_json(F.col(value), schema, CORRUPT))))


def valid_messages(parsed: DataFrame, required: str, strict: bool = True) -> DataFrame:
    """Messages whose ``required`` text is present.

    ``strict`` also refuses messages of which only some fields fit the schema.
    """
    kept = has_text(F.col(required))
    if strict:
        kept = kept & F.col(CORRUPT).isNull()
    return parsed.filter(kept).drop(CORRUPT)


def rejected_messages(parsed: DataFrame, required: str, strict: bool = True) -> DataFrame:
    """The other messages, with the text that did not parse."""
    kept = has_text(F.col(required))
    if strict:
        kept = kept & F.col(CORRUPT).isNull()
    return parsed.filter(~F.coalesce(kept, F.lit(False)))
