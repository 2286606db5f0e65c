"""Streams of text lines: running word counts and line details."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from clicklake.schemas import WORD_COUNT
from clicklake.streaming.sinks import append_files, latest_updates, update_files
from clicklake.streaming.transforms import line_details, windowed_word_counts, word_counts

# Fixed value: how often line details are written.
LINE_INTERVAL = "5 seconds"
# Windows of event time, and how late a line may be.
WINDOW, DELAY = "1 hour", "10 minutes"


def start_word_count(
    lines: DataFrame, path: str, checkpoint: str, interval: str | None = None, drain: bool = False, line: str = "value"
) -> StreamingQuery:
    """Running word counts of a stream, as updates; inner empty parts count as words."""
    return update_files(word_counts(lines, line, keep_inner_empty=True), path, checkpoint, interval, drain)


def read_word_count(spark, path: str) -> DataFrame:
    return latest_updates(spark, path, WORD_COUNT, ["word"])


def start_windowed_word_count(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    time: str,
    width: str = WINDOW,
    delay: str = DELAY,
    interval: str | None = None,
    drain: bool = False,
    line: str = "value",
) -> StreamingQuery:
    """Word counts of a stream for each window of event time, written when a window is closed.

    State is bounded by the words of the windows that are open, unlike that of :func:`start_word_count`.
    :func:`late_words` tells how much came too late.
    """
    counts = windowed_word_counts(lines, time, width, delay, line, keep_inner_empty=True)
    return append_files(counts, path, checkpoint, interval, drain)


def late_words(query: StreamingQuery) -> int:
    """How many counts of single batches the stream has left out as their window was closed, by the progress it keeps."""
    return sum(int(state["numRowsDroppedByWatermark"]) for batch in query.recentProgress for state in batch["stateOperators"])


def start_line_details(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = LINE_INTERVAL,
    drain: bool = False,
    line: str = "value",
) -> StreamingQuery:
    """Word count and arrival time of each line of a stream. Rows never change: append mode."""
    return append_files(line_details(lines, line), path, checkpoint, interval, drain)
