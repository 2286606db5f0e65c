"""Distinct viewers per channel and category, run after run over new view partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from clicklake.operators.aggregates import count_distinct
from clicklake.operators.relational import conformed, enriched
from clicklake.operators.windows import top_per_group
from clicklake.schemas import PRODUCT, PRODUCT_VIEW, VIEW_REPORT, extended
from clicklake.sources.commits import commit, committed, folder_names, remove_path
from clicklake.sources.readers import last_processed, read_json, read_partitions_after
from clicklake.sources.writers import write_run_partition

VIEW_DATE = StructField("partition_date", IntegerType())
RUN_DATE = StructField("partition_date", IntegerType())
PROCESSED_TO = StructField("processed_to", IntegerType())
MARKS = StructType([RUN_DATE, PROCESSED_TO])
# Fixed value: views up to this date are not reported.
FIRST_MARK = 20210101


def distinct_viewers(
    views: DataFrame, products: DataFrame, user: str, product: str, product_id: str, channel: str, category: str, name: str
) -> DataFrame:
    """Distinct users per channel and product category, as int."""
    viewed = enriched(views, products, product, product_id, user, channel, category)
    return count_distinct(viewed, user, channel, category, name=name, as_type="int")


def view_report(views: DataFrame, products: DataFrame, top: int | None = 3) -> DataFrame:
    """The report: the ``top`` categories by viewers of each channel, ties kept; all with None."""
    report = distinct_viewers(
        views, products, "userId", "productId", "id", "channel", "category", "distinctUserCount"
    )
    if top is not None:
        report = top_per_group(report, ["channel"], "distinctUserCount", top)
    return conformed(report, VIEW_REPORT)


def run_view_report(
    spark: SparkSession,
    views_path: str,
    products_path: str,
    report_path: str,
    run_date: int,
    top: int | None = 3,
    first_mark: int = FIRST_MARK,
    closed_before: int | None = None,
) -> int | None:
    """Report on the view partitions added since the last run; returns the new mark, None if none.

    The mark, the highest view date processed, is noted with the run date in a table of commit records, after
    the report's rows are written. A run whose views meet no product moves the mark as well. Rows count only if their
    run is noted: those of a run that failed in between are not read, and the next run removes them and
    reports their views itself.

    Days from ``closed_before`` on, by default the run date, may still get views and are left to a
    later run. A second run of a day over newer views adds to the first. The folder of the views must exist.
    One run works on a report at a time.
    """
    newest = write_report(spark, views_path, products_path, report_path, run_date, top, first_mark, closed_before)
    if newest is not None:
        commit(spark, f"{report_path}/marks", MARKS, **{RUN_DATE.name: run_date, PROCESSED_TO.name: newest})
    return newest


def write_report(
    spark: SparkSession,
    views_path: str,
    products_path: str,
    report_path: str,
    run_date: int,
    top: int | None = 3,
    first_mark: int = FIRST_MARK,
    closed_before: int | None = None,
) -> int | None:
    """The first half of :func:`run_view_report`: the rows of a run that is not noted yet, and its mark."""
    marks = committed(spark, f"{report_path}/marks", MARKS)
    runs = [tuple(row) for row in marks.collect()]  # one short record for each run there was
    drop_unfinished(spark, report_path, runs)
    mark = max((to for _, to in runs), default=first_mark)
    closed = run_date if closed_before is None else closed_before
    newest = last_processed(spark, views_path, VIEW_DATE, mark, after=mark, before=closed, required=True)
    if newest <= mark:
        return None
    views = read_partitions_after(spark, views_path, PRODUCT_VIEW, VIEW_DATE, mark)
    views = views.filter(views[VIEW_DATE.name] <= newest)
    report = view_report(views, read_json(spark, products_path, PRODUCT), top)
    write_run_partition(report, f"{report_path}/rows", **{RUN_DATE.name: run_date, PROCESSED_TO.name: newest})
    return newest


def drop_unfinished(spark: SparkSession, report_path: str, runs: list[tuple[int, int]]) -> list[str]:
    """Remove the row folders of runs that are not noted; returns their names."""
    noted = {f"{RUN_DATE.name}={day}/{PROCESSED_TO.name}={to}" for day, to in runs}
    rows = f"{report_path}/rows"
    found = [f"{day}/{to}" for day in folder_names(spark, rows) if day.startswith(RUN_DATE.name) for to in folder_names(spark, f"{rows}/{day}")]
    unfinished = [name for name in found if name not in noted]
    for name in unfinished:
        remove_path(spark, f"{rows}/{name}")
    return unfinished


def last_mark(spark: SparkSession, report_path: str, first_mark: int = FIRST_MARK) -> int:
    """The highest mark noted, ``first_mark`` before the first run."""
    marks = committed(spark, f"{report_path}/marks", MARKS)
    return marks.agg(F.coalesce(F.max(PROCESSED_TO.name), F.lit(first_mark))).first()[0]


def read_view_report(spark: SparkSession, report_path: str) -> DataFrame:
    """The rows of all runs that are noted. Before the first run there is no report to read."""
    schema = extended(VIEW_REPORT, **{RUN_DATE.name: IntegerType(), PROCESSED_TO.name: IntegerType()})
    rows = read_json(spark, f"{report_path}/rows", schema)
    return rows.join(committed(spark, f"{report_path}/marks", MARKS), MARKS.names, "left_semi").select(schema.names)
