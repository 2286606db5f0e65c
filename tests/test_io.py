"""Sources, sinks, layout and views."""

import glob

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField

from clicklake.schemas import CLICK, record
from clicklake.session import scratch_path
from clicklake.sources.readers import last_processed, read_json, read_json_inferred, read_lines, read_partitions_after
from clicklake.sources.views import save_table, session_view, shared_view
from clicklake.sources.writers import (
    append_parquet,
    coalesce_rows,
    overwrite_json_partitioned,
    repartition_rows,
    write_run_partition,
)
from conftest import rows_of

DAY = StructField("day", IntegerType())
CLICKS = [(1, 10, "view", 5), (2, 11, "favorite", 6), (3, None, None, 7)]


@pytest.fixture()
def clicks(spark):
    return spark.createDataFrame(CLICKS, CLICK)


def test_json_declared_and_inferred(spark, clicks, folder):
    clicks.write.json(f"{folder}/j")
    assert rows_of(read_json(spark, f"{folder}/j", CLICK)) == sorted(CLICKS, key=repr)
    assert read_json_inferred(spark, f"{folder}/j").columns == ["event", "productId", "timestamp", "userId"]


def test_lines(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("first line\n\nthird")
    assert rows_of(read_lines(spark, str(tmp_path))) == [("",), ("first line",), ("third",)]


def test_partitions_after_a_mark_are_pruned(spark, clicks, folder, plan_of):
    dated = clicks.withColumn("day", (F.lit(20210109) + F.col("userId")).cast("int"))
    overwrite_json_partitioned(dated, f"{folder}/p", "day")
    later = read_partitions_after(spark, f"{folder}/p", CLICK, DAY, "20210110")
    assert rows_of(later, "userId", "day") == [(2, 20210111), (3, 20210112)]
    plan = plan_of(later)
    assert "PartitionFilters: [isnotnull(day" in plan and "> 20210110" in plan
    assert later.schema["day"].dataType == IntegerType()


def test_last_processed(spark, clicks, folder):
    assert last_processed(spark, f"{folder}/p", DAY, 20210101) == 20210101
    overwrite_json_partitioned(clicks.withColumn("day", F.lit(20210111)), f"{folder}/p", "day")
    assert last_processed(spark, f"{folder}/p", DAY, 20210101) == 20210111
    assert last_processed(spark, f"{folder}/p", DAY, 20210111, after=20210111) == 20210111
    # Answered from the listing: the files can be unreadable.
    for path in glob.glob(f"{folder}/p/day=*/*.json"):
        with open(path, "w") as out:
            out.write("\x00 no json")
    assert last_processed(spark, f"{folder}/p", DAY, 20210101) == 20210111


def test_last_processed_in_an_empty_folder(spark, tmp_path):
    assert last_processed(spark, str(tmp_path), DAY, 20210101) == 20210101


def test_append_adds_and_counts_files(spark, clicks, folder):
    wide = clicks.crossJoin(spark.range(20)).drop("id")
    append_parquet(wide, f"{folder}/a", files=5)
    assert len(glob.glob(f"{folder}/a/*.parquet")) == 5
    append_parquet(clicks, f"{folder}/a")
    assert spark.read.parquet(f"{folder}/a").count() == 63


def test_overwrite_replaces_everything(spark, clicks, folder):
    filled = clicks.fillna({"event": "none"})
    overwrite_json_partitioned(filled, f"{folder}/o", "event")
    overwrite_json_partitioned(filled.filter("event = 'view'"), f"{folder}/o", "event")
    assert [p.split("/")[-1] for p in glob.glob(f"{folder}/o/event=*")] == ["event=view"]


def test_run_partition_rerun_and_append(spark, clicks, folder):
    path, schema = f"{folder}/r", record(userId=CLICK["userId"].dataType, run=IntegerType())
    rows = clicks.select("userId")
    write_run_partition(rows, path, run=1)
    write_run_partition(rows.limit(1), path, run=2)
    write_run_partition(rows, path, files=1, run=1)
    assert rows_of(read_json(spark, path, schema).groupBy("run").count()) == [(1, 3), (2, 1)]
    assert len(glob.glob(f"{path}/run=1/*.json")) == 1
    write_run_partition(rows, path, append=True, run=2)
    assert rows_of(read_json(spark, path, schema).groupBy("run").count()) == [(1, 3), (2, 4)]


def test_a_run_without_rows_clears_its_folder(spark, clicks, folder):
    path, schema = f"{folder}/r", record(userId=CLICK["userId"].dataType, run=IntegerType())
    write_run_partition(clicks.select("userId"), path, run=1)
    write_run_partition(clicks.select("userId"), path, run=2)
    write_run_partition(clicks.select("userId").limit(0), path, run=1)
    assert rows_of(read_json(spark, path, schema).groupBy("run").count()) == [(2, 3)]


def test_a_required_path_must_exist(spark, folder):
    with pytest.raises(AnalysisException):
        last_processed(spark, f"{folder}/nowhere", DAY, 20210101, required=True)


def test_open_partitions_are_left_out(spark, clicks, folder):
    dated = clicks.withColumn("day", (F.lit(20210109) + F.col("userId")).cast("int"))
    overwrite_json_partitioned(dated, f"{folder}/p", "day")
    assert last_processed(spark, f"{folder}/p", DAY, 20210101, before=20210112) == 20210111


def test_layout(spark):
    df = spark.range(100)
    wide = repartition_rows(df, 6)
    assert wide.select(F.spark_partition_id().alias("p")).distinct().count() == 6
    assert coalesce_rows(wide, 2).select(F.spark_partition_id().alias("p")).distinct().count() == 2
    assert coalesce_rows(wide, 2).count() == 100


def test_session_view(spark, clicks):
    session_view(clicks, "clicks_here")
    session_view(clicks, "clicks_here")
    with pytest.raises(AnalysisException):
        session_view(clicks, "clicks_here", replace=False)
    query = "SELECT userId FROM clicks_here WHERE timestamp BETWEEN 6 AND 7 ORDER BY timestamp"
    assert [r.userId for r in spark.sql(query).collect()] == [2, 3]
    with pytest.raises(AnalysisException):
        spark.newSession().table("clicks_here")


def test_shared_view(spark, clicks):
    name = shared_view(clicks, "clicks_everywhere")
    assert spark.newSession().table(name).count() == 3
    with pytest.raises(AnalysisException):
        shared_view(clicks, "clicks_everywhere")
    assert shared_view(clicks, "clicks_everywhere", replace=True) == name


def test_catalog_table(spark, clicks, folder):
    save_table(clicks, "clicks_saved", f"{folder}/t")
    assert spark.table("clicks_saved").count() == 3


def test_clear_scratch(spark):
    from clicklake.session import clear_scratch

    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert clear_scratch(spark) >= 1
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)


def test_layout_queries_change_the_number_of_tasks(spark):
    from clicklake.plans import source_queries
    from clicklake.session import shuffle_partitions
    from conftest import SMALL

    def tasks(name):
        return getattr(source_queries, name)(spark, SMALL).select(F.spark_partition_id().alias("p")).distinct().count()

    assert tasks("layout_repartition") == 2 * shuffle_partitions(spark)
    assert tasks("layout_coalesce") == shuffle_partitions(spark)


def test_scratch_lies_in_the_folder_of_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(root) and first != second
