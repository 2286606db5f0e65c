"""Queries that go through a source, a sink, a layout change or a named view."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField

from clicklake.functions.scalars import date_key
from clicklake.operators.relational import lookup
from clicklake.plans.registry import query
from clicklake.schemas import TABLES
from clicklake.session import scratch_path, shuffle_partitions
from clicklake.sources.readers import (
    NTZ_FORMAT,
    last_processed,
    read_catalog_table,
    read_json,
    read_json_inferred,
    read_lines,
    read_partitions_after,
    read_table,
    rows_table,
)
from clicklake.sources.views import save_table, session_view, shared_view
from clicklake.sources.writers import (
    append_parquet,
    coalesce_rows,
    overwrite_json_partitioned,
    repartition_rows,
    write_run_partition,
)

EVENT_DATE = StructField("event_date", IntegerType())
RUN_DATE = StructField("partition_date", IntegerType())


def _events_by_date(spark, base):
    """Events as JSON in one folder per day; returns the path."""
    path = scratch_path(spark, "events")
    dated = read_table(spark, base, "events").withColumn("event_date", date_key(F.col("ts")).cast("int"))
    overwrite_json_partitioned(dated, path, "event_date")
    return path


@query("SELECT * FROM events")
def src_json_roundtrip(spark, base):
    path = scratch_path(spark, "json")
    read_table(spark, base, "events").write.option("timestampNTZFormat", NTZ_FORMAT).json(path)
    return read_json(spark, path, TABLES["events"])


@query(
    """SELECT c_acctbal, c_custkey, c_mktsegment, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey
       FROM customer"""
)
def src_json_inferred(spark, base):
    path = scratch_path(spark, "inferred")
    read_table(spark, base, "customer").write.json(path)
    return read_json_inferred(spark, path)


@query("SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def src_text_lines(spark, base):
    path = scratch_path(spark, "lines")
    read_table(spark, base, "documents").select("text").write.text(path)
    return read_lines(spark, path)


@query(
    """SELECT n.activity, count(*) AS n_events
       FROM events JOIN (VALUES ('view', 'browse'), ('click', 'browse'), ('purchase', 'buy'),
                                ('signup', 'account'), ('error', 'trouble')) AS n(event_type, activity) USING (event_type)
       GROUP BY n.activity"""
)
def src_inline_rows(spark, base):
    names = rows_table(
        spark,
        [("view", "browse"), ("click", "browse"), ("purchase", "buy"), ("signup", "account"), ("error", "trouble")],
        "kind string, activity string",
    )
    named = lookup(read_table(spark, base, "events"), names, "event_type", "kind", how="inner")
    return named.groupBy("activity").agg(F.count(F.lit(1)).alias("n_events"))


@query(
    """SELECT *, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS event_date FROM events
       WHERE ts >= TIMESTAMP '2024-01-16'"""
)
def src_partitions_after(spark, base):
    path = _events_by_date(spark, base)
    return read_partitions_after(spark, path, TABLES["events"], EVENT_DATE, "20240115")


@query(
    """SELECT max(CAST(strftime(ts, '%Y%m%d') AS INTEGER)) AS last_date, 20210101 AS first_run FROM events"""
)
def src_last_partition(spark, base):
    last = last_processed(spark, _events_by_date(spark, base), EVENT_DATE, 20210101)
    first = last_processed(spark, scratch_path(spark, "absent"), EVENT_DATE, 20210101)
    return rows_table(spark, [(last, first)], "last_date int, first_run int")


@query("SELECT * FROM orders")
def sink_parquet_append(spark, base):
    path = scratch_path(spark, "append")
    orders = read_table(spark, base, "orders")
    append_parquet(orders.filter("o_orderstatus = 'F'"), path)
    append_parquet(orders.filter("o_orderstatus <> 'F'"), path)
    return spark.read.schema(TABLES["orders"]).parquet(path)


@query("SELECT * FROM orders")
def sink_json_partitioned(spark, base):
    path = scratch_path(spark, "partitioned")
    orders = read_table(spark, base, "orders")
    overwrite_json_partitioned(orders.filter("o_orderstatus = 'F'"), path, "o_orderstatus")
    overwrite_json_partitioned(orders, path, "o_orderstatus")
    return read_json(spark, path, TABLES["orders"]).select(TABLES["orders"].names)


@query(
    """SELECT o_orderpriority, count(*) AS n_orders, 20240131 AS partition_date FROM orders GROUP BY 1
       UNION ALL
       SELECT o_orderpriority, count(*), 20240201 FROM orders WHERE o_orderstatus = 'O' GROUP BY 1"""  # none for 20240202
)
def sink_run_date(spark, base):
    path = scratch_path(spark, "runs")
    orders = read_table(spark, base, "orders")

    def run(rows, day):
        report = rows.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"))
        write_run_partition(report, path, partition_date=day)

    run(orders, 20240131)
    run(orders.filter("o_orderstatus = 'O'"), 20240201)
    run(orders, 20240131)  # a rerun replaces its own rows only
    run(orders, 20240202)
    run(orders.limit(0), 20240202)  # also by none
    return read_json(
        spark, path, rows_table(spark, [], "o_orderpriority string, n_orders bigint, partition_date int").schema
    )


@query("SELECT * FROM lineitem")
def layout_repartition(spark, base):
    return repartition_rows(read_table(spark, base, "lineitem"), 2 * shuffle_partitions(spark))


@query("SELECT * FROM lineitem")
def layout_coalesce(spark, base):
    """Half as many tasks as the shuffle before it leaves."""
    spread = repartition_rows(read_table(spark, base, "lineitem"), 2 * shuffle_partitions(spark))
    return coalesce_rows(spread, shuffle_partitions(spark))


@query(
    """SELECT * FROM orders
       WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-01-01'"""
)
def view_session(spark, base):
    session_view(read_table(spark, base, "orders"), "clicklake_orders")
    return spark.sql(
        """SELECT * FROM clicklake_orders
           WHERE o_orderdate BETWEEN TIMESTAMP_NTZ '1997-01-01' AND TIMESTAMP_NTZ '1998-01-01'
           ORDER BY o_orderdate, o_orderkey"""
    )


@query("SELECT event_type, count(*) AS n_events FROM events GROUP BY event_type")
def view_global(spark, base):
    name = shared_view(read_table(spark, base, "events"), f"clicklake_events_{uuid.uuid4().hex}")
    counts = spark.newSession().sql(f"SELECT event_type, count(*) AS n_events FROM {name} GROUP BY event_type")
    spark.catalog.dropGlobalTempView(name.split(".")[1])  # the plan above holds what the view named
    return counts


@query("SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY o_orderstatus")
def view_catalog_table(spark, base):
    name = f"clicklake_orders_{uuid.uuid4().hex}"
    save_table(read_table(spark, base, "orders"), name, scratch_path(spark, "table"))
    counts = read_catalog_table(spark, name).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))
    spark.sql(f"DROP TABLE {name}")  # the name goes; the files lie in the scratch folder
    return counts
