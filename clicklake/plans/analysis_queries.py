"""Queries for aggregates, windows, versions, scalar and text functions, and user functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from clicklake.functions import scalars, text
from clicklake.operators import aggregates as agg
from clicklake.operators.groups import distinct_in_groups
from clicklake.operators.relational import enriched, sorted_rows
from clicklake.operators.versions import latest_per_key, merged_snapshot
from clicklake.operators.windows import follows, next_row, numbered_rows, ranked, top_per_group
from clicklake.plans.registry import ALL_PARTS_SQL, CLICKS_SQL, PARTS_SQL, WORDS_SQL, clicks_table, query, texts_table
from clicklake.plans.view_report import distinct_viewers
from clicklake.schemas import record
from clicklake.sources.readers import read_table
from clicklake.streaming.transforms import word_counts, words

_VIEWERS_SQL = f"""(SELECT event_type, p_type, CAST(count(DISTINCT user_id) AS INTEGER) AS n_users
                    FROM {CLICKS_SQL} e JOIN part ON k = p_partkey GROUP BY event_type, p_type)"""


def _viewers(spark, base):
    return distinct_viewers(
        clicks_table(spark, base), read_table(spark, base, "part"), "user_id", "k", "p_partkey", "event_type", "p_type", "n_users"
    )


# -- aggregates ----------------------------------------------------------------------------------


@query("SELECT l_returnflag, l_linestatus, count(*) AS n_items FROM lineitem GROUP BY ALL")
def agg_count(spark, base):
    return agg.count_rows(read_table(spark, base, "lineitem"), "l_returnflag", "l_linestatus", name="n_items")


@query(
    """SELECT o_custkey, round(sum(o_totalprice), 6) AS sum, round(avg(o_totalprice), 6) AS avg, count(*) AS count
       FROM orders GROUP BY o_custkey"""
)
def agg_sum_avg_count(spark, base):
    totals = agg.sum_avg_count(read_table(spark, base, "orders"), "o_totalprice", "o_custkey")
    return totals.withColumns({"sum": F.round("sum", 6), "avg": F.round("avg", 6)})


@query("SELECT event_type, count(DISTINCT user_id) AS n_users FROM events GROUP BY event_type")
def agg_count_distinct(spark, base):
    return agg.count_distinct(read_table(spark, base, "events"), "user_id", "event_type", name="n_users")


@query(f"SELECT * FROM {_VIEWERS_SQL}")
def agg_distinct_users(spark, base):
    return _viewers(spark, base)


@query(f"SELECT word, count(*) AS count FROM {ALL_PARTS_SQL} GROUP BY word")
def agg_reduce_by_key(spark, base):
    split = words(texts_table(spark, base, "text"), "text", keep_inner_empty=True)
    return agg.reduce_by_key(split.withColumn("one", F.lit(1)), ["word"], count=F.sum("one"))


@query(f"SELECT word, count(*) AS size FROM {WORDS_SQL} GROUP BY word")
def agg_group_values(spark, base):
    split = words(texts_table(spark, base, "text"), "text")
    return agg.count_rows(split, "word", name="size")


@query(
    """SELECT user_id, count(CASE WHEN event_type = 'purchase' THEN value END) AS n_purchases
       FROM events GROUP BY user_id"""
)
def agg_count_nonnull(spark, base):
    bought = read_table(spark, base, "events").withColumn("bought", F.expr("if(event_type = 'purchase', value, null)"))
    return agg.count_present(bought, "bought", "user_id", name="n_purchases")


@query("SELECT count(*) AS n_items FROM lineitem")
def agg_global_count(spark, base):
    return agg.count_rows(read_table(spark, base, "lineitem"), name="n_items")


@query("SELECT CAST(sum(l_linenumber) AS BIGINT) AS total, round(sum(l_quantity), 2) AS quantity FROM lineitem")
def agg_global_sum(spark, base):
    items = read_table(spark, base, "lineitem")
    return agg.whole(items, total=F.sum("l_linenumber"), quantity=F.round(F.sum("l_quantity"), 2))


@query("SELECT max(o_orderdate) AS last_date, max(o_totalprice) AS top_price FROM orders")
def agg_global_max(spark, base):
    return agg.whole(read_table(spark, base, "orders"), last_date=F.max("o_orderdate"), top_price=F.max("o_totalprice"))


@query(
    """SELECT count(l_extendedprice) AS count, round(avg(l_extendedprice), 4) AS mean,
              round(stddev_samp(l_extendedprice), 4) AS stddev, min(l_extendedprice) AS min,
              max(l_extendedprice) AS max FROM lineitem"""
)
def stat_describe(spark, base):
    typed = agg.summary(read_table(spark, base, "lineitem"), "l_extendedprice")
    return typed.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


@query("SELECT round(covar_samp(l_quantity, l_extendedprice), 4) AS covariance FROM lineitem")
def stat_cov(spark, base):
    found = agg.covariance(read_table(spark, base, "lineitem"), "l_quantity", "l_extendedprice")
    return found.select(F.round("covariance", 4).alias("covariance"))


@query("SELECT round(corr(l_quantity, l_extendedprice), 6) AS correlation FROM lineitem")
def stat_corr(spark, base):
    found = agg.correlation(read_table(spark, base, "lineitem"), "l_quantity", "l_extendedprice")
    return found.select(F.round("correlation", 6).alias("correlation"))


@query(
    """SELECT date_trunc('day', ts)::TIMESTAMP AS day, user_id, count(*) AS n_purchases FROM events
       WHERE event_type = 'purchase' GROUP BY 1, 2"""
)
def agg_daily_event_count(spark, base):
    events = read_table(spark, base, "events")
    return agg.daily_event_count(events, "event_type", "purchase", "ts", "user_id", "n_purchases")


@query(
    """SELECT * EXCLUDE n FROM (SELECT *, row_number() OVER
         (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1"""
)
def cdc_latest_snapshot(spark, base):
    events = read_table(spark, base, "events")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    snapshot = latest_per_key(events.filter(F.col("ts") < cut), "user_id", "ts", ["event_id"])
    return merged_snapshot(snapshot, events.filter(F.col("ts") >= cut), "user_id", "ts", ["event_id"])


# -- windows -------------------------------------------------------------------------------------


@query(
    f"""SELECT user_id, k, ts FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id, k ORDER BY ts, event_id)
          AS previous FROM {CLICKS_SQL} WHERE event_type IN ('view', 'purchase'))
        WHERE event_type = 'purchase' AND previous = 'view'"""
)
def win_lag_funnel(spark, base):
    clicks = clicks_table(spark, base).select("user_id", "k", "ts", "event_id", "event_type")
    flagged = follows(clicks, ["user_id", "k"], ["ts", "event_id"], "event_type", "view", "purchase", "bought")
    return flagged.where(F.col("bought")).select("user_id", "k", "ts")


@query(
    """SELECT event_id, user_id, event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id)
         AS next_type FROM events"""
)
def win_lead(spark, base):
    events = read_table(spark, base, "events").select("event_id", "user_id", "ts", "event_type")
    return next_row(events, ["user_id"], ["ts", "event_id"], {"next_type": "event_type"}).drop("ts")


@query(
    f"""SELECT event_type, p_type, n_users FROM (SELECT *, rank() OVER (PARTITION BY event_type
          ORDER BY n_users DESC) AS r FROM {_VIEWERS_SQL}) WHERE r <= 3"""
)
def win_topn_per_group(spark, base):
    return top_per_group(_viewers(spark, base), ["event_type"], "n_users", 3)


@query(
    f"""SELECT event_type, p_type, n_users, CAST(r AS INTEGER) AS rank FROM (SELECT *, rank() OVER
          (PARTITION BY event_type, p_type ORDER BY n_users) AS r FROM {_VIEWERS_SQL}) WHERE r <= 3"""
)
def win_rank_as_written(spark, base):
    # Ranked within the very keys it is grouped by: one row per group, so the cut removes nothing.
    return ranked(_viewers(spark, base), ["event_type", "p_type"], "n_users").filter("rank <= 3")


@query(
    f"""SELECT word, count(*) AS count, row_number() OVER (ORDER BY count(*), word) AS position
        FROM {WORDS_SQL} GROUP BY word"""
)
def sort_by_value(spark, base):
    """Words from rare to frequent, each with its place."""
    counts = word_counts(texts_table(spark, base, "text"), "text")
    return sorted_rows(numbered_rows(counts, ["count", "word"]), "position")


@query(
    f"""SELECT word, count(*) AS count, row_number() OVER (ORDER BY word DESC) AS position
        FROM {WORDS_SQL} GROUP BY word"""
)
def sort_by_key_desc(spark, base):
    """Words from the last to the first, each with its place."""
    counts = word_counts(texts_table(spark, base, "text"), "text")
    return sorted_rows(numbered_rows(counts, ["word"], descending=True), "position")


# -- scalar and text functions -------------------------------------------------------------------


@query(
    """SELECT event_id, epoch_us(ts) // 1000 AS ms, make_timestamp((epoch_us(ts) // 1000) * 1000) AS time
       FROM events"""
)
def fn_epoch_ms(spark, base):
    ms = read_table(spark, base, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return ms.withColumn("time", scalars.epoch_ms_time(F.col("ms")).cast("timestamp_ntz"))


@query(
    """SELECT event_id, CASE WHEN event_type = 'purchase' AND value > 50 THEN TRUE ELSE FALSE END AS big_purchase
       FROM events"""
)
def fn_case_when(spark, base):
    big = scalars.flag_when((F.col("event_type") == "purchase") & (F.col("value") > 50))
    return read_table(spark, base, "events").select("event_id", big.alias("big_purchase"))


@query(
    r"""SELECT doc_id, CAST(length(text) AS INTEGER) AS characters,
               CAST(length(text) + length(regexp_replace(text, '[^\x{10000}-\x{10FFFF}]', '', 'g')) AS INTEGER) AS units
        FROM documents"""
)
def fn_length(spark, base):
    return texts_table(spark, base, "doc_id", "text").select(
        "doc_id",
        text.text_length(F.col("text")).alias("characters"),
        text.text_length(F.col("text"), utf16_units=True).alias("units"),
    )


@query(
    f"""SELECT doc_id, CAST(len(parts) AS INTEGER) AS n_parts, parts[1] AS first_part, parts[-1] AS last_part
        FROM (SELECT doc_id, {PARTS_SQL} AS parts FROM documents)"""
)
def fn_split(spark, base):
    split = texts_table(spark, base, "doc_id", "text").select("doc_id", text.split_spaces(F.col("text")).alias("parts"))
    return split.select(
        "doc_id",
        F.size("parts").alias("n_parts"),
        F.get("parts", F.lit(0)).alias("first_part"),
        F.try_element_at("parts", F.lit(-1)).alias("last_part"),
    )


@query(f"SELECT doc_id, CAST(len({PARTS_SQL}) AS INTEGER) AS n_words FROM documents")
def fn_line_word_count(spark, base):
    return texts_table(spark, base, "doc_id", "text").select("doc_id", text.line_word_count(F.col("text")).alias("n_words"))


@query("SELECT doc_id, reverse(text) AS reversed FROM documents")
def fn_reverse(spark, base):
    return texts_table(spark, base, "doc_id", "text").select("doc_id", text.reverse_text(F.col("text")).alias("reversed"))


@query("SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer FROM orders")
def fn_to_string(spark, base):
    return read_table(spark, base, "orders").select("o_orderkey", text.number_text(F.col("o_custkey")).alias("customer"))


@query("SELECT p_partkey, 'shop_' || p_name AS name FROM part")
def fn_prefix(spark, base):
    return read_table(spark, base, "part").select("p_partkey", text.prefixed("shop_", F.col("p_name")).alias("name"))


@query(f"SELECT event_id, k, CAST(NULL AS VARCHAR) AS corrupt FROM {CLICKS_SQL}")
def fn_from_json(spark, base):
    parsed = text.parsed_json(F.col("props"), record(k=LongType()), "corrupt")
    return read_table(spark, base, "events").select("event_id", parsed.alias("props")).select("event_id", "props.*")


@query("SELECT doc_id, CASE quality WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' END AS sentiment FROM labels")
def fn_decode_label(spark, base):
    return read_table(spark, base, "labels").select("doc_id", scalars.decoded_label(F.col("quality")).alias("sentiment"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS date_key FROM orders")
def fn_date_key(spark, base):
    return read_table(spark, base, "orders").select("o_orderkey", scalars.date_key(F.col("o_orderdate")).alias("date_key"))


@query(f"SELECT doc_id, word FROM {WORDS_SQL}")
def fn_explode_words(spark, base):
    return words(texts_table(spark, base, "doc_id", "text"), "text")


# -- user functions ------------------------------------------------------------------------------


@query("SELECT p_partkey, p_size, p_size + 1 AS size_plus_one FROM part")
def udf_plus_n(spark, base):
    plus_one = scalars.plus_n(1)
    return read_table(spark, base, "part").select("p_partkey", "p_size", plus_one(F.col("p_size")).alias("size_plus_one"))


@query(f"SELECT * FROM {_VIEWERS_SQL}")
def udf_map_groups(spark, base):
    viewed = enriched(
        clicks_table(spark, base), read_table(spark, base, "part"), "k", "p_partkey", "user_id", "event_type", "p_type"
    )
    return distinct_in_groups(viewed, ["event_type", "p_type"], "user_id", "n_users")
