"""Queries for projections, filters, joins, unions and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType

from clicklake.functions.scalars import whole_number
from clicklake.functions.text import has_text, is_upper_case
from clicklake.operators import relational as rel
from clicklake.plans.registry import CLICKS_SQL, WORDS_SQL, clicks_table, query, texts_table
from clicklake.schemas import record
from clicklake.sources.readers import read_table
from clicklake.streaming.transforms import words


@query("SELECT c_custkey, c_name FROM customer")
def proj_select(spark, base):
    return rel.pick(read_table(spark, base, "customer"), "c_custkey", "c_name")


@query("SELECT p_partkey, p_size + 1 AS size_plus_one FROM part")
def proj_expr(spark, base):
    part = read_table(spark, base, "part")
    return rel.pick(part, "p_partkey", (F.col("p_size") + 1).alias("size_plus_one"))


@query("SELECT *, p_size AS size_copy, p_size + 1 AS size_plus_one FROM part")
def proj_with_column(spark, base):
    copied = rel.with_column(read_table(spark, base, "part"), "size_copy", F.col("p_size"))
    return rel.with_column(copied, "size_plus_one", F.col("p_size") + 1)


@query("SELECT * REPLACE (p_size + 15 AS p_size) FROM part")
def proj_overwrite(spark, base):
    return rel.with_column(read_table(spark, base, "part"), "p_size", F.col("p_size") + 15)


@query("SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey, s_acctbal FROM supplier")
def proj_rename(spark, base):
    return rel.renamed(
        read_table(spark, base, "supplier"), {"s_suppkey": "supplier_id", "s_name": "supplier_name"}
    )


@query("SELECT * EXCLUDE (c_acctbal, c_mktsegment) FROM customer")
def proj_drop(spark, base):
    return rel.without(read_table(spark, base, "customer"), "c_acctbal", "c_mktsegment")


@query("SELECT r.*, 20240131 AS run_date FROM supplier r")
def proj_literal(spark, base):
    return rel.with_constant(read_table(spark, base, "supplier"), "run_date", 20240131)


@query("SELECT c_name, c_nationkey FROM customer")
def proj_by_position(spark, base):
    return rel.pick_positions(read_table(spark, base, "customer"), 1, 2)


@query("SELECT p_name AS name, p_size + 1 AS size FROM part")
def proj_map_record(spark, base):
    return rel.map_records(read_table(spark, base, "part"), name=F.col("p_name"), size=F.col("p_size") + 1)


@query("SELECT o_orderkey, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def proj_flatten(spark, base):
    nested = read_table(spark, base, "orders").select(
        F.struct("o_orderkey", "o_totalprice").alias("amount"),
        F.struct("o_orderdate", "o_orderpriority").alias("terms"),
    )
    return rel.flattened(nested, "amount", "terms")


@query(
    """SELECT event_id, CAST(trunc(value) AS INTEGER) AS whole_value, CAST(user_id AS VARCHAR) AS user_text,
              TRY_CAST(event_type AS BIGINT) AS event_number FROM events"""
)
def proj_cast(spark, base):
    return read_table(spark, base, "events").select(
        "event_id",
        F.col("value").cast("int").alias("whole_value"),
        F.encode(F.col("user_id").cast("string"), "UTF-8").cast("string").alias("user_text"),
        whole_number(F.col("event_type")).alias("event_number"),
    )


@query(
    """SELECT CAST(p_size AS BIGINT) AS p_size, p_name, p_partkey, CAST(NULL AS VARCHAR) AS p_colour,
              p_retailprice FROM part"""
)
def proj_conform(spark, base):
    wanted = record(
        p_size=LongType(), p_name=StringType(), p_partkey=LongType(), p_colour=StringType(), p_retailprice=DoubleType()
    )
    return rel.conformed(read_table(spark, base, "part"), wanted)


@query("SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_eq(spark, base):
    return rel.matching(read_table(spark, base, "customer"), F.col("c_mktsegment") == "BUILDING")


@query("SELECT * FROM part WHERE p_type = 'PROMO'")
def filter_sql_string(spark, base):
    return rel.matching(read_table(spark, base, "part"), "p_type = 'PROMO'")


@query("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-10'")
def filter_ge(spark, base):
    def since(ts):
        return ts >= F.lit("2024-01-10").cast("timestamp_ntz")

    return rel.matching(read_table(spark, base, "events"), since, "ts")


@query("SELECT * FROM lineitem WHERE l_quantity BETWEEN 10 AND 20")
def filter_between(spark, base):
    return rel.between(read_table(spark, base, "lineitem"), "l_quantity", 10.0, 20.0)


@query("SELECT * FROM events WHERE event_type IN ('view', 'purchase')")
def filter_isin(spark, base):
    return rel.one_of(read_table(spark, base, "events"), "event_type", ["view", "purchase"])


@query("SELECT line FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) WHERE line <> ''")
def filter_nonempty(spark, base):
    lines = read_table(spark, base, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    return rel.matching(lines, F.col("line") != "")


@query(
    """SELECT doc_id, body FROM (SELECT doc_id, text AS body FROM documents
              UNION ALL SELECT doc_id, NULL FROM documents UNION ALL SELECT doc_id, '' FROM documents)
       WHERE body IS NOT NULL AND body <> ''"""
)
def filter_valid_record(spark, base):
    documents = read_table(spark, base, "documents")
    bodies = rel.union_all(
        documents.select("doc_id", F.col("text").alias("body")),
        documents.select("doc_id", F.lit(None).cast("string")),
        documents.select("doc_id", F.lit("")),
    )
    return rel.matching(bodies, has_text, "body")


@query(f"SELECT doc_id, word FROM {WORDS_SQL} WHERE upper(word) = word")
def filter_upper_words(spark, base):
    split = words(texts_table(spark, base, "doc_id", "text"), "text")
    return rel.matching(split, is_upper_case, "word")


@query(
    """SELECT c.c_custkey, c_name, o_orderkey, o_totalprice FROM customer c
       JOIN orders o ON c.c_custkey = o.o_custkey"""
)
def join_inner(spark, base):
    orders = read_table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customer = read_table(spark, base, "customer").select("c_custkey", "c_name")
    return rel.joined_keep_left_key(customer, orders, "c_custkey", "o_custkey")


_USERS = "(SELECT c_custkey, c_name FROM customer) c"
_EVENTS = "(SELECT event_id, user_id, value FROM events) e"
_LABELS = "(SELECT doc_id AS label_id, quality FROM labels) l"
_DOCUMENTS = "(SELECT doc_id, source FROM documents) d"


def _customers_and_events(spark, base):
    """Whole tables; most customers have no event, and events of user 0 have no customer."""
    customer = read_table(spark, base, "customer").select("c_custkey", "c_name")
    return customer, read_table(spark, base, "events").select("event_id", "user_id", "value")


def _documents_and_labels(spark, base):
    """Whole tables; more than half of the documents have no label."""
    labels = spark.read.parquet(f"{base}/labels.parquet").select(F.col("doc_id").alias("label_id"), "quality")
    return read_table(spark, base, "documents").select("doc_id", "source"), labels


@query(f"SELECT * FROM {_USERS} LEFT JOIN {_EVENTS} ON c_custkey = user_id")
def join_left(spark, base):
    return rel.joined(*_customers_and_events(spark, base), "c_custkey", "user_id", "left", hot_partner=True)


@query(f"SELECT * FROM {_LABELS} RIGHT JOIN {_DOCUMENTS} ON doc_id = label_id")
def join_right(spark, base):
    documents, labels = _documents_and_labels(spark, base)
    return rel.joined(labels, documents, "label_id", "doc_id", "right")


@query(f"SELECT * FROM {_USERS} FULL JOIN {_EVENTS} ON c_custkey = user_id")
def join_full(spark, base):
    return rel.joined(*_customers_and_events(spark, base), "c_custkey", "user_id", "full")


@query(f"SELECT * FROM {_DOCUMENTS} WHERE doc_id IN (SELECT label_id FROM {_LABELS})")
def join_semi(spark, base):
    return rel.joined(*_documents_and_labels(spark, base), "doc_id", "label_id", "left_semi")


@query(f"SELECT * FROM {_USERS} WHERE NOT EXISTS (SELECT 1 FROM {_EVENTS} WHERE user_id = c_custkey)")
def join_anti(spark, base):
    return rel.joined(*_customers_and_events(spark, base), "c_custkey", "user_id", "left_anti")


@query(f"SELECT event_id, user_id, event_type, p_type FROM {CLICKS_SQL} e JOIN part ON k = p_partkey")
def join_enrich(spark, base):
    part = read_table(spark, base, "part")
    return rel.enriched(clicks_table(spark, base), part, "k", "p_partkey", "event_id", "user_id", "event_type", "p_type")


@query(
    f"""SELECT event_id AS fav_id, p_partkey AS product_id, p_name AS product_name, ts
        FROM {CLICKS_SQL} e JOIN part ON k = p_partkey"""
)
def join_pairs(spark, base):
    favorites = clicks_table(spark, base).select("event_id", "k", "ts")
    part = read_table(spark, base, "part").select("p_partkey", "p_name")
    pairs = rel.joined_pairs(part, favorites, "p_partkey", "k", "product", "favorite")
    return rel.map_records(
        pairs,
        fav_id=F.col("favorite.event_id"),
        product_id=F.col("product.p_partkey"),
        product_name=F.col("product.p_name"),
        ts=F.col("favorite.ts"),
    )


@query("SELECT l_orderkey AS key, o_orderstatus, l_linenumber, l_extendedprice FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def join_key_value(spark, base):
    orders = read_table(spark, base, "orders").select(F.col("o_orderkey").alias("key"), "o_orderstatus")
    items = read_table(spark, base, "lineitem").select(
        F.col("l_orderkey").alias("item_key"), "l_linenumber", "l_extendedprice"
    )
    return rel.joined_keep_left_key(orders, items, "key", "item_key")


@query(
    """SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey"""
)
def join_broadcast_lookup(spark, base):
    nations = rel.lookup(
        read_table(spark, base, "nation"), read_table(spark, base, "region"), "n_regionkey", "r_regionkey", "inner"
    )
    customer = read_table(spark, base, "customer")
    return rel.lookup(customer, nations, "c_nationkey", "n_nationkey", "inner").select("c_custkey", "n_name", "r_name")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def sort_desc(spark, base):
    customer = read_table(spark, base, "customer").select("c_custkey", "c_name", "c_acctbal")
    return rel.sorted_rows(customer, F.desc("c_acctbal"), "c_custkey")


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def sort_asc(spark, base):
    orders = read_table(spark, base, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return rel.sorted_rows(orders, "o_orderdate", "o_orderkey")


@query("SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 25")
def limit_topk(spark, base):
    events = read_table(spark, base, "events").select("event_id", "user_id", "value")
    return rel.first_rows(events, 25, F.desc("value"), "event_id")


@query(
    """SELECT c_custkey AS party_id, c_name AS name FROM customer
       UNION ALL SELECT s_suppkey, s_name FROM supplier"""
)
def set_union_all(spark, base):
    customers = read_table(spark, base, "customer").select(
        F.col("c_custkey").alias("party_id"), F.col("c_name").alias("name")
    )
    return rel.union_all(customers, read_table(spark, base, "supplier").select("s_suppkey", "s_name"))
