"""Record types. Every declared-schema read in the package takes its schema from here."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_LONG, _INT, _STR, _DOUBLE, _NTZ = LongType(), IntegerType(), StringType(), DoubleType(), TimestampNTZType()


def record(**fields) -> StructType:
    """A struct of nullable fields, in the order given."""
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


def extended(schema: StructType, **fields) -> StructType:
    """A new struct with fields added; ``StructType.add`` would change the given one."""
    return StructType([*schema.fields, *record(**fields).fields])


# Shop records. The field names of the files that are read.
CLICK = record(userId=_LONG, productId=_LONG, event=_STR, timestamp=_LONG)
PRODUCT_VIEW = record(userId=_LONG, productId=_LONG, channel=_STR, timestamp=_LONG)
PRODUCT = record(id=_LONG, category=_STR, timestamp=_LONG)
VIEW_REPORT = record(channel=_STR, category=_STR, distinctUserCount=_INT)
CATALOGUE_PRODUCT = record(
    id=_LONG, name=_STR, category=_STR, brand=_STR, color=_STR, price=_DOUBLE, timestamp=_LONG
)
USER_DETAIL = record(name=_STR, age=_INT)

# Reviews: as read from files or messages, with a label for training, and after scoring.
REVIEW = record(customerId=_STR, productId=_STR, reviewId=_STR, reviewDate=_LONG, reviewBody=_STR)
LABELLED_REVIEW = extended(REVIEW, label=_INT)
SCORED_REVIEW = record(customerId=_STR, productId=_STR, reviewId=_STR, reviewDate=_LONG, prediction=_STR)

# Streams of lines.
LINE = record(value=_STR)
LINE_DETAIL = record(inputLine=_STR, totalWordCount=_INT, receivedTimestamp=_LONG)
WORD_COUNT = record(word=_STR, count=_LONG)

# Columnar tables of the shop warehouse.
TABLES: dict[str, StructType] = {
    "region": record(r_regionkey=_INT, r_name=_STR),
    "nation": record(n_nationkey=_INT, n_name=_STR, n_regionkey=_INT),
    "customer": record(c_custkey=_LONG, c_name=_STR, c_nationkey=_INT, c_acctbal=_DOUBLE, c_mktsegment=_STR),
    "supplier": record(s_suppkey=_LONG, s_name=_STR, s_nationkey=_INT, s_acctbal=_DOUBLE),
    "part": record(p_partkey=_LONG, p_name=_STR, p_brand=_STR, p_type=_STR, p_size=_INT, p_retailprice=_DOUBLE),
    "orders": record(
        o_orderkey=_LONG,
        o_custkey=_LONG,
        o_orderstatus=_STR,
        o_totalprice=_DOUBLE,
        o_orderdate=_NTZ,
        o_orderpriority=_STR,
    ),
    "lineitem": record(
        l_orderkey=_LONG,
        l_partkey=_LONG,
        l_suppkey=_LONG,
        l_linenumber=_INT,
        l_quantity=_DOUBLE,
        l_extendedprice=_DOUBLE,
        l_discount=_DOUBLE,
        l_tax=_DOUBLE,
        l_returnflag=_STR,
        l_linestatus=_STR,
        l_shipdate=_NTZ,
    ),
    "events": record(event_id=_LONG, ts=_NTZ, user_id=_LONG, event_type=_STR, value=_DOUBLE, props=_STR),
    "documents": record(doc_id=_LONG, text=_STR, lang=_STR, source=_STR, n_chars=_LONG),
    "labels": record(doc_id=_LONG, quality=_INT, toxic=_INT),
    "conversations": record(conv_id=_LONG, turn=_LONG, role=_STR, text=_STR),
    "pages": record(page_id=_LONG, url=_STR, html=_STR),
    "benchmark": record(item_id=_LONG, text=_STR),
    "embeddings": record(vec_id=_LONG, embedding=ArrayType(FloatType()), label=_INT),
}
