"""Projections, filters, joins, sorts, aggregates and group functions on small rows, and their plans."""

import pandas as pd
import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from clicklake.functions.text import is_upper_case
from clicklake.operators import aggregates as agg
from clicklake.operators import relational as rel
from clicklake.operators.groups import distinct_in_groups, map_groups
from clicklake.schemas import USER_DETAIL
from clicklake.sources.readers import read_table
from conftest import SMALL, rows_of


@pytest.fixture(scope="module")
def users(spark):
    rows = [("lia", 25, "tr", 10), ("dan", 30, "en", 5), ("rob", 30, "tr", 20)]
    return spark.createDataFrame(rows, "name string, age int, country string, salary int")


def test_projections(users):
    assert rows_of(rel.pick(users, "name", (F.col("age") + 1).alias("older")))[0] == ("dan", 31)
    assert rows_of(rel.with_column(users, "age", F.col("age") + 15), "age") == [(40,), (45,), (45,)]
    assert rel.renamed(users, {"name": "who"}).columns[0] == "who"
    assert rel.without(users, "salary", "country").columns == ["name", "age"]
    assert rows_of(rel.pick_positions(users, 1)) == [(25,), (30,), (30,)]
    assert rel.with_constant(users, "day", 1).first()["day"] == 1


def test_conform_reorders_and_refuses(users):
    assert rel.conformed(users.select("age", "name"), USER_DETAIL).columns == ["name", "age"]
    strict = StructType([StructField("name", StringType(), False), StructField("age", IntegerType())])
    with pytest.raises(AnalysisException):
        rel.conformed(users, strict).collect()


def test_filters_reach_the_scan(spark, plan_of):
    customer = read_table(spark, SMALL, "customer")
    for predicate in (F.col("c_mktsegment") == "BUILDING", "c_mktsegment = 'BUILDING'"):
        plan = plan_of(rel.matching(customer, predicate).select("c_custkey"))
        assert "EqualTo(c_mktsegment,BUILDING)" in plan
        assert "c_acctbal" not in plan  # columns that are not needed are not read
    assert "In(c_mktsegment" in plan_of(rel.one_of(customer, "c_mktsegment", ["BUILDING", "MACHINERY"]))
    plan = plan_of(rel.between(customer, "c_acctbal", 1.0, 2.0))
    assert "GreaterThanOrEqual(c_acctbal,1.0)" in plan and "LessThanOrEqual(c_acctbal,2.0)" in plan


def test_named_predicate(spark):
    df = spark.createDataFrame([("AB",), ("Ab",)], "w string")
    assert rows_of(rel.matching(df, is_upper_case, "w")) == [("AB",)]


LEFT = [(1, "Ann"), (2, "Ben"), (3, "Cem"), (None, "nobody")]
RIGHT = [(1, 1, "basket a"), (2, 1, "basket b"), (3, 2, "basket c"), (4, 9, "basket d"), (5, None, "basket e")]


@pytest.fixture(scope="module")
def sides(spark):
    return (
        spark.createDataFrame(LEFT, "userId int, userName string"),
        spark.createDataFrame(RIGHT, "orderId int, userId int, userName string"),
    )


def expected(how):
    pairs = [l + r for l in LEFT for r in RIGHT if l[0] is not None and l[0] == r[1]]
    lonely_left = [l for l in LEFT if all(l[0] is None or l[0] != r[1] for r in RIGHT)]
    lonely_right = [r for r in RIGHT if all(r[1] is None or l[0] != r[1] for l in LEFT)]
    rows = {
        "inner": pairs,
        "left": pairs + [l + (None,) * 3 for l in lonely_left],
        "right": pairs + [(None,) * 2 + r for r in lonely_right],
        "full": pairs + [l + (None,) * 3 for l in lonely_left] + [(None,) * 2 + r for r in lonely_right],
        "left_semi": [l for l in LEFT if l not in lonely_left],
        "left_anti": lonely_left,
    }[how]
    return sorted(rows, key=repr)


@pytest.mark.parametrize("hot_partner, limit", [(False, 1), (True, 10**6), (True, 1), (True, 0)])
@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
def test_joins(sides, how, hot_partner, limit):
    assert rows_of(rel.joined(*sides, "userId", "userId", how, hot_partner, limit)) == expected(how)


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_keys_of_different_types_with_a_hot_partner(sides, how):
    left, right = sides
    other = right.withColumn("userId", F.col("userId").cast("bigint"))
    assert rows_of(rel.joined(left, other, "userId", "userId", how, True, 0)) == expected(how)


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_ordinary_keys_take_one_plain_join(spark, plan_of, folder, how):
    """Without a hot key each side's file is read once in full; sampling reads the partner's again."""
    spark.range(2000).select(F.col("id").alias("c"), F.lit("x").alias("name")).write.parquet(f"{folder}/c")
    spark.range(3000).select((F.col("id") % 2500).alias("o"), F.col("id").alias("n")).write.parquet(f"{folder}/o")
    sides = [spark.read.parquet(f"{folder}/{name}") for name in "co"]
    result = rel.joined(*sides, "c", "o", how, hot_partner=True)
    assert "Inner" in plan_of(result) and "LeftAnti" in plan_of(result) and "Outer" in plan_of(result)
    rows = result.collect()
    final = plan_of(result)
    final = final[final.index("Final Plan") : final.index("Initial Plan")]
    # What is left: the sides of the plain join, and the sample of each partner.
    partners = 2 if how == "full" else 1
    assert final.count("FileScan parquet") <= 2 + 2 * partners, final
    plain = sides[0].join(sides[1], F.col("c") == F.col("o"), how).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, plain), key=repr)


SKEW_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_a_hot_partner_key_is_split(spark, plan_of, how):
    """The right side has a third of its rows under one key; Spark splits that partition."""
    customers = spark.range(1000).select(F.col("id").alias("c"), F.col("id").cast("string").alias("name"))
    orders = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1500).alias("o"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        result = rel.joined(customers, orders, "c", "o", how, hot_partner=True, max_group_rows=5000)
        rows = result.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(result)
    finally:
        for key in SKEW_SETTINGS:
            spark.conf.unset(key)
    plain = customers.join(orders, customers.c == orders.o, how).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, plain), key=repr)


def test_full_join_repeats_both_sides(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (2, "z")], "k2 int, r string")
    assert rows_of(rel.joined(left, right, "k", "k2", "full")) == rows_of(
        left.join(right, left.k == right.k2, "full")
    )


def test_join_drops_the_right_key(sides):
    joined = rel.joined_keep_left_key(*sides, "userId", "userId")
    assert joined.columns == ["userId", "userName", "orderId", "userName"]


def test_pairs(spark):
    products = spark.createDataFrame([(1, "pen"), (2, "ink")], "id bigint, name string")
    favorites = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (3, 2, 1)], "id bigint, productId bigint, ts bigint")
    pairs = rel.joined_pairs(products, favorites, "id", "productId", "p", "f")
    assert rows_of(rel.map_records(pairs, fav=F.col("f.id"), product=F.col("p.id"), name=F.col("p.name"))) == [
        (1, 1, "pen"),
        (2, 1, "pen"),
        (3, 2, "ink"),
    ]


def test_lookup_is_planned_by_size(spark, plan_of):
    from clicklake.sources.readers import read_table
    from conftest import SMALL

    customer, nation, region = (read_table(spark, SMALL, name) for name in ("customer", "nation", "region"))

    def query():
        nations = rel.lookup(nation, region, "n_regionkey", "r_regionkey", "inner")
        return rel.lookup(customer, nations, "c_nationkey", "n_nationkey", "inner").select("c_custkey", "n_name", "r_name")

    small = query()
    assert plan_of(small).count("BroadcastHashJoin") == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = query()
        assert "BroadcastHashJoin" not in plan_of(large)
        assert rows_of(small) == rows_of(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_plain_full_join_reads_each_side_once(spark, plan_of, folder):
    for name in ("one", "two"):
        spark.range(10).write.parquet(f"{folder}/{name}")
    one, two = (spark.read.parquet(f"{folder}/{name}") for name in ("one", "two"))
    plan = plan_of(rel.joined(one, two.withColumnRenamed("id", "other"), "id", "other", "full"))
    assert plan.count("FileScan") == 2 and "FullOuter" in plan


def test_sorts(spark, users):
    assert [r.name for r in rel.sorted_rows(users, F.desc("age"), "name").collect()] == ["dan", "rob", "lia"]
    assert [r.name for r in rel.first_rows(users, 2, "name").collect()] == ["dan", "lia"]


def test_first_rows_does_not_sort_everything(users, plan_of):
    plan = plan_of(rel.first_rows(users, 2, "name"))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_union_is_by_position_or_name(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "y int, x int")
    assert rows_of(rel.union_all(a, b)) == [(1, 2), (3, 4)]
    assert rows_of(rel.union_all(a, b, by_name=True)) == [(1, 2), (4, 3)]


def test_aggregates(users):
    assert rows_of(agg.count_rows(users, "age")) == [(25, 1), (30, 2)]
    assert rows_of(agg.sum_avg_count(users, "age", "country")) == [("en", 30, 30.0, 1), ("tr", 55, 27.5, 2)]
    assert rows_of(agg.count_distinct(users, "age", "country", name="n", as_type="int")) == [("en", 1), ("tr", 2)]
    count, mean, deviation, least, most = agg.summary(users, "age").first()
    assert (count, least, most) == (3, 25, 30)
    assert mean == pytest.approx(28.333333) and deviation == pytest.approx(2.886751)
    assert agg.covariance(users, "age", "salary").first()[0] == pytest.approx(4.166667)
    assert agg.correlation(users, "age", "salary").first()[0] == pytest.approx(0.188982, abs=1e-6)
    as_text = {r["summary"]: r["age"] for r in agg.summary_text(users, "age").collect()}
    assert (as_text["count"], as_text["min"], as_text["max"]) == ("3", "25", "30")


def test_numbers(spark):
    numbers = spark.createDataFrame([(n,) for n in range(1, 6)], "value int")
    assert agg.count_rows(numbers).first()[0] == 5
    assert agg.whole(numbers, total=F.sum("value"), top=F.max("value")).first() == (15, 5)


def test_count_present(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), ("b", None)], "k string, v int")
    assert rows_of(agg.count_present(df, "v", "k")) == [("a", 1), ("b", 0)]


def test_distinct_count_shuffles_on_the_values(users, plan_of):
    plan = plan_of(agg.count_distinct(users, "age", "country", name="n"))
    assert "hashpartitioning(country#" in plan and ", age#" in plan.split("hashpartitioning(", 2)[2]


@pytest.mark.parametrize("limit", [10**9, 10])
def test_distinct_in_groups(spark, limit):
    rows = [("hot", i % 200) for i in range(1000)] + [("cold", 1), ("cold", 1), ("cold", None), (None, 3)]
    df = spark.createDataFrame(rows, "k string, v int")
    result = distinct_in_groups(df, ["k"], "v", "n", limit)
    assert result.schema["n"].dataType == IntegerType()
    assert rows_of(result) == sorted([("hot", 200), ("cold", 1), (None, 1)], key=repr)


@pytest.mark.parametrize("limit", [10**9, 10])
def test_map_groups_with_user_code(spark, limit):
    rows = [("hot", i) for i in range(500)] + [("cold", 7)]
    df = spark.createDataFrame(rows, "k string, v bigint")

    def spread(key, batches):
        least, most = None, None
        for batch in batches:
            least = batch.v.min() if least is None else min(least, batch.v.min())
            most = batch.v.max() if most is None else max(most, batch.v.max())
        return pd.DataFrame({"k": [key[0]], "least": [least], "most": [most]})

    result = map_groups(
        df, ["k"], spread, "k string, least bigint, most bigint", ["v"],
        {"least": F.min("least"), "most": F.max("most")}, limit,
    )
    assert rows_of(result) == [("cold", 7, 7), ("hot", 0, 499)]


def test_bad_cast_is_an_error_and_try_cast_is_null(spark):
    df = spark.createDataFrame([("x",)], "v string")
    with pytest.raises(PySparkException):
        df.select(F.col("v").cast("int")).collect()
    assert df.select(F.col("v").try_cast("int")).first()[0] is None
