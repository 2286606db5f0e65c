"""Windows over groups of any size: both ways must agree with a plain loop."""

import random
from itertools import groupby

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from clicklake.operators.skew import in_parts, large_groups
from clicklake.operators.windows import follows, next_row, numbered_rows, previous_row, ranked, top_per_group
from conftest import rows_of

SCHEMA = "user bigint, product bigint, ts bigint, id bigint, event string"


def skewed_clicks(count=3000, seed=7):
    """A third of all rows in one group, many of them at the same time; some null users and events."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        if i % 3 == 0:
            user, product, ts = 1, 9, rng.choice([5, 5, 5, rng.randrange(1000)])
        else:
            user, product, ts = rng.choice([None, *range(2, 60)]), rng.randrange(20), rng.randrange(1000)
        rows.append((user, product, ts, i, rng.choice(["view", "favorite", "addToCart", None])))
    rng.shuffle(rows)
    return rows


def neighbours(rows, step):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    found = []
    for _, group in groupby(sorted(rows, key=lambda r: (key(r), r[2], r[3])), key):
        group = list(group)
        for i, row in enumerate(group):
            j = i + step
            other = group[j] if 0 <= j < len(group) else None
            found.append((row[3], other and other[4], other and other[3]))
    return sorted(found, key=repr)


@pytest.mark.parametrize("function,step", [(previous_row, -1), (next_row, 1)])
@pytest.mark.parametrize("limit", [10**9, 100, 5])
def test_neighbours(spark, function, step, limit):
    rows = skewed_clicks()
    df = spark.createDataFrame(rows, SCHEMA)
    result = function(df, ["user", "product"], ["ts", "id"], {"event2": "event", "id2": "id"}, limit)
    assert result.columns == [*df.columns, "event2", "id2"]
    assert rows_of(result, "id", "event2", "id2") == neighbours(rows, step)


def test_large_group_is_cut_into_even_parts(spark):
    """The group with a third of the rows is cut by its sampled rows; the others are whole."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(skewed_clicks(), SCHEMA)
    keys, order = ["user", "product"], ["ts", "id"]
    large = large_groups(df, keys, order, 100)
    assert large.count() == 1
    assert large_groups(df, keys, order, 10_000).count() == 0
    parts = in_parts(df, keys, order, large, "part").groupBy("user", "part").agg(F.count("*").alias("n")).collect()
    assert {r.part for r in parts if r.user != 1} == {0}
    sizes = [r.n for r in parts if r.user == 1]
    assert len(sizes) > 80 and max(sizes) < 100 and sum(sizes) == 1000


def test_part_is_the_number_of_cuts_passed(spark):
    """Counted in steps of cuts, over nulls, ties and more cuts than a step has."""
    rng = random.Random(5)
    rows = [(1, 1, rng.choice([None, *range(60)]), rng.choice([None, i]), "e") for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    large = large_groups(df, ["user"], ["ts", "id"], 299)
    cuts = [(c.ts, c.id) for c in large.first()[1]]
    key = lambda p: tuple((v is not None, v or 0) for v in p)
    assert len(cuts) == 300 and cuts == sorted(cuts, key=key)
    for row in in_parts(df, ["user"], ["ts", "id"], large, "part").collect():
        assert row.part == sum(key(c) <= key((row.ts, row.id)) for c in cuts)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("limit", [10**9, 100, 3])
def test_numbers_over_a_whole_table(spark, plan_of, descending, limit):
    rows = skewed_clicks(1000)
    df = spark.createDataFrame(rows, SCHEMA)
    result = numbered_rows(df, ["user", "id"], "n", descending, limit)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[3]), reverse=descending)
    assert rows_of(result, "n", "id") == sorted([(n, r[3]) for n, r in enumerate(ordered, 1)], key=repr)
    assert result.columns == [*df.columns, "n"]
    assert numbered_rows(df.limit(0), ["id"]).count() == 0


def test_the_largest_groups_are_listed_first(spark, monkeypatch):
    from clicklake.operators import skew

    monkeypatch.setattr(skew, "LARGEST", 3)
    rows = [(u, 1, t, t, "e") for u in range(1, 9) for t in range(40 * u * u)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = large_groups(df, ["user"], ["ts", "id"], 30)
    hashes = {r[1]: r[0] for r in df.select("user", skew.group_hash(["user"])).distinct().collect()}
    assert {hashes[r[0]] for r in found.collect()} == {6, 7, 8}


def test_no_job_before_the_result_is_read(spark):
    df = spark.createDataFrame(skewed_clicks(), SCHEMA)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "plans only")
    try:
        made = previous_row(df, ["user", "product"], ["ts", "id"], {"before": "event"}, 100)
        assert list(tracker.getJobIdsForGroup("planning")) == []
        made.count()
        assert list(tracker.getJobIdsForGroup("planning"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_groups_of_equal_hash(spark, monkeypatch):
    """All groups share a hash: parts and edges still go by the group."""
    from clicklake.operators import skew
    from pyspark.sql import functions as F

    monkeypatch.setattr(skew, "group_hash", lambda keys: F.lit(7).cast("bigint"))
    rows = skewed_clicks()
    result = previous_row(spark.createDataFrame(rows, SCHEMA), ["user", "product"], ["ts", "id"], {"e2": "event", "i2": "id"}, 100)
    assert rows_of(result, "id", "e2", "i2") == neighbours(rows, -1)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(1, 2), st.integers(0, 5)), min_size=1, max_size=40))
def test_split_and_plain_agree(spark, keys):
    rows = [(u, p, t, i, f"e{i}") for i, (u, p, t) in enumerate(keys)]
    df = spark.createDataFrame(rows, SCHEMA)
    args = (["user", "product"], ["ts", "id"], {"before": "event"})
    assert rows_of(previous_row(df, *args, 2)) == rows_of(previous_row(df, *args))


FUNNEL = [
    (1, 9, 1, 1, "favorite"),
    (1, 9, 2, 2, "view"),
    (1, 9, 3, 3, "addToCart"),
    (2, 9, 1, 4, "addToCart"),
    (2, 9, 2, 5, "favorite"),
]


@pytest.mark.parametrize("limit", [10**9, 1])
def test_follows_ignores_other_kinds_between(spark, limit):
    df = spark.createDataFrame(FUNNEL, SCHEMA)
    flagged = follows(df, ["user", "product"], ["ts", "id"], "event", "favorite", "addToCart", "bought", limit)
    assert rows_of(flagged.where("bought"), "user", "product", "ts") == [(1, 9, 3)]
    # Without dropping the view first, nothing follows a favorite directly.
    before = previous_row(df, ["user", "product"], ["ts", "id"], {"before": "event"}, limit)
    assert rows_of(before.filter("event = 'addToCart' and before = 'favorite'")) == []


def ranks_at_most(rows, n):
    kept = []
    for key, value in rows:
        above = sum(
            1 for k, v in rows if k == key and v is not None and (value is None or v > value)
        )
        if above + 1 <= n:
            kept.append((key, value))
    return sorted(kept, key=repr)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 4))), min_size=1, max_size=30
    ),
    st.integers(1, 4),
)
def test_top_per_group_is_rank(spark, rows, n):
    df = spark.createDataFrame(rows, "k string, v int")
    assert rows_of(top_per_group(df, ["k"], "v", n)) == ranks_at_most(rows, n)


def test_top_per_group_keeps_all_ties(spark):
    rows = [("hot", 5)] * 500 + [("hot", 1)] * 3 + [("cold", 2)]
    df = spark.createDataFrame(rows, "k string, v int")
    assert rows_of(top_per_group(df, ["k"], "v", 3)) == sorted([("hot", 5)] * 500 + [("cold", 2)], key=repr)


def test_top_per_group_limits_before_the_shuffle(spark, plan_of):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    assert "WindowGroupLimit" in plan_of(top_per_group(df, ["k"], "v", 3))


def test_ranked_within_its_own_group_is_always_one(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", "y", 1)], "channel string, category string, n int")
    assert rows_of(ranked(df, ["channel", "category"], "n"), "rank") == [(1,), (1,)]


def test_many_clicks_at_one_time_are_folded(spark):
    """A third of all clicks in one group at one time: equal clicks are one row, and the rest is as by a loop."""
    from clicklake.plans.clicks import cart_after_favorite
    from clicklake.schemas import CLICK

    rows = [(1, 9, ("favorite", "addToCart")[i % 2], 0) for i in range(3000)]
    rows += [(1, 9, ("addToCart", "favorite", "view")[i % 3], 1 + i // 7) for i in range(700)]
    rows += [(u, 9, ("favorite", "addToCart")[u % 3 > 0], u // 5) for u in range(2, 500)] * 2

    wanted, last = [], {}
    for user, product, time, event in sorted((u, p, t, e) for u, p, e, t in rows):
        if event == "view":
            continue
        if event == "addToCart" and last.get((user, product)) == "favorite":
            wanted.append((user, product, time))
        last[user, product] = event
    clicks = spark.createDataFrame(rows, CLICK)
    assert rows_of(cart_after_favorite(clicks)) == sorted(wanted, key=repr)
    assert rows_of(cart_after_favorite(clicks, max_group_rows=50)) == sorted(wanted, key=repr)


def test_parts_are_found_by_search(spark, plan_of):
    """A row reads one cut a step; copies of the cuts cost more the more there are."""
    df = spark.createDataFrame(skewed_clicks(1000), SCHEMA)
    plan = plan_of(numbered_rows(df, ["user", "id"], max_part_rows=100))
    assert "aggregate(" in plan and "slice(" not in plan and "filter(" not in plan
