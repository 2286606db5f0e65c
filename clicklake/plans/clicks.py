"""Click reports: carts after favorites, daily cart additions, totals per event."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clicklake.functions.scalars import epoch_ms_time
from clicklake.operators.aggregates import count_distinct, count_rows, daily_event_count
from clicklake.operators.skew import MAX_GROUP_ROWS
from clicklake.operators.windows import follows

# Event kinds; below, the column names "bought", "totalAddToCart" and "totalUser" of the reports.
FAVORITE = "favorite"
ADD_TO_CART = "addToCart"


def cart_after_favorite(
    clicks: DataFrame, tie: tuple[str, ...] = ("event",), max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Cart additions right after a favorite of the same user and product.

    Clicks of the same millisecond are ordered by ``tie``; by default a cart addition then comes
    before a favorite, so it does not follow it.

    Clicks that are equal in all of these are folded first: of a run of equal cart additions only the
    first can follow a favorite. So the order within a group is unique, and however many clicks share
    one time, the slices of a large group stay even.
    """
    flagged = follows(
        clicks.select("userId", "productId", "event", "timestamp", *[c for c in tie if c != "event"]).distinct(),
        ["userId", "productId"],
        ["timestamp", *tie],
        "event",
        FAVORITE,
        ADD_TO_CART,
        "bought",
        max_group_rows,
    )
    return flagged.where(F.col("bought")).select("userId", "productId", "timestamp")


def daily_cart_additions(clicks: DataFrame, zone: str | None = None) -> DataFrame:
    """Cart additions per day and user, most active first."""
    timed = clicks.withColumn("time", epoch_ms_time(F.col("timestamp")))
    return daily_event_count(timed, "event", ADD_TO_CART, "time", "userId", "totalAddToCart", zone)


def event_totals_since(clicks: DataFrame, since_ms: int) -> DataFrame:
    """Events per kind from a point in time on."""
    return count_rows(clicks.filter(F.col("timestamp") >= since_ms), "event")


def users_per_event(clicks: DataFrame) -> DataFrame:
    return count_distinct(clicks, "userId", "event", name="totalUser")
