"""Running totals and active users (all-time and per day)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def business_date(event_time: str = "event_time", offset_hours: int = 0) -> Column:
    """Event date in the business day (UTC shifted by ``offset_hours``)."""
    ts = F.col(event_time)
    if offset_hours:
        ts = ts + F.make_interval(hours=F.lit(offset_hours))
    return F.to_date(ts)


def totals(orders: DataFrame, by_day: bool = False, offset_hours: int = 0) -> DataFrame:
    """GMV (exact decimal sum, output as double) and non-null order count."""
    aggs = [
        F.sum("amount").cast("double").alias("gmv"),
        F.count("order_id").alias("orders"),
    ]
    if by_day:
        return orders.groupBy(business_date(offset_hours=offset_hours).alias("dt")).agg(*aggs)
    return orders.agg(*aggs)


def active_users(orders: DataFrame, by_day: bool = False, offset_hours: int = 0) -> DataFrame:
    """Exact distinct users (null ids ignored).

    Spark plans the distinct count in two stages: (day, user) pairs are
    combined map-side and shuffled on both keys, so a busy day is spread over
    many tasks; only the per-day counts meet in the last stage.
    """
    agg = F.count_distinct("user_id").alias("dau")
    if by_day:
        return orders.groupBy(business_date(offset_hours=offset_hours).alias("dt")).agg(agg)
    return orders.agg(agg)


def batch_deltas(orders: DataFrame, batch: Column) -> DataFrame:
    """What the three sinks receive per micro-batch: GMV, orders, distinct users.

    A batch whose amounts are all null adds nothing (the totals sink skips it).
    """
    return (
        orders.groupBy(batch.alias("batch_id"))
        .agg(
            F.sum("amount").cast("double").alias("gmv"),
            F.count("order_id").alias("orders"),
            F.count_distinct("user_id").alias("users"),
        )
        .filter(F.col("gmv").isNotNull())
    )


def daily_active_users_stream(
    orders: DataFrame, delay: str = "10 minutes", offset_hours: int = 0
) -> DataFrame:
    """Exact daily active users as a stream (update mode): day, dau.

    Streaming ``countDistinct`` is not supported, so (day, user) pairs are
    deduplicated first and then counted.  The day is a 1-day event-time window,
    which carries the watermark: both the pair state and the day counts are
    evicted once the day is closed, so state stays bounded by the users of
    the open days.
    """
    # The business day starts at 00:00 local = (24 - offset) h UTC of the day before.
    start = f"{(-offset_hours) % 24} hours"
    day = F.window("event_time", "1 day", startTime=start)
    pairs = (
        orders.withWatermark("event_time", delay)
        .filter(F.col("user_id").isNotNull())
        .select(day.alias("day"), "user_id")
        .dropDuplicates(["day", "user_id"])
    )
    return pairs.groupBy("day").agg(F.count(F.lit(1)).alias("dau")).select(
        F.to_date(F.col("day.start") + F.make_interval(hours=F.lit(offset_hours))).alias("dt"),
        "dau",
    )
