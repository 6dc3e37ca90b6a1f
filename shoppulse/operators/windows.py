"""Sliding event-time window GMV per category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import WINDOW_LENGTH, WINDOW_SLIDE


def window_aggregate(
    enriched: DataFrame,
    length: str = WINDOW_LENGTH,
    slide: str = WINDOW_SLIDE,
    event_time: str = "event_time",
    group: str = "category",
) -> DataFrame:
    """GMV (exact decimal sum) and non-null order count per (window, group).

    Same function on a batch frame and on a stream (update mode).  Each row
    falls into length/slide windows; rows with a null event time fall into
    none.  Spark expands each row into its windows, aggregates partially per
    map task, then shuffles by (window, group): a hot group is combined before
    the shuffle.  Columns: window (struct), category, gmv_dec, order_cnt.
    """
    return enriched.groupBy(F.window(event_time, length, slide).alias("window"), F.col(group)).agg(
        F.sum("amount").alias("gmv_dec"),
        F.count("order_id").alias("order_cnt"),
    )


def flatten_windows(agg: DataFrame, ntz: bool = True) -> DataFrame:
    """window struct -> window_start / window_end; GMV as double."""
    start = F.col("window.start")
    end = F.col("window.end")
    if ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    return agg.select(
        start.alias("window_start"),
        end.alias("window_end"),
        "category",
        F.col("gmv_dec").cast("double").alias("gmv"),
        "order_cnt",
    )


def window_gmv(enriched: DataFrame, length: str = WINDOW_LENGTH, slide: str = WINDOW_SLIDE) -> DataFrame:
    """Batch view: window_start, window_end, category, gmv, order_cnt."""
    return flatten_windows(window_aggregate(enriched, length, slide))
