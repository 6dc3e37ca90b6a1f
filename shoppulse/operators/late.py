"""Which rows a watermarked stream drops as late, computed on a batch table.

Given each row's arrival micro-batch, a row of data batch *b* is late when its
event time is <= max(event time over batches <= b-2) - delay, the maximum cut
to milliseconds.  The lag is two batches: a batch is filtered with the
watermark the previous batch ended with, and that watermark was computed from
the data seen before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import ordered

# Replay parameters for a scrambled arrival order (test-table adapter): each
# order arrives up to JITTER_SECONDS after its event time, and micro-batches
# cut the arrival clock into BATCH_SECONDS slots.
JITTER_SECONDS = 3601
JITTER_MULTIPLIER = 7919
BATCH_SECONDS = 600


def scrambled_arrival_batch(event_id: Column, event_time: Column) -> Column:
    """Arrival slot of an order delayed by a deterministic per-event jitter."""
    delay = (event_id * F.lit(JITTER_MULTIPLIER)) % F.lit(JITTER_SECONDS)
    arrival = event_time.cast("timestamp") + F.make_interval(secs=delay.cast("decimal(18,6)"))
    return F.floor(F.unix_micros(arrival) / F.lit(BATCH_SECONDS * 1_000_000)).cast("bigint")


def batch_watermarks(arrivals: DataFrame, batch: str = "batch", event_time: str = "event_time",
                     delay_minutes: int = 10, ranges: int | None = None) -> DataFrame:
    """One row per data batch: the watermark its rows are judged by.

    Works on the per-batch maxima only (one row per micro-batch), so the global
    ordering window runs over the batch count, never over the rows.  A history of very many
    micro-batches can be cut into ``ranges`` of them.
    """
    per_batch = arrivals.groupBy(batch).agg(F.max(event_time).alias("_max_et"))
    if ranges:
        placed = ordered(per_batch, [batch], {"_upto": ("max", "_max_et")}, position="_n", ranges=ranges)
        two_before = placed.select((F.col("_n") + 2).alias("_n"), F.col("_upto").alias("_seen"))
        judged = placed.drop("_upto").join(two_before, "_n", "left")
        seen = F.col("_seen")
    else:
        judged = per_batch
        seen = F.max("_max_et").over(Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -2))
    return judged.select(
        batch,
        (
            F.date_trunc("millisecond", seen) - F.make_interval(mins=F.lit(delay_minutes))
        ).alias("watermark"),
    )


def mark_late(arrivals: DataFrame, batch: str = "batch", event_time: str = "event_time",
              delay_minutes: int = 10) -> DataFrame:
    marks = batch_watermarks(arrivals, batch, event_time, delay_minutes)
    return arrivals.join(marks, batch, "left").withColumn(
        "late", F.coalesce(F.col(event_time) <= F.col("watermark"), F.lit(False))
    )


def late_counts(arrivals: DataFrame, batch: str = "batch", event_time: str = "event_time",
                delay_minutes: int = 10) -> DataFrame:
    """batch, n: rows of each data batch that every metric loses as late."""
    return (
        mark_late(arrivals, batch, event_time, delay_minutes)
        .groupBy(batch)
        .agg(F.count_if(F.col("late")).alias("n"))
    )
