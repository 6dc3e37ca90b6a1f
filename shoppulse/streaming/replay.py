"""Replay a table through the streaming pipeline, one micro-batch per arrival batch.

Used for backfills and for checking stream = batch.  The table is staged once (one parallel
job, ``FILE_ROWS`` rows a file or less, equally many files for every arrival batch) and its
files get modification times in arrival order.  The file source admits files in that order
and as many a trigger as a batch has, so one run of the query takes micro-batch N from
arrival batch N.  Where the batches do not have equally many files, or the file system keeps
modification times to itself, the query is restarted from its checkpoint for every batch
instead, whose files are complete before it looks.  The driver loop runs over batch ids
only, never rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.codec import encode_orders
from ..session import checkpoint_root
from ..sources.streams import file_order_stream
from ..storage import children, move_files, remove, set_modified
from .streams import MetricStreams, StreamConfig, start_streams

NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
FILE_ROWS = 2_000_000  # orders a staged file is meant to hold, were all batches equal
UNKNOWN = (1 << 63) - 1  # arrival batch of rows that have none: they come after all others


def range_batches(df: DataFrame, column: str, n: int) -> Column:
    """Cut ``column``'s value range into ``n`` equal arrival batches (0..n-1).

    One small aggregate finds the range; the batch number is then a per-row
    expression, so every batch grows with the table while their count stays n.
    """
    lo, hi = df.agg(F.min(column), F.max(column)).first()
    if lo is None:
        return F.lit(0).cast("bigint")
    width = hi - lo + 1
    return F.floor((F.col(column) - F.lit(lo)) * F.lit(n) / F.lit(width)).cast("bigint")


def time_batches(df: DataFrame, column: str, key: str, n: int, name: str) -> DataFrame:
    """``df`` with its arrival batch ``name``: up to ``n``, in the order of time, about equally large.

    Rows arrive by their time whatever the order of their ids, so a batch holds nothing
    behind the watermark of those before it.  Copies of a key arrive together, at the earliest
    time of any; rows without a time come first.  The batches grow with the table.
    """
    cuts = df.agg(F.percentile_approx(F.unix_micros(column), [k / n for k in range(1, n)])).first()[0]
    at = F.unix_micros(F.min(column).over(Window.partitionBy(key)))
    passed = [F.when(F.col(name) > F.lit(cut), 1).otherwise(0) for cut in sorted(set(cuts or []))]
    return df.withColumn(name, at).withColumn(name, sum(passed, F.lit(0)).cast("bigint"))


def resent_batches(df: DataFrame, column: str, key: str, n: int, name: str) -> DataFrame:
    """``df`` with its arrival batch ``name`` (0..n-1): by time, the watermark of ``n`` key ranges before the last.

    What a bounded dedup holds after the last batch depends on the latest time of the batches
    before it, which is here that of all ``range_batches`` but the last.  Up to that time the
    rows come in n - 1 batches of about equal size, so none is behind the watermark
    whatever the order of the keys; the last batch has the later rows and half of the batch
    before it, so that it is there where no row is later.  Copies of a key arrive together,
    at the earliest time of any; rows without a time come first, rows without a key by their time.
    """
    own = F.unix_micros(F.date_trunc("second", column))  # as the lines carry it
    end = df.filter(range_batches(df, key, n) < n - 1).agg(F.max(own)).first()[0]
    end = F.lit(-(1 << 62) if end is None else end)
    cuts = df.filter(own <= end).agg(F.percentile_approx(own, [k / (n - 1) for k in range(1, n - 1)])).first()[0]
    cuts = sorted(set(cuts or []))
    at = F.when(F.col(key).isNotNull(), F.min(own).over(Window.partitionBy(key))).otherwise(own)
    passed = sum((F.when(F.col(name) > F.lit(cut), 1).otherwise(0) for cut in cuts), F.lit(0))
    half = (passed == len(cuts)) & (F.col(name) < end) & (F.pmod(F.xxhash64(key), F.lit(2)) == 0)
    last = (F.col(name) > end) | half
    return df.withColumn(name, at).withColumn(name, F.when(last, n - 1).otherwise(passed).cast("bigint"))


def stage_arrivals(orders: DataFrame, batch: Column, folder: str, files: int | None = None) -> list[int]:
    """Write orders as JSON lines under ``folder/batch=N``, in up to ``files`` files; the batch ids in order.

    Orders without a batch are those of batch ``UNKNOWN``.
    """
    known = F.coalesce(batch, F.lit(UNKNOWN))
    lines = encode_orders(orders.withColumn("batch", known), keep=("batch",)).select(
        "batch", F.col("json").alias("value")
    )
    if files:
        lines = lines.repartition("batch", F.pmod(F.xxhash64("value"), F.lit(files)))
    lines.write.partitionBy("batch").mode("overwrite").text(folder)
    names = children(orders.sparkSession, folder)
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch="))


def _in_order(spark: SparkSession, staged: str, inbox: str, batches: list[int], files: int) -> bool:
    """Put all staged files into the inbox in arrival order; False if they cannot be told apart."""
    held = {b: [n for n in children(spark, f"{staged}/batch={b}") if not n.startswith(("_", "."))] for b in batches}
    if any(len(names) != files for names in held.values()):
        return False
    start = 1_000_000_000_000
    first = [f"{staged}/batch={batches[0]}/{name}" for name in held[batches[0]]]
    if not set_modified(spark, first, start):
        return False
    for k, b in enumerate(batches):
        set_modified(spark, move_files(spark, f"{staged}/batch={b}", inbox, f"{b:012d}-"), start + 1000 * k)
    return True


def replay(
    spark: SparkSession,
    orders: DataFrame,
    batch: Column,
    dim: DataFrame,
    cfg: StreamConfig | None = None,
    one_run: bool = True,
) -> MetricStreams:
    """Run the pipeline over ``orders`` in arrival-batch order; return it (stopped).

    What was staged is removed at the end; ledgers and checkpoints stay.
    """
    cfg = cfg or StreamConfig()
    run = f"{checkpoint_root(spark)}/replay-{uuid.uuid4().hex[:12]}"
    cfg.root = cfg.root or f"{run}/streams"
    cfg.trigger = {"availableNow": True}
    staged, inbox = f"{run}/staged", f"{run}/inbox"
    files = max(1, -(-orders.count() // FILE_ROWS))
    batches = stage_arrivals(orders, batch, staged, files)
    if not batches:
        raise ValueError("nothing to replay")
    before = spark.conf.get(NO_DATA_BATCHES, "true")

    def run_once(files_per_trigger: int | None, last: bool) -> MetricStreams:
        # One micro-batch per arrival batch: no further no-data batch (the next data batch
        # evicts expired state just the same), but for the last watermark to close windows.
        spark.conf.set(NO_DATA_BATCHES, "true" if cfg.closed_windows and last else "false")
        stream = file_order_stream(spark, inbox, max_files_per_trigger=files_per_trigger)
        pipe = start_streams(spark, stream, dim, cfg)
        pipe.await_all()
        return pipe

    try:
        if one_run and _in_order(spark, staged, inbox, batches, files):
            return run_once(files, True)
        for b in batches:
            move_files(spark, f"{staged}/batch={b}", inbox, f"{b:012d}-")
            pipe = run_once(None, b == batches[-1])
        return pipe
    finally:
        spark.conf.set(NO_DATA_BATCHES, before)
        remove(spark, staged)
        remove(spark, inbox)
