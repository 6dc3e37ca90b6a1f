"""Streaming queries for windowed GMV, running totals and active users.

Two layouts:
- ``single`` (default): one query - watermark, dedup - whose micro-batch callback joins
  the dimension (planned and sized for that batch) and writes all three ledgers.
  The source is read once, one
  dedup state is kept, the window GMV needs no state (per-batch partial sums,
  summed on read), and the three metrics share batch ids, so they are
  consistent with each other.
  A further append-mode query can emit each window once, when it is closed.
- ``three``: as the reference - an update-mode stateful window query and two
  append-mode dedup queries, each with its own source offsets and state.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import EXACT_LEDGER, WITHIN_WATERMARK, dedup_stream
from ..operators.joins import enrich_orders
from ..operators.windows import window_aggregate
from ..schemas import MONEY, TRIGGER_INTERVAL, WATERMARK_DELAY, WINDOW_LENGTH, WINDOW_SLIDE
from ..session import checkpoint_root
from ..sources.dimension import DimensionSnapshots
from .late_rows import LateRows
from .ledger import CLOSED, DAYS, LATE, SEEN, TOTALS, USERS, WINDOW_SUMS, WINDOWS, Ledger
from .seen import SeenIds


@dataclass
class StreamConfig:
    name: str = "shoppulse"
    dedup_mode: str = WITHIN_WATERMARK
    watermark: str = WATERMARK_DELAY
    window_length: str = WINDOW_LENGTH
    window_slide: str = WINDOW_SLIDE
    trigger: dict = field(default_factory=lambda: {"processingTime": TRIGGER_INTERVAL})
    offset_hours: int = 0
    compact_every: int = 100
    seen_fold_every: int = 10  # batches whose ids become one run (``exact_ledger`` dedup)
    layout: str = "single"
    # Shuffle / state partitions of the stateful operators.  Fixed in the
    # checkpoint at the first start (AQE does not resize streaming shuffles);
    # default: the cluster's default parallelism (total executor cores).
    state_partitions: int | None = None
    root: str | None = None  # shared folder; default <spark.checkpoint.dir>/<name>
    closed_windows: bool = False  # a further query emits each window once, when it is closed
    late_rows: bool = True  # publish the rows dropped behind the watermark, by micro-batch


@dataclass
class MetricStreams:
    ledger: Ledger
    queries: dict[str, StreamingQuery]
    spark: SparkSession | None = None
    late: LateRows | None = None
    listener: object | None = None

    def process_all_available(self) -> None:
        for q in self.queries.values():
            q.processAllAvailable()

    def stop(self) -> None:
        for q in self.queries.values():
            q.stop()
        self.settle()

    def await_all(self) -> None:
        """Wait until every query has ended (``availableNow``); re-raise a failure."""
        for q in self.queries.values():
            q.awaitTermination()
        self.settle()

    def settle(self) -> None:
        """Publish what ended queries still report of late rows, and stop listening."""
        if self.late is not None:
            if self.listener is not None:
                self.spark.streams.removeListener(self.listener)
                self.listener = None
            self.late.flush(next(iter(self.queries.values())))

    def watermark(self) -> str | None:
        """The lowest current event-time watermark of the queries, as timestamp text.

        Windows ending at or before it are closed; pass it to
        ``views.latest_closed_window`` to serve complete windows only.
        """
        marks = []
        for q in self.queries.values():
            progress = q.lastProgress or {}
            mark = (progress.get("eventTime") or {}).get("watermark")
            if mark:
                marks.append(mark.replace("T", " ").rstrip("Z"))
        return min(marks) if marks else None

    def await_any(self, timeout: float | None = None) -> bool:
        """Block until one of this pipeline's queries ends; re-raise its failure.

        Only this pipeline's queries count (the session-wide manager would also
        report queries that ended earlier).  False if ``timeout`` seconds pass.
        """
        deadline = None if timeout is None else time.monotonic() + timeout
        while True:
            for q in self.queries.values():
                if not q.isActive:
                    failure = q.exception()
                    if failure is not None:
                        raise failure
                    return True
            if deadline is not None and time.monotonic() >= deadline:
                return False
            next(iter(self.queries.values())).awaitTermination(0.5)


def dedup_query(orders: DataFrame, cfg: StreamConfig) -> DataFrame:
    """Watermarked, deduplicated orders; money is summed exactly (the topic carries JSON numbers)."""
    return dedup_stream(
        orders.withColumn("amount", F.col("amount").try_cast(MONEY)), cfg.dedup_mode, delay=cfg.watermark
    )


def window_query(dedup: DataFrame, dim: DataFrame, cfg: StreamConfig) -> DataFrame:
    """Window aggregate over enriched orders, kept in state."""
    return window_aggregate(enrich_orders(dedup, dim), cfg.window_length, cfg.window_slide)


def build_queries(orders: DataFrame, dim: DataFrame, cfg: StreamConfig) -> dict[str, DataFrame]:
    """The streaming plans (before sinks): ``win`` over enriched orders, ``dedup`` for the rest.

    Each started query keeps its own watermark, offsets and dedup state, as in
    the reference; the three are not snapshot-consistent with each other.
    """
    dedup = dedup_query(orders, cfg)
    return {"win": window_query(dedup, dim, cfg), "dedup": dedup}


def start_streams(
    spark: SparkSession,
    orders: DataFrame,
    dim: DataFrame | DimensionSnapshots,
    cfg: StreamConfig | None = None,
) -> MetricStreams:
    """Start the streaming queries into a batch-keyed ledger.

    ``orders`` is a streaming frame with order_id, user_id, sku_id, amount
    (any numeric), event_time (TIMESTAMP).  ``dim`` is a static frame, not
    cached, so each micro-batch joins the dimension as it is at that trigger (a JDBC table
    is read anew; of a folder of files the listing stays that of the start), or
    ``DimensionSnapshots``, whose newest snapshot each micro-batch of the single-query
    layout looks up.  Queries that keep windows in state use the snapshot of their start.
    """
    cfg = cfg or StreamConfig()
    root = (cfg.root or f"{checkpoint_root(spark)}/{cfg.name}").rstrip("/")
    single = cfg.layout == "single"
    if cfg.layout not in ("single", "three"):
        raise ValueError(f"unknown layout {cfg.layout!r}")
    if cfg.dedup_mode == EXACT_LEDGER and not single:
        raise ValueError("exact_ledger dedup happens in the sink and needs the single-query layout")
    ledger = Ledger(
        f"{root}/ledger",
        cfg.offset_hours,
        cfg.compact_every,
        windows_kind=WINDOW_SUMS if single else WINDOWS,
        window_length=cfg.window_length,
        window_slide=cfg.window_slide,
    )
    versioned = isinstance(dim, DimensionSnapshots)
    current = (lambda: dim.current(spark)) if versioned else (lambda: dim)
    dedup = dedup_query(orders, cfg)

    def start(df: DataFrame, name: str, sink, mode: str, kinds: list[str]) -> StreamingQuery:
        checkpoint = f"{root}/checkpoint/{name}"
        ledger.bind(spark, kinds, checkpoint)
        return (
            df.writeStream.outputMode(mode)
            .foreachBatch(sink)
            .option("checkpointLocation", checkpoint)
            .trigger(**cfg.trigger)
            .queryName(f"{cfg.name}_{name}")
            .start()
        )

    parts_key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(parts_key)
    spark.conf.set(parts_key, str(cfg.state_partitions or default_parallelism(spark)))
    try:
        if single:

            kinds = [WINDOW_SUMS, TOTALS, DAYS, USERS, LATE]
            if cfg.dedup_mode == EXACT_LEDGER:
                kinds.append(SEEN)

            def write_enriched(batch_df: DataFrame, batch_id: int) -> None:
                # joined per micro-batch: the dimension is planned anew each time
                if cfg.dedup_mode != EXACT_LEDGER:
                    return ledger.write_all(enrich_orders(batch_df, current()), batch_id)
                seen = SeenIds(ledger.folder(SEEN), cfg.seen_fold_every)
                batch_df.persist()
                try:
                    fresh = seen.new_rows(batch_df, "order_id", batch_id).persist()
                    ledger.write_all(enrich_orders(fresh, current()), batch_id)
                    seen.write(fresh, "order_id", batch_id)
                    fresh.unpersist()
                finally:
                    seen.release()
                    batch_df.unpersist()

            queries = {"all": start(dedup, "all", write_enriched, "append", kinds)}
        else:
            queries = {
                "total": start(dedup, "total", ledger.write_running, "append", [TOTALS, DAYS, LATE]),
                "win": start(window_query(dedup, current(), cfg), "win", ledger.write_windows, "update", [WINDOWS]),
                "dau": start(dedup, "dau", ledger.write_users, "append", [USERS]),
            }
        if cfg.closed_windows:
            closed = window_query(dedup, current(), cfg)
            queries["closed"] = start(closed, "closed", ledger.write_closed, "append", [CLOSED])
    finally:
        spark.conf.set(parts_key, before)
    pipe = MetricStreams(ledger, queries, spark)
    if cfg.late_rows:
        pipe.late = LateRows(spark, ledger.folder(LATE))
        first = next(iter(queries.values()))
        pipe.listener = pipe.late.listener(str(first.id))
        spark.streams.addListener(pipe.listener)
    return pipe


def default_parallelism(spark: SparkSession) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # no SparkContext in this client (Spark Connect)
        return int(spark.conf.get("spark.default.parallelism", "8"))
