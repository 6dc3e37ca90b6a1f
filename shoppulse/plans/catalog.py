"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the whole given tables (``events``, ``part``, ``lineitem``,
``orders``) or data Spark derives from them.  Money columns are exact decimal
sums cast to double at the end; timestamps are TIMESTAMP_NTZ like the input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import decode_orders, encode_orders
from ..operators.dedup import EXACT, EXACT_LEDGER, WITHIN_WATERMARK, first_arrival
from ..operators.joins import enrich_orders
from ..operators.late import JITTER_MULTIPLIER, late_counts, scrambled_arrival_batch
from ..operators.totals import active_users, batch_deltas, totals
from ..operators.windows import window_gmv
from ..schemas import DIM_SAMPLE_IDS, MONEY, TOP_K
from ..sources.dimension import key_violations, sku_catalogue, sku_dimension
from ..sources.tables import (
    DUPLICATE_EVERY,
    orders,
    orders_from_events,
    read_table,
    session_key,
)
from ..session import ensure_checkpoint_dir
from ..storage import version
from ..streaming.streams import StreamConfig
from ..streaming.replay import replay, resent_batches, time_batches
from . import views

# Events per arrival batch in ``batch_deltas`` (the reference caps intake at
# 1000 offsets per trigger), and the number of micro-batches a table is
# replayed in through the streaming pipeline.
ROWS_PER_BATCH = 1000
REPLAY_BATCHES = 10
RESENT_DAYS = 40  # a re-sent order's new event time is later than every original's
TREND_POINTS = 60
# A scrambled arrival in few micro-batches: orders come up to six days late, three days at a time.
LATE_SECONDS = 6 * 86_400
LATE_SLOT_SECONDS = 3 * 86_400


# -- shared building blocks ------------------------------------------------------
def _dedup(spark: SparkSession, sf: str) -> DataFrame:
    return first_arrival(orders(spark, sf))


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enrich_orders(_dedup(spark, sf), _part(spark, sf))


def _windows(spark: SparkSession, sf: str) -> DataFrame:
    return window_gmv(_enriched(spark, sf))


def _points(spark: SparkSession, sf: str) -> DataFrame:
    return views.window_points(_windows(spark, sf))


def _part(spark: SparkSession, sf: str) -> DataFrame:
    """The whole catalogue, which order events join to."""
    return sku_catalogue(read_table(spark, sf, "part"))


def _money_as_double(df: DataFrame, col: str = "amount") -> DataFrame:
    return df.withColumn(col, F.col(col).cast("double"))


def _catalogue(spark: SparkSession, sf: str) -> DataFrame:
    return _money_as_double(sku_catalogue(read_table(spark, sf, "part")), "price")


# -- dimension -------------------------------------------------------------------
def q_dim_scan(spark, sf):
    return _catalogue(spark, sf)


def q_dim_seed(spark, sf):
    return _money_as_double(sku_dimension(spark, sf), "price")


def q_dim_lookup(spark, sf):
    return _catalogue(spark, sf).filter(F.col("id").isin(*DIM_SAMPLE_IDS))


def q_dim_head(spark, sf):
    return _catalogue(spark, sf).orderBy("id").limit(3)


def q_dim_stats(spark, sf):
    return _catalogue(spark, sf).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min("id").alias("min_id"),
        F.max("id").alias("max_id"),
    )


def q_dim_by_category(spark, sf):
    return _catalogue(spark, sf).groupBy("category").agg(F.count(F.lit(1)).alias("cnt"))


def q_dim_key_violations(spark, sf):
    return key_violations(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# -- order events ------------------------------------------------------------------
def q_orders_as_json(spark, sf):
    return encode_orders(orders(spark, sf))


def q_decode_orders(spark, sf):
    decoded = decode_orders(encode_orders(orders(spark, sf)), "json")
    return decoded.select(
        "order_id",
        "user_id",
        "sku_id",
        "amount",
        F.col("event_time").cast("timestamp_ntz").alias("event_time"),
    )


def q_dedup_orders(spark, sf):
    return _money_as_double(_dedup(spark, sf))


def q_enrich_orders(spark, sf):
    return _money_as_double(_enriched(spark, sf))


def q_window_gmv(spark, sf):
    return _windows(spark, sf)


def q_totals_all(spark, sf):
    return totals(_dedup(spark, sf))


def q_totals_daily(spark, sf):
    return totals(_dedup(spark, sf), by_day=True)


def q_dau_all(spark, sf):
    return active_users(_dedup(spark, sf))


def q_dau_daily(spark, sf):
    return active_users(_dedup(spark, sf), by_day=True)


def _orders_with_event_id(spark, sf):
    events = read_table(spark, sf, "events")
    return orders_from_events(events.withColumn("_eid", F.col("event_id")), keep=("_eid",))


def q_batch_deltas(spark, sf):
    """Per arrival batch (consecutive event-id ranges): what the three sinks receive."""
    deduped = first_arrival(_orders_with_event_id(spark, sf))
    return batch_deltas(deduped, F.floor(F.col("_eid") / ROWS_PER_BATCH).cast("bigint"))


def q_late_orders(spark, sf):
    """Late rows per data batch for a scrambled arrival order of the raw orders."""
    raw = _orders_with_event_id(spark, sf)
    arrivals = raw.withColumn("batch", scrambled_arrival_batch(F.col("_eid"), F.col("event_time")))
    return late_counts(arrivals, "batch")


# One streaming run per session and state of the events and part tables: the ledger views below
# read the ledgers it wrote (written tables in the shared checkpoint folder).
_REPLAYS: dict[tuple[str, ...], object] = {}


def streamed_ledger(spark: SparkSession, sf: str):
    """Stream the orders through the pipeline as REPLAY_BATCHES arrival batches.

    Runs the streaming pipeline for real: file-stream source, watermark, dedup,
    stream-static join, window / totals / users ledger sinks.  The number of
    micro-batches is fixed, so each grows with the table instead of their count.
    Orders arrive in the order of their event times, whatever that of their ids.
    Re-sent copies arrive in the same batch as the original, so the bounded
    dedup gives the same answer as the exact one.
    """
    tables = (f"{sf.rstrip('/')}/{name}.parquet" for name in ("events", "part"))
    key = (session_key(spark), sf, *(version(spark, path) for path in tables))
    if key not in _REPLAYS:
        ensure_checkpoint_dir(spark)
        raw = _orders_with_event_id(spark, sf).withColumn(
            "event_time", F.col("event_time").cast("timestamp")
        )
        arrivals = time_batches(raw, "event_time", "_eid", REPLAY_BATCHES, "_b")
        cfg = StreamConfig(name="ledger", dedup_mode=WITHIN_WATERMARK, closed_windows=True)
        _REPLAYS[key] = replay(spark, arrivals, F.col("_b"), _part(spark, sf), cfg).ledger
    return _REPLAYS[key]


def q_window_store(spark, sf):
    """The window hash as served: GMV per (window, category) folded from the window ledger."""
    return views.window_store(streamed_ledger(spark, sf).window_rows(spark))


def q_stream_overview(spark, sf):
    """Overview read from the totals and users ledgers of the streaming run."""
    return streamed_ledger(spark, sf).overview(spark).drop("totals_batch_id")


def q_stream_dau_daily(spark, sf):
    """Daily active users read from the users ledger of the streaming run."""
    return streamed_ledger(spark, sf).active_users(spark, by_day=True)


def q_stream_latest_window(spark, sf):
    """The latest-window board served from the streaming window ledger."""
    ledger = streamed_ledger(spark, sf)
    return views.latest_window(views.window_points(ledger.window_rows(spark)))


def q_stream_category_rank(spark, sf):
    """The ranking board served from the streaming window ledger."""
    ledger = streamed_ledger(spark, sf)
    return views.category_rank(views.window_points(ledger.window_rows(spark)))


def q_stream_closed_window(spark, sf):
    """The latest-window board over the windows that the stream has closed, each emitted once."""
    closed = streamed_ledger(spark, sf).closed_windows(spark)
    return views.latest_window(views.window_points(closed))


def q_stream_kpi_trend(spark, sf):
    """Running totals and their change by day, served from the day and user ledgers."""
    return streamed_ledger(spark, sf).kpi_trend(spark)


def q_stream_late_rows(spark, sf):
    """Rows that a real stream drops as late, by micro-batch, as it publishes them.

    Orders arrive up to LATE_SECONDS after their event time, in micro-batches of
    LATE_SLOT_SECONDS of the arrival clock.  Orders without an id or a time, whose arrival
    nobody knows, come after all others, in a micro-batch that is none of the clock's.
    """
    ensure_checkpoint_dir(spark)
    raw = _orders_with_event_id(spark, sf).withColumn("event_time", F.col("event_time").cast("timestamp"))
    delay = (F.col("_eid") * F.lit(JITTER_MULTIPLIER)) % F.lit(LATE_SECONDS)
    arrival = F.col("event_time") + F.make_interval(secs=delay.cast("decimal(18,6)"))
    batch = F.floor(F.unix_micros(arrival) / F.lit(LATE_SLOT_SECONDS * 1_000_000)).cast("bigint")
    slots = raw.agg(F.count_distinct(batch)).first()[0]
    cfg = StreamConfig(name="late", dedup_mode=WITHIN_WATERMARK)
    late = replay(spark, raw, batch, _part(spark, sf), cfg).late.read()
    return late.filter(F.col("batch_id") < slots).select("batch_id", "n")


def _resent_overview(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    """Overview of a stream whose re-sent copies come in a micro-batch of their own, dated anew.

    The originals arrive in REPLAY_BATCHES batches, then every re-sent order once more with
    an event time RESENT_DAYS later, when the bounded dedup has forgotten all orders
    but those near the end.  All take the originals by time, so that none is late.  What the
    bounded dedup still holds depends on the last batches: there they end as ranges of ids do.
    """
    ensure_checkpoint_dir(spark)
    events = read_table(spark, sf, "events")
    raw = orders_from_events(
        events.withColumn("_eid", F.col("event_id")), with_duplicates=False, keep=("_eid",)
    ).withColumn("event_time", F.col("event_time").cast("timestamp"))
    batches = resent_batches if mode == WITHIN_WATERMARK else time_batches
    first = batches(raw, "event_time", "_eid", REPLAY_BATCHES, "_b")
    again = (
        raw.filter(F.col("_eid") % DUPLICATE_EVERY == 0)
        .withColumn("event_time", F.col("event_time") + F.make_interval(days=F.lit(RESENT_DAYS)))
        .withColumn("_b", F.lit(REPLAY_BATCHES).cast("bigint"))
    )
    cfg = StreamConfig(name=f"resent_{mode}", dedup_mode=mode)
    pipe = replay(spark, first.unionByName(again), F.col("_b"), _part(spark, sf), cfg)
    return pipe.ledger.overview(spark).drop("totals_batch_id")


def q_stream_resent_exact(spark, sf):
    """Exact dedup: a copy is dropped however late it comes and whatever its time."""
    return _resent_overview(spark, sf, EXACT)


def q_stream_resent_ledger(spark, sf):
    """Exact dedup with a bounded state store: ids of earlier batches are looked up on disk."""
    return _resent_overview(spark, sf, EXACT_LEDGER)


def q_stream_resent_within(spark, sf):
    """Bounded dedup: copies of orders that the state no longer holds are counted again."""
    return _resent_overview(spark, sf, WITHIN_WATERMARK)


# -- serving views -----------------------------------------------------------------
def q_overview(spark, sf):
    return views.overview(_dedup(spark, sf))


def q_latest_window(spark, sf):
    return views.latest_window(_points(spark, sf))


def q_latest_closed_window(spark, sf):
    return views.latest_closed_window(_points(spark, sf), views.event_watermark(orders(spark, sf)))


def q_trend_long(spark, sf):
    return views.trend_long(_points(spark, sf))


def _array_rows(arrays: DataFrame) -> DataFrame:
    """Array pairs as rows with their position, so that any engine can compare them."""
    zipped = F.posexplode(F.arrays_zip("times", "values")).alias("pos", "p")
    return arrays.select("category", "dt", zipped).select(
        "category", "dt", "pos", F.col("p.times").alias("time"), F.col("p.values").alias("gmv")
    )


def q_trend_arrays(spark, sf):
    return _array_rows(views.trend_arrays(_points(spark, sf)))


def q_trend_arrays_last_n(spark, sf):
    """The last entries of each category's and day's arrays."""
    arrays = views.trend_arrays(_points(spark, sf))
    return _array_rows(views.trend_arrays_last_n(arrays, TREND_POINTS))


def q_trend_lookup(spark, sf):
    """Arrays as a map from window label to GMV, looked up at every full hour."""
    found = views.trend_lookup(views.trend_arrays(_points(spark, sf)))
    hours = F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")
    label = F.format_string("%02d:00", F.col("hour"))
    return found.select("category", "dt", "gmv_by_time", hours).select(
        "category", "dt", "hour", F.try_element_at("gmv_by_time", label).alias("gmv")
    )


def q_trend_aligned(spark, sf):
    return views.trend_aligned(_points(spark, sf))


def q_trend_last_n(spark, sf):
    """The aligned trend of the last axis points, from the orders of those windows alone."""
    return views.recent_trend(_dedup(spark, sf), _part(spark, sf), TREND_POINTS)


def q_category_rank(spark, sf):
    return views.category_rank(_points(spark, sf))


def q_sku_rank(spark, sf):
    """All products by revenue over deduplicated order lines, with running revenue."""
    return views.sku_rank(line_orders(spark, sf))


def q_category_top_k(spark, sf):
    return views.category_top_k(views.category_rank(_points(spark, sf)), TOP_K)


def q_kpi_trend(spark, sf):
    return views.kpi_trend(_dedup(spark, sf))


def q_activity_deltas(spark, sf):
    return views.activity_deltas(views.kpi_trend(_dedup(spark, sf)))


def q_metrics_combined(spark, sf):
    return views.metrics_combined(_dedup(spark, sf), _points(spark, sf))


# -- the same operators on order lines (larger fact table) --------------------------
def line_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as order events: first arrival per (order, line), dated by the order.

    ``lineitem`` repeats (l_orderkey, l_linenumber) with different payloads;
    the earliest ship date wins, ties broken by part, price and discount (only the
    columns that are used are read and shuffled).  The join to ``orders`` is a shuffle join on the order key (both sides grow with
    the data); AQE splits skewed keys.
    """
    used = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_extendedprice", "l_discount"]
    lines = first_arrival_multi(read_table(spark, sf, "lineitem").select(*used))
    heads = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    dated = lines.join(heads, lines["l_orderkey"] == heads["o_orderkey"])
    return dated.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        (
            F.col("l_extendedprice").cast(MONEY)
            * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
        ).alias("amount"),
        F.col("o_orderdate").alias("event_time"),
    )


def first_arrival_multi(lineitem: DataFrame) -> DataFrame:
    return first_arrival(lineitem, key=["l_orderkey", "l_linenumber"], order_by="l_shipdate")


def q_line_window_revenue(spark, sf):
    """5-day / 1-day sliding revenue per part type over deduplicated order lines."""
    enriched = enrich_orders(line_orders(spark, sf), _part(spark, sf))
    return window_gmv(enriched, "5 days", "1 day")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dim_scan": q_dim_scan,
    "dim_seed": q_dim_seed,
    "dim_lookup": q_dim_lookup,
    "dim_head": q_dim_head,
    "dim_stats": q_dim_stats,
    "dim_by_category": q_dim_by_category,
    "dim_key_violations": q_dim_key_violations,
    "orders_as_json": q_orders_as_json,
    "decode_orders": q_decode_orders,
    "dedup_orders": q_dedup_orders,
    "enrich_orders": q_enrich_orders,
    "window_gmv": q_window_gmv,
    "window_store": q_window_store,
    "stream_overview": q_stream_overview,
    "stream_dau_daily": q_stream_dau_daily,
    "stream_latest_window": q_stream_latest_window,
    "stream_category_rank": q_stream_category_rank,
    "stream_closed_window": q_stream_closed_window,
    "stream_kpi_trend": q_stream_kpi_trend,
    "stream_late_rows": q_stream_late_rows,
    "stream_resent_exact": q_stream_resent_exact,
    "stream_resent_ledger": q_stream_resent_ledger,
    "stream_resent_within": q_stream_resent_within,
    "totals_all": q_totals_all,
    "totals_daily": q_totals_daily,
    "dau_all": q_dau_all,
    "dau_daily": q_dau_daily,
    "batch_deltas": q_batch_deltas,
    "late_orders": q_late_orders,
    "overview": q_overview,
    "latest_window": q_latest_window,
    "latest_closed_window": q_latest_closed_window,
    "trend_long": q_trend_long,
    "trend_arrays": q_trend_arrays,
    "trend_arrays_last_n": q_trend_arrays_last_n,
    "trend_lookup": q_trend_lookup,
    "trend_aligned": q_trend_aligned,
    "trend_last_n": q_trend_last_n,
    "category_rank": q_category_rank,
    "category_top_k": q_category_top_k,
    "sku_rank": q_sku_rank,
    "kpi_trend": q_kpi_trend,
    "activity_deltas": q_activity_deltas,
    "metrics_combined": q_metrics_combined,
    "line_window_revenue": q_line_window_revenue,
}

