"""Read-side views: what the overview/category/trend endpoints and the dashboard compute.

Inputs are DataFrames, so the same view runs over the batch window table or
over the streaming ledger.  ``points`` = (window_start, window_end, category,
gmv) rows as the window store holds them (null GMV is never published).

Scale notes: every per-category result is first reduced with aggregates
(partial + final, so a hot category is combined map-side).  Global orderings
(rank, running totals) only ever run over already-aggregated rows whose count
is bounded by the number of categories, days or axis points - never over raw
orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (
    direction,
    pct_change,
    round_half_up,
    safe_div,
    store_key,
    window_label,
)
from ..operators.joins import enrich_orders
from ..operators.ordered import ordered
from ..operators.totals import business_date
from ..operators.windows import window_gmv
from ..schemas import FEED_MAX_ITEMS, TOP_K, WATERMARK_DELAY, WINDOW_LENGTH, WINDOW_SLIDE


def window_points(windows: DataFrame) -> DataFrame:
    """Window rows as published: GMV present (a window of null amounts is skipped)."""
    return windows.filter(F.col("gmv").isNotNull()).select(
        "window_start", "window_end", "category", "gmv"
    )


def window_store(points: DataFrame) -> DataFrame:
    """The per-category window hash as a table: store_key, category, window_start, gmv."""
    return points.select(
        store_key(F.col("category")).alias("store_key"), "category", "window_start", "gmv"
    )


def latest_window(points: DataFrame) -> DataFrame:
    """Per category: the window with the greatest start and its GMV, by GMV desc."""
    return (
        points.groupBy("category")
        .agg(
            F.max("window_start").alias("window_start"),
            F.max_by("gmv", "window_start").alias("gmv"),
        )
        .select("category", "window_start", window_label(F.col("window_start")).alias("window"), "gmv")
        .orderBy(F.desc("gmv"), "category")
    )


def event_watermark(orders: DataFrame, delay: str = WATERMARK_DELAY) -> Column:
    """Max event time minus the watermark delay (cut to ms), as a scalar subquery."""
    bound = F.date_trunc("millisecond", F.max("event_time")) - F.expr(f"INTERVAL {delay}")
    return orders.agg(bound.alias("as_of")).scalar()


def latest_closed_window(points: DataFrame, as_of: Column | str | None) -> DataFrame:
    """Like ``latest_window`` but only over complete windows (end <= as-of time).

    ``as_of`` is an expression or timestamp text; without one no window is complete.
    """
    bound = (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast(
        points.schema["window_end"].dataType
    )
    return latest_window(points.filter(F.col("window_end") <= bound))


def trend_long(points: DataFrame) -> DataFrame:
    """Tidy trend series: category, window_start, gmv (sorted by category, time)."""
    return points.select("category", "window_start", "gmv").orderBy("category", "window_start")


def trend_arrays(points: DataFrame) -> DataFrame:
    """Per category and day: ordered window labels and GMV values.

    The store returns one unbounded array pair per category; here the arrays
    are cut per day (at most 1440 one-minute windows each), so no group grows
    with the length of the history.
    """
    pairs = F.sort_array(F.collect_list(F.struct("window_start", "gmv")))
    return (
        points.groupBy("category", F.to_date("window_start").alias("dt"))
        .agg(pairs.alias("_pts"))
        .select(
            "category",
            "dt",
            F.transform("_pts", lambda p: window_label(p["window_start"])).alias("times"),
            F.transform("_pts", lambda p: p["gmv"]).alias("values"),
        )
    )


def trend_from_arrays(arrays: DataFrame) -> DataFrame:
    """Arrays back to tidy rows (zip times with values, explode)."""
    return arrays.select(
        "category", "dt", F.explode(F.arrays_zip("times", "values")).alias("p")
    ).select("category", "dt", F.col("p.times").alias("time"), F.col("p.values").alias("gmv"))


def trend_arrays_last_n(arrays: DataFrame, n: int | None) -> DataFrame:
    """Keep the last ``n`` entries of each times/values pair (all when n is None)."""
    if n is None:
        return arrays

    def tail(col: str):
        size = F.size(col)
        return F.when(size > n, F.slice(col, -n, n)).otherwise(F.col(col)).alias(col)

    return arrays.select(*[c for c in arrays.columns if c not in ("times", "values")],
                         tail("times"), tail("values"))


def trend_lookup(arrays: DataFrame) -> DataFrame:
    """times/values as a map (label -> GMV) per row, for lookups by window label."""
    return arrays.select(
        *[c for c in arrays.columns if c not in ("times", "values")],
        F.map_from_arrays("times", "values").alias("gmv_by_time"),
    )


def _aligned(axis: DataFrame, points: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    """Every category at every axis point, null where it has no window.

    The categories (a catalogue's few names) are generated onto the axis rows, so no join
    is needed to pair them; the values then come in by an equi-join.
    """
    named = points if categories is None else categories
    names = named.agg(F.array_sort(F.collect_set("category")).alias("names")).scalar()
    grid = axis.select("window_start", F.explode(names).alias("category"))
    return grid.join(
        points.select("window_start", "category", "gmv"), ["window_start", "category"], "left"
    )


def trend_aligned(points: DataFrame) -> DataFrame:
    """The aligned trend over the whole axis; ``trend_long`` is its sparse form."""
    return _aligned(points.select("window_start").distinct(), points)


def trend_last_n(points: DataFrame, n: int | None = 60) -> DataFrame:
    """The aligned trend over the last ``n`` axis points (None = all).

    The axis is cut first, so the grid and the values joined to it are only those of
    ``n`` points, however long the history is.
    """
    if n is None:
        return trend_aligned(points)
    axis = points.select("window_start").distinct().orderBy(F.desc("window_start")).limit(n)
    return _aligned(axis, points)


def recent_trend(
    orders: DataFrame,
    dim: DataFrame,
    n: int,
    length: str = WINDOW_LENGTH,
    slide: str = WINDOW_SLIDE,
) -> DataFrame:
    """``trend_last_n`` straight from orders: only the last ``n`` windows are aggregated.

    The axis comes from event times alone, and its first point bounds the event times below
    the catalogue join and the window aggregate; the categories come from the distinct
    products.  So the history costs a pass over two columns, however long it is.
    """
    sold = orders.filter("amount is not null and event_time is not null")
    start = F.window("event_time", length, slide)["start"].cast("timestamp_ntz")
    axis = sold.select(start.alias("window_start")).distinct().orderBy(F.desc("window_start")).limit(n)
    bound = axis.agg(F.min("window_start")).scalar()
    recent = orders.filter(F.col("event_time").cast("timestamp_ntz") >= bound)
    points = window_points(window_gmv(enrich_orders(recent, dim), length, slide))
    categories = enrich_orders(sold.select("sku_id").distinct(), dim).select("category")
    return _aligned(axis, points.filter(F.col("window_start") >= bound), categories)


def category_rank(points: DataFrame, ranges: int | None = None) -> DataFrame:
    """Ranking board: latest GMV per category, change versus its previous window, share.

    rank, category, gmv, trend_pct, direction, share_pct.  Only the two newest windows of
    a category leave each task (the rank limit is applied before the shuffle).  The ranking
    itself orders one row a category in one task; with very many categories, ``ranges``
    cuts the order into that many ranges instead (``operators.ordered``).
    """
    newest = Window.partitionBy("category").orderBy(F.desc("window_start"))
    two = points.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= 2)
    board = two.groupBy("category").agg(
        F.coalesce(F.max(F.when(F.col("_n") == 1, F.col("gmv"))), F.lit(0.0)).alias("gmv"),
        F.max(F.when(F.col("_n") == 2, F.col("gmv"))).alias("_prev"),
    )
    trend = pct_change(F.col("_prev"), F.col("gmv"))
    if ranges:
        board = ordered(board, [F.desc("gmv"), "category"], position="_rank", ranges=ranges)
        rank, total = F.col("_rank"), board.agg(F.sum("gmv")).scalar()
    else:
        rank = F.row_number().over(Window.orderBy(F.desc("gmv"), "category"))
        total = F.sum("gmv").over(Window.partitionBy())
    return board.select(
        rank.cast("bigint").alias("rank"),
        "category",
        "gmv",
        round_half_up(trend, 1).alias("trend_pct"),
        direction(trend).alias("direction"),
        F.when(total > 0, round_half_up(F.col("gmv") / total * F.lit(100.0), 1))
        .otherwise(F.lit(0.0))
        .alias("share_pct"),
    )


def sku_rank(orders: DataFrame, ranges: int | None = None) -> DataFrame:
    """All products by revenue: rank, sku_id, gmv, and what the best ones up to it sold.

    One row a product, so the board grows with the catalogue: ranks and running sums are
    taken range by range, and no task holds them all.
    """
    sold = orders.groupBy("sku_id").agg(F.sum("amount").alias("_gmv")).filter("_gmv is not null")
    board = ordered(
        sold, [F.desc("_gmv"), "sku_id"], {"_upto": ("sum", "_gmv")}, position="rank", ranges=ranges
    )
    return board.select(
        "rank", "sku_id", F.col("_gmv").cast("double").alias("gmv"), F.col("_upto").cast("double").alias("gmv_upto")
    )


def category_top_k(rank: DataFrame, k: int | None = TOP_K) -> DataFrame:
    ordered = rank.orderBy("rank")
    return ordered if k is None else ordered.limit(k)


def overview(orders: DataFrame) -> DataFrame:
    """gmv_total, order_total, dau, aov (zero when there are no orders)."""
    return orders.agg(
        F.coalesce(F.sum("amount"), F.lit(0)).cast("double").alias("gmv_total"),
        F.count("order_id").alias("order_total"),
        F.count_distinct("user_id").alias("dau"),
    ).withColumn("aov", safe_div(F.col("gmv_total"), F.col("order_total")))


def kpi_trend(orders: DataFrame, offset_hours: int = 0) -> DataFrame:
    """Overview as it stood at the end of each day, with % change versus the day before.

    One shuffle reduces orders to (day, user) rows; both the daily totals and
    each user's first-seen day are read from that (the shared exchange is
    reused).  Totals are running sums of exact daily decimals; DAU is the
    running count of users by the day each was first seen.  The running window
    then orders one row per day.
    """
    user_day = orders.groupBy(
        business_date(offset_hours=offset_hours).alias("dt"), "user_id"
    ).agg(F.sum("amount").alias("_gmv"), F.count("order_id").alias("_orders"))
    daily = user_day.groupBy("dt").agg(
        F.sum("_gmv").alias("_gmv_d"), F.sum("_orders").alias("_orders_d")
    )
    first_seen = (
        user_day.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.min("dt").alias("dt"))
        .groupBy("dt")
        .agg(F.count(F.lit(1)).alias("_new_users"))
    )
    return kpi_snapshots(
        daily.toDF("dt", "gmv", "orders"), first_seen.toDF("dt", "new_users")
    )


def kpi_snapshots(daily: DataFrame, new_users: DataFrame) -> DataFrame:
    """Running totals and their change by day, from daily totals and users first seen that day.

    ``daily`` (dt, gmv, orders) and ``new_users`` (dt, new_users) have one row a day, so the
    running windows order days, however many orders there are.
    """
    upto = Window.orderBy("dt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    snap = (
        daily.join(new_users, "dt", "full")
        .select(
            "dt",
            F.sum(F.coalesce("gmv", F.lit(0))).over(upto).cast("double").alias("gmv"),
            F.sum(F.coalesce("orders", F.lit(0))).over(upto).cast("bigint").alias("orders"),
            F.sum(F.coalesce("new_users", F.lit(0))).over(upto).cast("bigint").alias("dau"),
        )
        .withColumn("aov", safe_div(F.col("gmv"), F.col("orders")))
    )
    prev = Window.orderBy("dt")
    prev_aov = F.when(F.lag("orders").over(prev) > 0, F.lag("aov").over(prev))
    return snap.select(
        "dt",
        "gmv",
        "orders",
        "dau",
        "aov",
        pct_change(F.lag("gmv").over(prev), F.col("gmv")).alias("gmv_pct"),
        pct_change(F.lag("orders").over(prev), F.col("orders")).alias("orders_pct"),
        pct_change(F.lag("dau").over(prev), F.col("dau")).alias("dau_pct"),
        pct_change(prev_aov, F.col("aov")).alias("aov_pct"),
    )


def activity_deltas(kpi: DataFrame, max_items: int = FEED_MAX_ITEMS) -> DataFrame:
    """New orders / new users between consecutive snapshots; feed items shown (capped)."""
    prev = Window.orderBy("dt")
    deltas = kpi.select(
        "dt",
        (F.col("orders") - F.lag("orders").over(prev)).alias("new_orders"),
        (F.col("dau") - F.lag("dau").over(prev)).alias("new_users"),
    ).filter(F.col("new_orders").isNotNull())
    return deltas.withColumn(
        "shown",
        F.when(F.col("new_orders") > 0, F.least(F.col("new_orders"), F.lit(max_items)))
        .otherwise(F.lit(0))
        .cast("bigint"),
    )


def metrics_combined(orders: DataFrame, points: DataFrame) -> DataFrame:
    """The combined payload as rows: the overview beside every window of every category.

    One row per (category, window) with its start in epoch milliseconds; the overview's
    single row is read as scalars.
    """
    head = overview(orders)
    return points.select(
        "category",
        F.to_date("window_start").alias("dt"),
        window_label(F.col("window_start")).alias("window"),
        F.unix_millis(F.col("window_start").cast("timestamp")).alias("window_ms"),
        "gmv",
        *(head.select(c).scalar().alias(c) for c in ("gmv_total", "order_total", "dau")),
    )
