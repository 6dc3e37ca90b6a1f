"""Positions and running figures without a global window; order of sorted results."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001
from shoppulse.operators.late import batch_watermarks
from shoppulse.operators.ordered import ordered
from shoppulse.plans import catalog, views


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ordered_against_sorted(spark):
    r = random.Random(4)
    rows = [(i, r.choice([None, *range(9)]), r.choice([None, r.randint(-50, 50)])) for i in range(400)]
    rows += [(1000 + i, 3, 1) for i in range(200)]  # one key holds a third of the rows
    frame = spark.createDataFrame(rows, "id long, k int, v int").repartition(5)
    got = ordered(frame, [F.desc("k"), "id"], {"s": ("sum", "v"), "m": ("max", "v"), "l": ("min", "v")}, ranges=6).collect()
    want = sorted(rows, key=lambda x: (x[1] is None, -(x[1] or 0), x[0]))
    got.sort(key=lambda x: x["position"])
    assert [x["id"] for x in got] == [x[0] for x in want] and [x["position"] for x in got] == list(range(1, 601))
    seen = []
    for x, (_, _, v) in zip(got, want):
        seen += [] if v is None else [v]
        assert (x["s"], x["m"], x["l"]) == ((sum(seen), max(seen), min(seen)) if seen else (None, None, None))
    empty = ordered(frame.limit(0), ["id"], {"s": ("sum", "v")})
    assert empty.columns == ["id", "k", "v", "position", "s"] and empty.collect() == []


def test_a_million_categories_are_ranked_range_by_range(spark):
    n = 1_000_000
    points = spark.range(n).select(
        F.lit("2024-01-01").cast("timestamp_ntz").alias("window_start"),
        F.lit("2024-01-02").cast("timestamp_ntz").alias("window_end"),
        F.concat(F.lit("c"), F.col("id")).alias("category"),
        F.pmod(F.xxhash64("id"), F.lit(5000)).cast("double").alias("gmv"),  # many ties
    )
    board = views.category_rank(points, ranges=8)
    one = points.withColumn("want", F.row_number().over(Window.orderBy(F.desc("gmv"), "category")))
    both = board.join(one.select("category", "want"), "category")
    assert both.count() == n and both.filter(F.col("rank") != F.col("want")).count() == 0
    # the rows themselves are never brought together: only one row a range and one sum are
    text = plan(board)
    for part in text.split("Exchange SinglePartition")[1:]:
        nearest = next(line for line in part.split("\n")[1:] if "HashAggregate" in line or "Window" in line)
        assert "HashAggregate" in nearest


def test_watermarks_range_by_range(spark):
    raw = catalog._orders_with_event_id(spark, SF001)
    arrivals = raw.withColumn("batch", catalog.scrambled_arrival_batch(F.col("_eid"), F.col("event_time")))
    one, cut = batch_watermarks(arrivals), batch_watermarks(arrivals, ranges=7)
    assert one.count() == cut.count() > 500
    assert one.exceptAll(cut).count() == 0


def test_sku_rank_never_gathers_the_products(spark):
    board = catalog.q_sku_rank(spark, SF001)
    rows = sorted(board.collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    assert all(a["gmv"] >= b["gmv"] and a["gmv_upto"] < b["gmv_upto"] for a, b in zip(rows, rows[1:]))
    assert "rangepartitioning" not in plan(board)  # it was written once and is read back


@pytest.mark.parametrize(
    "name, key",
    [
        ("trend_long", lambda r: (r["category"], r["window_start"])),
        ("latest_window", lambda r: (-r["gmv"], r["category"])),
        ("category_top_k", lambda r: r["rank"]),
        ("dim_head", lambda r: r["id"]),
    ],
)
def test_sorted_results_come_in_order(spark, name, key):
    rows = catalog.QUERIES[name](spark, SF001).collect()
    assert len(rows) > 1 and rows == sorted(rows, key=key)
