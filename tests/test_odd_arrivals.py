"""Replays of orders without an id or a time, and of re-sent orders whose ids do not follow time."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shoppulse.streaming.replay import range_batches, resent_batches
from test_shared_folder import START, matches_sql, write_tables

EVENTS = "event_id long, ts timestamp_ntz, user_id long, value double, props string"


@pytest.fixture(scope="module")
def with_gaps(spark, tmp_path_factory):
    """Ids start over in time twice; one event has no id, late in the table's span, one no time."""
    folder = write_tables(spark, f"{tmp_path_factory.mktemp('gaps')}/sf", lambda i: 60 * (i % 134) + i // 134)
    odd = [(None, START + dt.timedelta(minutes=8000), 3, 5.5, '{"k": 1}'), (401, None, 4, 6.5, '{"k": 2}')]
    spark.createDataFrame(odd, EVENTS).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    return folder


def test_late_rows_with_orders_whose_arrival_nobody_knows(spark, with_gaps):
    assert matches_sql(spark, with_gaps, "stream_late_rows")


def test_resent_orders_whose_ids_do_not_follow_time(spark, with_gaps):
    assert matches_sql(spark, with_gaps, "stream_resent_within")


@pytest.mark.parametrize("copies", [1, 4])
def test_the_last_batch_is_judged_by_the_time_of_all_ranges_before_it(spark, copies):
    rows = [(i, START + dt.timedelta(minutes=7 * (i % (400 // copies)))) for i in range(400)]
    rows += [(None, START + dt.timedelta(days=90)), (7, None), (None, None)]
    frame = spark.createDataFrame(rows, "k long, t timestamp")
    got = resent_batches(frame, "t", "k", 10, "b").collect()
    assert len(got) == len(rows) and all(0 <= r["b"] <= 9 for r in got)
    timed = [r for r in got if r["k"] is not None and r["t"] is not None]
    ranges = frame.withColumn("b", range_batches(frame, "k", 10)).filter("b < 9")
    upto = {b: max(r["t"] for r in timed if r["b"] <= b) for b in range(10)}
    assert upto[8] == ranges.agg(F.max("t")).first()[0]
    assert {r["b"] for r in timed} == set(range(10))
    assert all(r["t"] > upto[r["b"] - 2] for r in timed if r["b"] >= 2)  # none is late
