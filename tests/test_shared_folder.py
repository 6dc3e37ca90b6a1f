"""The shared folder as ``spark-defaults.conf`` names it, and replays of events whose ids do not follow time."""

import datetime as dt
import json

import pytest

import oracle_check
from oracle_check import digest, duck
from shoppulse import session
from shoppulse.plans import catalog
from shoppulse.plans.oracle import SQL
from shoppulse.streaming.replay import time_batches

oracle_check.EXACT = True
START = dt.datetime(2024, 1, 1)
REPLAYED = [n for n in catalog.QUERIES if n.startswith("stream_") or n == "window_store"]


def write_tables(spark, folder, minute):
    """Small tables; event ``i`` happens ``minute(i)`` minutes after START."""
    events = [
        (i, START + dt.timedelta(minutes=minute(i), seconds=i % 60), i % 7, float(i % 90) + 0.25, json.dumps({"k": i % 5}))
        for i in range(400)
    ]
    parts = [(k, f"part {k}", f"type {k % 3}", 10.0 + k) for k in range(1, 5)]
    heads = [(o, START + dt.timedelta(days=o)) for o in range(1, 9)]
    lines = [(o, n, START + dt.timedelta(days=o + n), 1 + (o + n) % 4, 10.0 * o + n, 0.25) for o in range(1, 9) for n in (1, 1, 2, 3)]
    for name, rows, schema in (
        ("events", events, "event_id long, ts timestamp_ntz, user_id long, value double, props string"),
        ("part", parts, "p_partkey long, p_name string, p_type string, p_retailprice double"),
        ("orders", heads, "o_orderkey long, o_orderdate timestamp_ntz"),
        ("lineitem", lines, "l_orderkey long, l_linenumber int, l_shipdate timestamp_ntz, l_partkey long, l_extendedprice double, l_discount double"),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def matches_sql(spark, folder, name):
    df = catalog.QUERIES[name](spark, folder)
    con = duck_of_folders(folder)
    res = con.execute(SQL[name])
    want = res.fetchall()
    got = [tuple(r) for r in df.collect()]
    return len(want) > 0 and digest(df.columns, got) == digest([d[0] for d in res.description], want)


def duck_of_folders(folder):
    con = duck("/nowhere")
    for name in ("events", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    return con


@pytest.fixture(scope="module")
def in_time(spark, tmp_path_factory):
    return write_tables(spark, f"{tmp_path_factory.mktemp('in_time')}/sf", lambda i: 20 * i)


@pytest.fixture()
def cluster(spark, monkeypatch):
    """The session counts as a cluster; its shared folder is named without a scheme."""
    monkeypatch.setattr(session, "is_local", lambda spark: False)
    folder = session.checkpoint_root(spark)
    assert folder.startswith("/")
    return folder


def test_a_named_folder_is_taken_as_it_is(spark, cluster):
    assert session.ensure_checkpoint_dir(spark) == cluster


@pytest.mark.parametrize("name", ["sku_rank", *REPLAYED])
def test_queries_write_to_a_folder_without_a_scheme(spark, in_time, cluster, name):
    assert matches_sql(spark, in_time, name)


BY_TIME = sorted({*REPLAYED} - {"stream_resent_within"})


@pytest.fixture(scope="module")
def three_times(spark, tmp_path_factory):
    """Ids start over in time twice, as in a table made of three copies with shifted ids."""
    return write_tables(spark, f"{tmp_path_factory.mktemp('three_times')}/sf", lambda i: 60 * (i % 134) + i // 134)


@pytest.mark.parametrize("name", BY_TIME)
def test_orders_arrive_by_time_whatever_their_ids(spark, three_times, name):
    assert matches_sql(spark, three_times, name)


def test_time_batches_keep_copies_together(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(i, day + dt.timedelta(hours=100 - i)) for i in range(100)]
    rows += [(7, None), (99, day + dt.timedelta(days=30)), (500, None), (None, day), (None, None)]
    frame = spark.createDataFrame(rows, "k long, t timestamp")
    got = [tuple(r) for r in time_batches(frame, "t", "k", 4, "b").collect()]
    batch = {k: {b for x, _, b in got if x == k} for k, *_ in got}
    assert len(got) == len(rows) and all(len(found) == 1 for found in batch.values())
    assert batch[500] == batch[None] == batch[99] == {0} and batch[7] == batch[0] == {3}
    in_time = [min(batch[k]) for k in range(99, -1, -1)]
    assert in_time == sorted(in_time) and all(20 <= in_time.count(b) <= 30 for b in range(4))
    none = time_batches(frame.filter("t is null"), "t", "k", 4, "b")
    assert [r["b"] for r in none.collect()] == [0, 0, 0]
