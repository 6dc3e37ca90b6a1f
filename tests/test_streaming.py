"""Streaming properties: late data, exactly-once ledger, dedup modes, dimension refresh."""

import json
import os
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from shoppulse.operators.dedup import EXACT, WITHIN_WATERMARK
from shoppulse.operators.late import late_counts
from shoppulse.plans import catalog
from shoppulse.sources.dimension import (
    read_jdbc_dimension,
    sku_catalogue,
    sku_dimension,
    write_jdbc_dimension,
)
from shoppulse.sources.streams import file_order_stream
from shoppulse.sources.tables import orders_from_events, read_table
from shoppulse.streaming.ledger import TOTALS, WINDOWS
from shoppulse.streaming.streams import StreamConfig, build_queries, start_streams
from shoppulse.streaming.replay import replay

NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
LAYOUTS = pytest.mark.parametrize("layout", ["single", "three"])


def order(oid, ts, amount=10.0, user=1, sku=1):
    return {"order_id": oid, "user_id": user, "sku_id": sku, "amount": amount, "ts": ts}


class Harness:
    """Start the pipeline on an empty inbox; each ``push`` is exactly one micro-batch."""

    def __init__(self, spark, scratch, dim=None, **cfg):
        self.spark, self.inbox, self.n = spark, os.path.join(scratch, "inbox"), 0
        os.makedirs(self.inbox)
        self.cfg = StreamConfig(
            name="t", root=os.path.join(scratch, "pipe"), trigger={"processingTime": "0 seconds"}, **cfg
        )
        self.dim = dim if dim is not None else spark.createDataFrame(
            [(1, "a", "CAT_A", None), (2, "b", "CAT_B", None)],
            "id long, sku_name string, category string, price decimal(10,2)",
        )
        self.pipe = None

    def start(self):
        before = self.spark.conf.get(NO_DATA, "true")
        self.spark.conf.set(NO_DATA, "false")
        try:
            stream = file_order_stream(self.spark, self.inbox, max_files_per_trigger=1)
            self.pipe = start_streams(self.spark, stream, self.dim, self.cfg)
        finally:
            self.spark.conf.set(NO_DATA, before)
        return self

    def push(self, rows):
        self.n += 1
        tmp = os.path.join(self.inbox, f".tmp-{uuid.uuid4().hex}")
        with open(tmp, "w", encoding="utf-8") as fh:
            for r in rows:
                fh.write((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n")
        os.rename(tmp, os.path.join(self.inbox, f"batch-{self.n:05d}.json"))
        self.pipe.process_all_available()

    def stop(self):
        self.pipe.stop()

    @property
    def ledger(self):
        return self.pipe.ledger


@LAYOUTS
def test_replay_equals_batch(spark, layout):
    sf = SF001
    raw = orders_from_events(read_table(spark, sf, "events"), keep=("event_id",))
    raw = raw.withColumn("event_time", F.col("event_time").cast("timestamp"))
    part = sku_catalogue(read_table(spark, sf, "part"))
    pipe = replay(spark, raw, F.floor(F.col("event_id") / 100).cast("bigint"), part,
                  StreamConfig(name="eq", dedup_mode=EXACT, compact_every=3, layout=layout))
    # 11 batches, compacted at 3, 6 and 9: the snapshot holds all batches before 9
    assert pipe.ledger.latest_snapshot(spark, pipe.ledger.windows_kind) == 8
    cols = ["window_start", "window_end", "category", "gmv", "order_cnt"]
    streamed = pipe.ledger.window_rows(spark).select(*cols)
    batch = catalog.q_window_gmv(spark, sf).select(*cols)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    ov = pipe.ledger.overview(spark).first()
    truth = catalog.q_overview(spark, sf).first()
    assert (ov["gmv_total"], ov["order_total"], ov["dau"]) == (truth["gmv_total"], truth["order_total"], truth["dau"])
    daily = pipe.ledger.active_users(spark, by_day=True)
    assert daily.exceptAll(catalog.q_dau_daily(spark, sf)).count() == 0


@LAYOUTS
def test_late_rows_follow_two_batch_rule_and_leave_every_metric(spark, scratch, layout):
    batches = [
        [order("A1", "2024-01-01 10:00:00")],
        [order("A2", "2024-01-01 10:30:00", user=2)],
        [order("A3", "2024-01-01 10:05:00", user=3), order("L1", "2024-01-01 09:45:00", user=9)],
        [order("L2", "2024-01-01 10:15:00", user=8), order("A4", "2024-01-01 10:25:00", user=4)],
    ]
    h = Harness(spark, scratch, dedup_mode=EXACT, layout=layout).start()
    try:
        for b in batches:
            h.push(b)
    finally:
        h.stop()
    ov = h.ledger.overview(spark).first()
    assert ov["order_total"] == 4 and ov["gmv_total"] == 40.0 and ov["dau"] == 4
    windows = h.ledger.window_rows(spark)
    assert windows.agg(F.max("order_cnt")).first()[0] >= 1
    # L1 (09:45) and L2 (10:15) never reach a window
    assert windows.filter("window_start <= '2024-01-01 09:45:00' AND window_end > '2024-01-01 09:45:00'").count() == 0
    # the batch rule flags exactly the two late rows
    arrivals = spark.createDataFrame(
        [(i, r["order_id"], r["ts"]) for i, b in enumerate(batches) for r in b], "batch long, order_id string, ts string"
    ).withColumn("event_time", F.to_timestamp("ts"))
    late = {r["batch"]: r["n"] for r in late_counts(arrivals).collect()}
    assert late == {0: 0, 1: 0, 2: 1, 3: 1}


def test_crash_after_sink_write_is_replayed_without_double_count(spark, scratch):
    inbox = os.path.join(scratch, "inbox")
    os.makedirs(inbox)
    for i in range(3):
        with open(os.path.join(inbox, f"b{i}.json"), "w") as fh:
            fh.write(json.dumps(order(f"C{i}", f"2024-01-01 10:0{i}:00", amount=5.0)) + "\n")
    cfg = StreamConfig(name="crash", root=os.path.join(scratch, "pipe"))
    from shoppulse.streaming.ledger import Ledger

    ledger = Ledger(os.path.join(scratch, "pipe", "ledger"))
    crashed = {"done": False}

    def flaky(batch_df, batch_id):
        ledger.write_totals(batch_df, batch_id)
        if batch_id == 1 and not crashed["done"]:
            crashed["done"] = True
            raise RuntimeError("crash after the sink write")

    def run(sink):
        stream = file_order_stream(spark, inbox, max_files_per_trigger=1)
        dedup = build_queries(stream, sku_dimension(spark, SF001), cfg)["dedup"]
        q = (
            dedup.writeStream.foreachBatch(sink)
            .option("checkpointLocation", os.path.join(scratch, "pipe", "ckpt-total"))
            .trigger(availableNow=True)
            .start()
        )
        return q

    q = run(flaky)
    with pytest.raises(Exception):
        q.awaitTermination()
    assert crashed["done"]
    q = run(ledger.write_totals)
    q.awaitTermination()
    tot = ledger.totals(spark).first()
    assert (tot["gmv_total"], tot["order_total"]) == (15.0, 3)
    deltas = ledger.read(spark, TOTALS)
    # batch 1 was overwritten, not appended: one row per batch id.  (Spark may add
    # a no-data batch to advance the watermark; its empty delta adds nothing.)
    assert deltas.groupBy("batch_id").count().filter("count > 1").count() == 0
    assert deltas.filter("gmv IS NOT NULL").count() == 3


@LAYOUTS
@pytest.mark.parametrize("mode,expected", [(EXACT, 3), (WITHIN_WATERMARK, 4)])
def test_dedup_modes_on_a_very_late_duplicate(spark, scratch, mode, expected, layout):
    h = Harness(spark, scratch, dedup_mode=mode, layout=layout).start()
    try:
        h.push([order("D1", "2024-01-01 10:00:00"), order("D1", "2024-01-01 10:00:00")])
        h.push([order("D2", "2024-01-01 11:00:00")])
        h.push([order("D3", "2024-01-01 11:30:00")])
        h.push([order("D1", "2024-01-01 12:00:00")])  # same id, fresh event time
    finally:
        h.stop()
    assert h.ledger.totals(spark).first()["order_total"] == expected


@LAYOUTS
def test_dimension_is_reread_each_micro_batch(spark, scratch, layout):
    url = f"jdbc:derby:memory:dimrefresh{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    schema = "id long, sku_name string, category string, price decimal(10,2)"
    write_jdbc_dimension(spark.createDataFrame([(1, "x", "OLD", None)], schema), url, "DIM", props, truncate_first=False)
    dim = read_jdbc_dimension(spark, url, "DIM", props)
    h = Harness(spark, scratch, dim=dim, dedup_mode=EXACT, layout=layout).start()
    try:
        h.push([order("R1", "2024-01-01 10:00:00", sku=1)])
        write_jdbc_dimension(spark.createDataFrame([(1, "x", "NEW", None)], schema), url, "DIM", props)
        h.push([order("R2", "2024-01-01 10:20:00", sku=1)])
    finally:
        h.stop()
    rows = h.ledger.read(spark, h.ledger.windows_kind)
    cats = {(r["batch_id"], r["category"]) for r in rows.collect()}
    assert (0, "OLD") in cats and (1, "NEW") in cats and (1, "OLD") not in cats


@LAYOUTS
def test_nulls_unknown_sku_and_update_mode(spark, scratch, layout):
    h = Harness(spark, scratch, dedup_mode=EXACT, layout=layout).start()
    try:
        h.push([
            order("N1", "2024-01-01 10:00:00", amount=None, sku=2),  # alone in its category window
            order("N2", "2024-01-01 10:00:30", sku=1, user=None),
            order("N3", "2024-01-01 10:01:00", sku=201),  # unmatched SKU
            "{bad",
            '{"order_id":"N4","user_id":5,"sku_id":1,"amount":2.5,"ts":"x"}',
        ])
        h.push([order("N5", "2024-01-01 10:30:00", sku=1, user=6)])
        # null order ids again: the malformed row already took the null key, so
        # (exact dedup, as dropDuplicates) both are duplicates and add nothing
        h.push([order(None, "2024-01-01 10:40:00", amount=1.0, user=7),
                order(None, "2024-01-01 10:40:00", amount=1.0, user=7)])
    finally:
        h.stop()
    served = h.ledger.window_rows(spark)
    assert served.filter("category = 'CAT_B'").count() == 0  # null GMV is not published
    assert served.filter("category = '未知'").count() == 5
    # the second batch only writes the windows it touched
    rows = h.ledger.read(spark, h.ledger.windows_kind)
    assert {r["window_start"].strftime("%H:%M") for r in rows.filter("batch_id = 1").collect()} == {
        "10:26", "10:27", "10:28", "10:29", "10:30"}
    tot = h.ledger.totals(spark).first()
    # N4 (bad ts) is counted in totals but not in windows; the malformed row has no id
    assert tot["order_total"] == 5 and tot["gmv_total"] == 32.5
    assert h.ledger.active_users(spark).first()["dau"] == 3  # null users ignored


@LAYOUTS
def test_midnight_crossing_keeps_full_window_keys(spark, scratch, layout):
    h = Harness(spark, scratch, dedup_mode=EXACT, layout=layout).start()
    try:
        h.push([order("M1", "2024-01-01 23:58:00", user=1), order("M2", "2024-01-02 00:02:00", user=2)])
    finally:
        h.stop()
    from shoppulse.plans.views import latest_window, window_points

    latest = latest_window(window_points(h.ledger.window_rows(spark))).first()
    assert str(latest["window_start"]) == "2024-01-02 00:02:00"
    days = {str(r["dt"]): r["dau"] for r in h.ledger.active_users(spark, by_day=True).collect()}
    assert days == {"2024-01-01": 1, "2024-01-02": 1}


def test_progress_reports_late_drops_and_state_eviction(spark, scratch):
    h = Harness(spark, scratch, dedup_mode=WITHIN_WATERMARK, layout="three").start()
    try:
        h.push([order("P1", "2024-01-01 10:00:00")])
        h.push([order("P2", "2024-01-01 11:00:00")])
        h.push([order("P3", "2024-01-01 12:00:00"), order("P0", "2024-01-01 09:00:00")])
    finally:
        h.stop()
    dropped = sum(
        op.get("numRowsDroppedByWatermark", 0)
        for p in h.pipe.queries["total"].recentProgress
        for op in p["stateOperators"]
    )
    assert dropped == 1
    win_ops = [op for p in h.pipe.queries["win"].recentProgress for op in p["stateOperators"]]
    assert sum(op["numRowsRemoved"] for op in win_ops) > 0  # closed windows leave the state


def test_kafka_without_connector_fails_clearly(spark):
    from shoppulse.sources.streams import KafkaConnectorMissing, kafka_order_stream

    with pytest.raises(KafkaConnectorMissing):
        kafka_order_stream(spark, "localhost:9092", "orders")


def test_publish_order_stream_as_json_lines(spark, scratch):
    from shoppulse.sources.streams import publish_order_stream

    inbox = os.path.join(scratch, "in")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "a.json"), "w", encoding="utf-8") as fh:
        fh.write(json.dumps(order("J1", "2024-01-01 10:00:00"), ensure_ascii=False) + "\n")
    stream = file_order_stream(spark, inbox)
    q = publish_order_stream(stream.drop("ts"), os.path.join(scratch, "out"), os.path.join(scratch, "ck"),
                             {"availableNow": True})
    q.awaitTermination()
    (line,) = [r["value"] for r in spark.read.text(os.path.join(scratch, "out")).collect()]
    assert json.loads(line) == order("J1", "2024-01-01 10:00:00")


def test_single_layout_one_query_one_state(spark, scratch):
    h = Harness(spark, scratch, dedup_mode=WITHIN_WATERMARK).start()
    try:
        h.push([order("S1", "2024-01-01 10:00:00")])
        h.push([order("S2", "2024-01-01 11:00:00")])
        h.push([order("S3", "2024-01-01 12:00:00"), order("S0", "2024-01-01 09:00:00")])
    finally:
        h.stop()
    assert list(h.pipe.queries) == ["all"]
    ops = [op for p in h.pipe.queries["all"].recentProgress for op in p["stateOperators"]]
    assert {op["operatorName"] for op in ops} == {"dedupeWithinWatermark"}  # no window state
    assert sum(op.get("numRowsDroppedByWatermark", 0) for op in ops) == 1
    assert h.ledger.totals(spark).first()["order_total"] == 3


def test_job_entry_point_drains_a_folder(spark, scratch):
    from shoppulse.streaming.job import main

    src = os.path.join(scratch, "orders")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w", encoding="utf-8") as fh:
        for i in range(5):
            fh.write(json.dumps(order(f"J{i}", f"2024-01-01 10:0{i}:00", sku=i + 1, user=i)) + "\n")
        fh.write(json.dumps(order("J0", "2024-01-01 10:00:00", sku=1, user=0)) + "\n")  # re-sent
    dim_path = os.path.join(scratch, "dim")
    sku_dimension(spark, SF001).write.parquet(dim_path)
    pipe = main(["--source", src, "--dim-parquet", dim_path, "--available-now",
                 "--root", os.path.join(scratch, "job"), "--dedup", EXACT])
    ov = pipe.ledger.overview(spark).first()
    assert (ov["order_total"], ov["gmv_total"], ov["dau"]) == (5, 50.0, 5)
    assert pipe.ledger.window_rows(spark).filter("category = '未知'").count() == 0


def test_stream_native_daily_active_users(spark, scratch):
    from shoppulse.operators.totals import daily_active_users_stream

    inbox = os.path.join(scratch, "in")
    os.makedirs(inbox)
    rows = [order(f"U{i}", f"2024-01-0{1 + i % 3} 1{i % 10}:00:00", user=i % 4) for i in range(30)]
    rows.sort(key=lambda r: r["ts"])  # arrive in event-time order: nothing is late
    for i in range(3):
        path = os.path.join(inbox, f"b{i}.json")
        with open(path, "w") as fh:
            fh.write("\n".join(json.dumps(r) for r in rows[i * 10:(i + 1) * 10]) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))  # the file source orders by mtime
    stream = file_order_stream(spark, inbox, max_files_per_trigger=1)
    q = (
        daily_active_users_stream(stream).writeStream.outputMode("update").format("memory")
        .queryName("dau_live").option("checkpointLocation", os.path.join(scratch, "ck"))
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    live = spark.sql("SELECT dt, max_by(dau, dau) AS dau FROM dau_live GROUP BY dt")
    got = {str(r["dt"]): r["dau"] for r in live.collect()}
    truth = {}
    for r in rows:
        truth.setdefault(r["ts"][:10], set()).add(r["user_id"])
    assert got == {d: len(u) for d, u in truth.items()}
    # business day 8 h ahead of UTC: the same pairs, dated by the shifted clock
    q8 = (
        daily_active_users_stream(file_order_stream(spark, inbox), offset_hours=8)
        .writeStream.outputMode("update").format("memory").queryName("dau_live8")
        .option("checkpointLocation", os.path.join(scratch, "ck8")).trigger(availableNow=True).start()
    )
    q8.awaitTermination()
    from shoppulse.operators.totals import active_users

    batch = active_users(
        spark.read.json(inbox).withColumn("event_time", F.to_timestamp("ts")), by_day=True, offset_hours=8
    )
    got8 = {str(r["dt"]): r["dau"] for r in spark.sql(
        "SELECT dt, max(dau) AS dau FROM dau_live8 GROUP BY dt").collect()}
    assert got8 == {str(r["dt"]): r["dau"] for r in batch.collect()}


def test_scrambled_replay_drops_exactly_the_rule_s_late_rows(spark):
    """Real events, delayed 0-3 days, one-day micro-batches: the stream keeps what the rule keeps."""
    from shoppulse.operators.late import mark_late

    raw = orders_from_events(read_table(spark, SF001, "events"), keep=("event_id",)).withColumn(
        "event_time", F.col("event_time").cast("timestamp")
    )
    delay = (F.col("event_id") * F.lit(7919)) % F.lit(3 * 86400)
    arrival = F.col("event_time") + F.make_interval(secs=delay.cast("decimal(18,6)"))
    batch = F.floor(F.unix_seconds(arrival) / 86400).cast("bigint")
    arrivals = raw.withColumn("batch", batch)
    from shoppulse.operators.dedup import first_arrival

    kept = first_arrival(mark_late(arrivals).filter(~F.col("late")).drop("late", "watermark"))
    want = kept.agg(F.count("order_id").alias("n"), F.sum("amount").alias("gmv")).first()
    assert mark_late(arrivals).filter("late").count() > 0  # the order really is scrambled
    pipe = replay(spark, raw, batch, sku_dimension(spark, SF001),
                  StreamConfig(name="late", dedup_mode=EXACT))
    tot = pipe.ledger.totals(spark).first()
    assert tot["order_total"] == want["n"]
    assert round(tot["gmv_total"], 2) == round(float(want["gmv"]), 2)


@LAYOUTS
def test_null_order_id_twice_one_passes(spark, scratch, layout):
    h = Harness(spark, scratch, dedup_mode=EXACT, layout=layout).start()
    try:
        h.push([order(None, "2024-01-01 10:40:00", amount=1.0, user=7),
                order(None, "2024-01-01 10:41:00", amount=2.0, user=8)])
    finally:
        h.stop()
    tot = h.ledger.totals(spark).first()
    assert tot["order_total"] == 0  # count(order_id) skips the null id
    assert tot["gmv_total"] in (1.0, 2.0)  # but exactly one of the rows passed dedup
    assert h.ledger.active_users(spark).first()["dau"] == 1


@LAYOUTS
def test_hot_order_id_in_a_stream(spark, scratch, layout):
    """A third of the rows re-send one order id (conflicting payloads): it counts once."""
    rows = [order(f"H{i}", f"2024-01-01 10:{i % 60:02d}:00", user=i % 5) for i in range(60)]
    rows += [order("HOT", f"2024-01-01 10:{i % 60:02d}:30", amount=float(i + 1), user=9) for i in range(30)]
    h = Harness(spark, scratch, dedup_mode=EXACT, layout=layout).start()
    try:
        h.push(rows)
    finally:
        h.stop()
    tot = h.ledger.totals(spark).first()
    assert tot["order_total"] == 61
    assert 600.0 + 1.0 <= tot["gmv_total"] <= 600.0 + 30.0  # exactly one HOT copy kept
    assert h.ledger.active_users(spark).first()["dau"] == 6


def test_await_any_returns_when_one_query_ends(spark, scratch):
    h = Harness(spark, scratch, dedup_mode=EXACT, layout="three").start()
    try:
        h.push([order("W1", "2024-01-01 10:00:00")])
        h.pipe.queries["dau"].stop()
        assert h.pipe.await_any(timeout=60)
    finally:
        h.stop()


@LAYOUTS
def test_closed_windows_from_the_stream_watermark(spark, scratch, layout):
    from shoppulse.plans.views import latest_closed_window, window_points

    h = Harness(spark, scratch, dedup_mode=EXACT, layout=layout).start()
    try:
        h.push([order("C1", "2024-01-01 10:00:00", sku=1)])
        h.push([order("C2", "2024-01-01 10:30:00", sku=1)])
        h.push([order("C3", "2024-01-01 10:31:00", sku=1)])
    finally:
        h.stop()
    mark = h.pipe.watermark()
    assert mark.startswith("2024-01-01 10:20:00")  # 10:30 - 10 min, set after the second batch
    closed = latest_closed_window(window_points(h.ledger.window_rows(spark)), mark).collect()
    assert [(r["category"], r["window"]) for r in closed] == [("CAT_A", "10:00")]
