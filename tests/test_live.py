"""Streaming mechanisms beside the ledger: seen ids, closed windows, late rows, snapshots, start positions."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from shoppulse.operators.dedup import EXACT_LEDGER
from shoppulse.operators.late import late_counts
from shoppulse.operators.user_sets import first_seen, user_sets
from shoppulse.plans import views
from shoppulse.sources.dimension import DimensionSnapshots
from shoppulse.sources.streams import EARLIEST, LATEST, file_order_stream, start_position
from shoppulse.streaming.late_rows import LateRows
from shoppulse.streaming.ledger import CLOSED, SEEN
from shoppulse.streaming.seen import FAN, PARTS, SeenIds
from test_streaming import Harness, order


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "order_id string")


def counted(seen, spark, values, batch):
    rows = seen.new_rows(ids(spark, values), "order_id", batch)
    out = sorted(r["order_id"] or "" for r in rows.collect())
    seen.write(rows, "order_id", batch)
    seen.release()
    return out


# ---- seen ids -----------------------------------------------------------------------


def test_seen_ids_against_a_set(spark, scratch):
    """New ids of every batch, through folds, merges of runs, replays and a cut manifest."""
    r = random.Random(3)
    seen, truth = SeenIds(os.path.join(scratch, "seen"), fold_every=1), set()
    for batch in range(FAN + 3):
        fresh = {f"o{batch}-{k}" for k in range(20)}
        again = set(r.sample(sorted(truth), min(len(truth), 10)))
        values = sorted(fresh | again) + ([None] if batch in (2, 5) else [])
        want = sorted(fresh) if batch != 2 else ["", *sorted(fresh)]
        assert counted(seen, spark, values, batch) == want
        if batch in (4, FAN + 1):  # the batch runs again: its own ids are no earlier ones
            assert counted(seen, spark, values, batch) == want
        truth |= fresh
    runs = seen.runs(spark)
    assert [x.level for x in runs].count(1) == 1 and len(runs) <= FAN
    versions = os.path.join(scratch, "seen", "versions")
    newest = sorted(n for n in os.listdir(versions) if not n.startswith((".", "_")))[-1]
    with open(os.path.join(versions, newest), "w") as out:
        out.write('{"upto"')
    assert counted(seen, spark, sorted(truth)[:30] + ["one more"], FAN + 3) == ["one more"]


def test_a_batch_reads_only_folders_that_may_hold_its_ids(spark, scratch):
    seen = SeenIds(os.path.join(scratch, "seen"), fold_every=1)
    counted(seen, spark, [f"o{k}" for k in range(3000)], 0)
    counted(seen, spark, ["p"], 1)  # folds batch 0 into a run
    (run,) = seen.runs(spark)
    fresh = ids(spark, [f"new{k}" for k in range(40)]).toDF("id")
    assert seen._suspects(spark, fresh, run).count() <= 4  # 16 bits an id and four hashes
    known = ids(spark, [f"o{k}" for k in range(0, 3000, 7)]).toDF("id")
    assert seen._suspects(spark, known, run).count() == known.count()  # a Bloom filter misses none
    parts = [x["part"] for x in seen._suspects(spark, known.limit(2), run).collect()]
    read = seen._ids(spark, run, parts)
    assert len(read.inputFiles()) <= PARTS
    assert "PartitionFilters: [part#" in read._jdf.queryExecution().toString()


def test_exact_dedup_on_disk_keeps_the_state_bounded(spark, scratch):
    """30 batches, an hour each; every batch re-sends ids of all earlier ones."""
    h = Harness(spark, scratch, dedup_mode=EXACT_LEDGER, seen_fold_every=4).start()
    sizes = []
    try:
        for b in range(30):
            at = f"2024-01-{1 + b // 24:02d} {b % 24:02d}"
            rows = [order(f"S{b}-{k}", f"{at}:{k:02d}:00", user=k) for k in range(20)]
            rows += [order(f"S{e}-{e % 20}", f"{at}:30:00", amount=99.0) for e in range(0, b, 5)]
            h.push(rows)
            ops = h.pipe.queries["all"].lastProgress["stateOperators"]
            sizes.append(sum(op["numRowsTotal"] for op in ops))
    finally:
        h.stop()
    got = h.ledger.overview(spark).first()
    assert (got["order_total"], got["gmv_total"]) == (600, 6000.0)
    # the watermark's span (a few batches of about 26 rows), not the history of 690 rows
    assert max(sizes) < 250 and sum(sizes[20:]) <= 2 * sum(sizes[5:15])
    runs = SeenIds(h.ledger.folder(SEEN), 4).runs(spark)
    assert sum(x.rows for x in runs) >= 500 and len(runs) < 2 * FAN


def test_exact_dedup_on_disk_needs_the_single_layout(spark, scratch):
    with pytest.raises(ValueError):
        Harness(spark, scratch, dedup_mode=EXACT_LEDGER, layout="three").start()


# ---- closed windows, late rows -----------------------------------------------------


def test_closed_windows_are_emitted_once(spark, scratch):
    h = Harness(spark, scratch, dedup_mode="exact", closed_windows=True, compact_every=2).start()
    try:
        h.push([order("C1", "2024-01-01 10:00:00"), order("C2", "2024-01-01 10:02:00", sku=2)])
        h.push([order("C3", "2024-01-01 10:30:00")])
        h.push([order("C4", "2024-01-01 10:31:00"), order("L1", "2024-01-01 10:00:30")])  # L1 is late
        h.push([order("C5", "2024-01-01 11:00:00")])
        h.push([order("C6", "2024-01-01 11:30:00")])
    finally:
        h.stop()
    closed = h.ledger.closed_windows(spark)
    rows = closed.select("window_start", "category", "gmv", "order_cnt").collect()
    assert len(rows) == len({r[:2] for r in rows})  # each window once
    # the watermark of the last batch is 11:00 less 10 minutes
    served = h.ledger.window_rows(spark).filter("window_end <= '2024-01-01 10:50:00'")
    assert sorted(map(tuple, rows)) == sorted(map(tuple, served.select("window_start", "category", "gmv", "order_cnt").collect()))
    assert all(r["gmv"] == 10.0 or r["gmv"] == 20.0 for r in rows)
    before = sorted(map(tuple, closed.collect()))
    h.pipe = None
    h.start()  # a second run from the same checkpoint has nothing to add
    h.pipe.process_all_available()
    h.stop()
    assert sorted(map(tuple, h.ledger.closed_windows(spark).collect())) == before
    assert h.ledger.latest_snapshot(spark, CLOSED) is not None
    board = views.latest_window(views.window_points(h.ledger.closed_windows(spark))).collect()
    assert board and board[0]["category"] in ("CAT_A", "CAT_B")


def test_late_rows_are_published_by_batch(spark, scratch):
    batches = [
        [order("A1", "2024-01-01 10:00:00")],
        [order("A2", "2024-01-01 10:30:00")],
        [order("A3", "2024-01-01 10:05:00"), order("L1", "2024-01-01 09:45:00")],
        [order("L2", "2024-01-01 10:15:00"), order("A4", "2024-01-01 10:25:00")],
    ]
    h = Harness(spark, scratch, dedup_mode="within_watermark").start()
    try:
        for b in batches:
            h.push(b)
    finally:
        h.stop()
    got = {r["batch_id"]: (r["n"], r["rows"]) for r in h.pipe.late.read().collect()}
    assert {b: n for b, (n, _) in got.items()} == {0: 0, 1: 0, 2: 1, 3: 1}
    arrivals = spark.createDataFrame(
        [(i, r["ts"]) for i, b in enumerate(batches) for r in b], "batch long, ts string"
    ).withColumn("event_time", F.to_timestamp("ts"))
    rule = {r["batch"]: r["n"] for r in late_counts(arrivals).collect()}
    assert {b: n for b, (n, _) in got.items()} == rule


def test_late_rows_count_a_batch_once(spark, scratch):
    late = LateRows(spark, os.path.join(scratch, "late"))
    assert late.read().collect() == []
    report = lambda batch, n, rows: {"batchId": batch, "numInputRows": rows, "stateOperators": [{"numRowsDroppedByWatermark": n}]}
    for progress in (report(0, 2, 5), report(0, 7, 9), report(1, 0, 0), report(2, 1, 4)):
        late.record(progress)
    assert sorted(map(tuple, late.read().collect())) == [(0, 2, 5), (2, 1, 4)]


# ---- dimension snapshots -------------------------------------------------------------


def test_dimension_snapshots_are_looked_up_each_micro_batch(spark, scratch):
    schema = "id long, sku_name string, category string, price decimal(10,2)"
    frame = lambda category: spark.createDataFrame([(1, "x", category, None)], schema)
    dim = DimensionSnapshots(os.path.join(scratch, "dim"), keep=2)
    with pytest.raises(FileNotFoundError):
        dim.current(spark)
    dim.publish(frame("OLD"))
    h = Harness(spark, scratch, dim=dim, dedup_mode="exact").start()
    try:
        h.push([order("R1", "2024-01-01 10:00:00", sku=1)])
        dim.publish(frame("NEW"))
        h.push([order("R2", "2024-01-01 10:20:00", sku=1)])
        newest = dim.publish(frame("TORN"))
        with open(os.path.join(scratch, "dim", "versions", newest), "w") as out:
            out.write("{")  # a pointer that was cut short: the version before it is served
        h.push([order("R3", "2024-01-01 10:40:00", sku=1)])
    finally:
        h.stop()
    rows = h.ledger.read(spark, h.ledger.windows_kind).collect()
    assert {(r["batch_id"], r["category"]) for r in rows} == {(0, "OLD"), (1, "NEW"), (2, "NEW")}
    assert len(os.listdir(os.path.join(scratch, "dim", "data"))) == 2


# ---- start positions -----------------------------------------------------------------


def test_a_file_stream_starts_where_it_is_told(spark, scratch):
    inbox = os.path.join(scratch, "in")
    os.makedirs(inbox)

    def add(name, at):
        path = os.path.join(inbox, name)
        with open(path, "w") as out:
            out.write(json.dumps(order(name, "2024-01-01 10:00:00")) + "\n")
        if at:
            os.utime(path, (at, at))

    def run(starting, label, **caps):
        folder = os.path.join(scratch, label)
        at = start_position(spark, folder, starting)
        q = (
            file_order_stream(spark, inbox, starting=at, **caps)
            .writeStream.format("memory").queryName(label)
            .option("checkpointLocation", os.path.join(folder, "ck")).trigger(availableNow=True).start()
        )
        q.awaitTermination()
        got = sorted(r["order_id"] for r in spark.table(label).collect())
        spark.catalog.dropTempView(label)
        return got, q

    for k in range(4):
        add(f"f{k}", 1_700_000_000 + 3600 * k)  # 2023-11-14 22:13:20 and each hour after
    assert run(EARLIEST, "from_start")[0] == ["f0", "f1", "f2", "f3"]
    assert run("2023-11-15 00:00:00", "from_time")[0] == ["f2", "f3"]
    assert run(LATEST, "from_now")[0] == []
    # the first start decides, whatever a later one asks for
    assert start_position(spark, os.path.join(scratch, "from_time"), EARLIEST) == "2023-11-15 00:00:00"
    with pytest.raises(ValueError):
        start_position(spark, os.path.join(scratch, "bad"), "soon")
    # admission by bytes: a file of about 90 bytes a micro-batch
    got, q = run(EARLIEST, "by_bytes", max_bytes_per_trigger=100)
    assert got == ["f0", "f1", "f2", "f3"]
    assert sum(p["numInputRows"] > 0 for p in q.recentProgress) == 4


# ---- users by first day --------------------------------------------------------------


def test_first_seen_by_day_against_a_dictionary(spark):
    import datetime as dt

    r = random.Random(9)
    days = [dt.date(2024, 1, d) for d in range(1, 8)] + [None]
    rows = [(r.choice(days), r.randint(0, 2000)) for _ in range(6000)]  # bitmaps on most days
    rows += [(r.choice(days), r.getrandbits(60)) for _ in range(200)]
    rows += [(days[k % 7], 10**9 + k % 90) for k in range(400)]  # listed on every day
    rows += [(days[0], 2 * 10**9 + k) for k in range(100)] + [(days[1], 2 * 10**9 + k) for k in range(600)]
    least = {}
    for d, u in rows:
        key = (d is None, d or dt.date.min)
        if u not in least or key < least[u][0]:
            least[u] = (key, d)
    want = {}
    for _, d in least.values():
        want[d] = want.get(d, 0) + 1
    got = {x["dt"]: x["new_users"] for x in first_seen(user_sets(spark.createDataFrame(rows, "dt date, user_id long"))).collect()}
    assert {d: n for d, n in got.items() if n} == want




# ---- replay --------------------------------------------------------------------------


def test_one_run_replays_the_same_micro_batches_as_restarts(spark):
    """Every batch's deltas are equal, in one query run and with a restart for each batch."""
    from shoppulse.streaming.ledger import TOTALS, WINDOW_SUMS
    from shoppulse.streaming.replay import replay
    from shoppulse.streaming.streams import StreamConfig

    rows = [(f"R{k}", k % 7, 1 + k % 2, f"2024-01-01 {10 + k // 20:02d}:{(k * 7) % 60:02d}:00", k // 20) for k in range(80)]
    rows += [(f"R{k}", 1, 1, f"2024-01-01 {10 + k // 20:02d}:00:00", k // 20 + 1) for k in (3, 25)]  # late copies
    frame = spark.createDataFrame(rows, "order_id string, user_id long, sku_id long, ts string, b long").select(
        "order_id", "user_id", "sku_id", F.lit(5.0).cast("decimal(18,2)").alias("amount"),
        F.to_timestamp("ts").alias("event_time"), "b",
    )
    dim = spark.createDataFrame([(1, "a", "A"), (2, "b", "B")], "id long, sku_name string, category string")
    got = []
    for one_run in (True, False):
        cfg = StreamConfig(name="order", dedup_mode="exact", closed_windows=True)
        pipe = replay(spark, frame, F.col("b"), dim, cfg, one_run=one_run)
        ledger = pipe.ledger
        parts = [
            sorted(map(tuple, ledger.read(spark, kind).filter("gmv is not null").collect()))
            for kind in (TOTALS, WINDOW_SUMS)
        ]
        late = sorted(map(tuple, pipe.late.read().collect()))
        closed = sorted(map(tuple, ledger.closed_windows(spark).drop("batch_id").collect()))
        got.append((parts, late, closed))
    assert got[0] == got[1]
    assert len(got[0][1]) == 4 and got[0][2]  # four arrival batches, four micro-batches
