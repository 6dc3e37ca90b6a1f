"""The ledger by itself: versions of folded days, cut manifests, generations, user sets."""

import datetime as dt
import json
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shoppulse.operators.user_sets import SPARSE, count_users, user_sets
from shoppulse.sources.streams import file_order_stream
from shoppulse.streaming.ledger import (
    GENERATION_MARK,
    TOTALS,
    USERS,
    WINDOW_SUMS,
    WINDOWS,
    Ledger,
    LedgerMismatch,
    Version,
)
from shoppulse.streaming.streams import StreamConfig, start_streams

ORDERS = "order_id string, user_id long, amount decimal(18,2), event_time timestamp, category string"


def batch(spark, n, amount=10, users=(1,), day=1):
    at = dt.datetime(2024, 1, day, 10)
    rows = [(f"O{n}-{u}", u, Decimal(amount), at, "A") for u in users]
    return spark.createDataFrame(rows, ORDERS)


def files(ledger, kind):
    """Data files of the folded days, with the time they were written."""
    out = {}
    for folder, _, names in os.walk(f"{ledger.folder(kind)}/days"):
        for name in names:
            if name.endswith(".parquet"):
                path = os.path.join(folder, name)
                out[path] = os.stat(path).st_mtime_ns
    return out


def manifests(ledger, kind):
    folder = f"{ledger.folder(kind)}/versions"
    return [os.path.join(folder, n) for n in sorted(os.listdir(folder)) if not n.startswith((".", "_"))]


# ---- versions -----------------------------------------------------------------------


@pytest.mark.parametrize("kind", [USERS, WINDOW_SUMS, WINDOWS])
def test_compaction_touches_open_days_only(spark, scratch, kind):
    ledger = Ledger(os.path.join(scratch, "ledger"), compact_every=2, windows_kind=kind)
    windows = lambda df: df.groupBy(F.window("event_time", "5 minutes").alias("window"), "category").agg(
        F.sum("amount").alias("gmv_dec"), F.count("order_id").alias("order_cnt")
    )
    write = {
        USERS: ledger.write_users,
        WINDOW_SUMS: ledger.write_window_sums,
        WINDOWS: lambda df, b: ledger.write_windows(windows(df), b),
    }[kind]
    for b in range(5):  # day 1, closed from batch 4 on
        write(batch(spark, b, users=(b, b + 1), day=1), b)
    first = files(ledger, kind)
    days = {path.split("day=")[1].split("/")[0] for path in first}
    assert days == {"2024-01-01"}
    for b in range(5, 9):
        write(batch(spark, b, users=(b,), day=2), b)
    version = ledger.version(spark, kind)
    assert version.upto == 7 and sorted(version.days) == ["2024-01-01", "2024-01-02"]
    closed = version.days["2024-01-01"]
    write(batch(spark, 9, users=(1,), day=3), 9)
    write(batch(spark, 10, users=(1,), day=3), 10)
    after = files(ledger, kind)
    # day 1 kept its folder and files through two more versions
    assert ledger.version(spark, kind).days["2024-01-01"] == closed
    kept = {p: t for p, t in after.items() if f"/{closed}/" in p}
    assert kept and all(first.get(p, t) == t for p, t in kept.items())
    # the fold of a version reads the touched days alone
    read = ledger._folders(spark, kind, ledger.version(spark, kind), ["2024-01-03"]).inputFiles()
    assert all("2024-01-0" not in f.split("day=")[1] or "2024-01-03" in f for f in read)
    if kind == USERS:
        got = {str(r["dt"]): r["dau"] for r in ledger.active_users(spark, by_day=True).collect()}
        assert got == {"2024-01-01": 6, "2024-01-02": 4, "2024-01-03": 1}
        assert ledger.active_users(spark).first()["dau"] == 9
    else:
        rows = ledger.window_rows(spark)
        assert rows.select(F.to_date("window_start")).distinct().count() == 3
        one = ledger.window_rows(spark, days=["2024-01-02"])
        assert one.exceptAll(rows.filter("to_date(window_start) = '2024-01-02'")).count() == 0 and one.count() > 0
        assert all("day=2024-01-02" in f for f in one.inputFiles() if "/days/" in f)


@pytest.mark.parametrize("text", ["", '{"upto": 3, "da', "null", '{"upto": 3}'])
def test_a_cut_manifest_counts_as_not_there(spark, scratch, text):
    ledger = Ledger(os.path.join(scratch, "ledger"), compact_every=2)
    for b in range(5):
        ledger.write_totals(batch(spark, b), b)
        ledger.write_users(batch(spark, b, users=(b,)), b)
    for kind in (TOTALS, USERS):
        assert ledger.latest_snapshot(spark, kind) == 3
        with open(manifests(ledger, kind)[-1], "w") as out:
            out.write(text)
        assert ledger.latest_snapshot(spark, kind) == 1  # the one before it is served
    assert ledger.totals(spark).first()["gmv_total"] == 50.0
    assert ledger.active_users(spark).first()["dau"] == 5
    for b in range(5, 9):  # and later compactions go on from there
        ledger.write_totals(batch(spark, b), b)
        ledger.write_users(batch(spark, b, users=(b,)), b)
    assert ledger.totals(spark).first()["gmv_total"] == 90.0
    assert ledger.active_users(spark).first()["dau"] == 9
    assert ledger.latest_snapshot(spark, TOTALS) == 7


def test_manifest_text_round_trip():
    version = Version(7, {"2024-01-01": "a/day=2024-01-01", "none": "b/day=none"})
    assert Version.of(version.text()) == version
    assert all(Version.of(version.text()[:n]) is None for n in range(len(version.text())))


def test_an_unfinished_fold_is_never_read_and_is_removed(spark, scratch):
    """A writer that died while folding leaves files behind; the batch is replayed."""
    ledger = Ledger(os.path.join(scratch, "ledger"), compact_every=2)
    ledger.write_users(batch(spark, 0, users=(1, 2)), 0)
    ledger.write_users(batch(spark, 1, users=(3,)), 1)
    torn = f"{ledger.folder(USERS)}/days/torn/day=2024-01-01"
    user_sets(batch(spark, 0, users=(77,)).select(F.to_date("event_time").alias("dt"), "user_id")).write.parquet(torn)
    os.makedirs(f"{ledger.folder(USERS)}/versions")
    with open(f"{ledger.folder(USERS)}/versions/_{1:020d}-torn", "w") as out:
        out.write('{"upto": 1, "days": {"2024-01-01": "torn/day=2024-01-01"}}')
    for _ in range(2):  # batch 2 and its replay
        ledger.write_users(batch(spark, 2, users=(1,)), 2)
        assert ledger.active_users(spark).first()["dau"] == 3
    assert not os.path.exists(torn)


def test_replayed_compaction_batch_replaces_its_result(spark, scratch):
    ledger = Ledger(os.path.join(scratch, "ledger"), compact_every=2)
    for b in range(3):
        ledger.write_totals(batch(spark, b), b)
    assert ledger.totals(spark).first()["gmv_total"] == 30.0
    ledger.write_totals(batch(spark, 2, amount=99), 2)  # replay with another result
    got = ledger.totals(spark).first()
    assert (got["gmv_total"], got["order_total"]) == (119.0, 3)


def test_reads_touch_a_constant_number_of_folders(spark, scratch):
    ledger = Ledger(os.path.join(scratch, "ledger"), compact_every=3)
    seen = []
    for b in range(14):
        ledger.write_totals(batch(spark, b), b)
        deltas = [d for d in os.listdir(ledger.path(TOTALS)) if d.startswith("batch_id=")]
        folded = os.listdir(f"{ledger.folder(TOTALS)}/days") if b >= 3 else []
        seen.append((len(deltas), len(folded), len(manifests(ledger, TOTALS)) if b >= 3 else 0))
        assert ledger.totals(spark).first()["gmv_total"] == 10.0 * (b + 1)
    assert max(d for d, _, _ in seen) <= 7
    assert max(s for _, s, _ in seen) <= 2 and max(m for _, _, m in seen) <= 2


def test_rows_without_event_time_have_a_day_of_their_own(spark, scratch):
    ledger = Ledger(os.path.join(scratch, "ledger"), compact_every=2)
    for b in range(3):
        rows = batch(spark, b, users=(1, b)).withColumn("event_time", F.lit(None).cast("timestamp"))
        ledger.write_users(rows, b)
    assert list(ledger.version(spark, USERS).days) == ["none"]
    assert [tuple(r) for r in ledger.active_users(spark, by_day=True).collect()] == [(None, 3)]


# ---- generations --------------------------------------------------------------------


class Run:
    """The pipeline over a folder of order files, run to its end on each call."""

    def __init__(self, spark, scratch, layout):
        self.spark, self.inbox, self.layout = spark, os.path.join(scratch, "in"), layout
        self.root, self.n = os.path.join(scratch, "pipe"), 0
        os.makedirs(self.inbox)
        self.dim = spark.createDataFrame([(1, "a", "CAT_A")], "id long, sku_name string, category string")

    def add(self, k):
        for _ in range(k):
            path = os.path.join(self.inbox, f"b{self.n:03d}.json")
            with open(path, "w") as out:
                at = f"2024-01-01 10:{self.n:02d}:00"
                out.write(json.dumps(dict(order_id=f"G{self.n}", user_id=self.n, sku_id=1, amount=10.0, ts=at)) + "\n")
            os.utime(path, (1_700_000_000 + self.n,) * 2)
            self.n += 1

    def clear_inbox(self):
        self.inbox += "x"
        os.makedirs(self.inbox)

    def __call__(self):
        cfg = StreamConfig(name="g", root=self.root, layout=self.layout, compact_every=3, dedup_mode="exact",
                           trigger={"availableNow": True})
        pipe = start_streams(self.spark, file_order_stream(self.spark, self.inbox, 1), self.dim, cfg)
        for q in pipe.queries.values():
            q.awaitTermination()
        return pipe


@pytest.mark.parametrize("layout", ["single", "three"])
def test_a_deleted_checkpoint_opens_a_new_generation(spark, scratch, layout):
    run = Run(spark, scratch, layout)
    run.add(7)
    pipe = run()
    assert pipe.ledger.overview(spark).first()["gmv_total"] == 70.0
    assert run().ledger.overview(spark).first()["gmv_total"] == 70.0  # a restart goes on in the same one
    os.rename(os.path.join(run.root, "checkpoint"), os.path.join(run.root, "checkpoint-away"))
    run.clear_inbox()
    run.add(3)
    again = run()
    got = again.ledger.overview(spark).first()
    assert (got["gmv_total"], got["order_total"], got["dau"]) == (30.0, 3, 3)
    assert again.ledger.window_rows(spark).agg(F.sum("order_cnt")).first()[0] == 15
    # a reader elsewhere finds the newest generation; the older one can be dropped
    reader = Ledger(again.ledger.root, windows_kind=again.ledger.windows_kind).open(spark)
    assert reader.overview(spark).first()["gmv_total"] == 30.0
    old = pipe.ledger.folder(TOTALS)
    assert os.path.exists(old)
    reader.forget_older(spark)
    assert not os.path.exists(old) and reader.overview(spark).first()["gmv_total"] == 30.0


def test_a_checkpoint_of_another_generation_is_refused(spark, scratch):
    run = Run(spark, scratch, "single")
    run.add(2)
    run()
    checkpoint = os.path.join(run.root, "checkpoint")
    os.rename(checkpoint, checkpoint + "-away")
    run()
    os.rename(checkpoint, checkpoint + "-new")
    os.rename(checkpoint + "-away", checkpoint)  # the first one comes back
    with pytest.raises(LedgerMismatch):
        run()
    os.rename(f"{checkpoint}/all/{GENERATION_MARK}", f"{checkpoint}/mark-away")
    with pytest.raises(LedgerMismatch):  # it has run, but nothing tells into which ledger
        run()


def test_a_folded_batch_cannot_run_again(spark, scratch):
    ledger = Ledger(os.path.join(scratch, "ledger"), compact_every=2)
    for b in range(5):
        ledger.write_totals(batch(spark, b), b)
    with pytest.raises(LedgerMismatch):
        ledger.write_totals(batch(spark, 0), 0)
    assert ledger.totals(spark).first()["gmv_total"] == 50.0


# ---- user sets ----------------------------------------------------------------------


def test_user_sets_unite_exactly(spark):
    r = random.Random(2)
    edge = [0, 1, -1, 32768, 32769, -32768, 2**63 - 1, -(2**63), 2**40, None]
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None]
    rows = [(d, u) for d in days for u in edge]
    rows += [(r.choice(days), r.randint(-50, 900)) for _ in range(3000)]  # one dense bucket
    rows += [(r.choice(days), r.getrandbits(62) - 2**61) for _ in range(300)]  # a bucket each
    frame = lambda part: spark.createDataFrame(part, "dt date, user_id long")
    cuts = [rows[0::3], rows[1::3], rows[2::3] + rows[:500]]
    folded = user_sets(frame(cuts[0]))
    folded = user_sets(frame(cuts[1]), folded)
    folded = user_sets(frame(cuts[2]), folded)
    want = {}
    for d, u in rows:
        if u is not None:
            want.setdefault(d, set()).add(u)
    got = {x["dt"]: x["dau"] for x in count_users(folded, by_day=True).collect()}
    assert got == {d: len(u) for d, u in want.items()}
    never = F.lit(None).cast("date")
    everyone = user_sets(frame([]), folded.withColumn("dt", never))
    assert count_users(everyone).first()["dau"] == len(set().union(*want.values()))
    shapes = folded.collect()
    assert all((x["bits"] is None) == (x["n"] <= SPARSE) for x in shapes)
    assert all((x["places"] is None) != (x["bits"] is None) for x in shapes)
    assert len({(x["dt"], x["bucket"]) for x in shapes}) == len(shapes)
    assert count_users(user_sets(frame([]))).first()["dau"] == 0
