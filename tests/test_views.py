"""Serving views on hand-made window points: the dashboard's edge cases."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from shoppulse.operators.totals import active_users, totals
from shoppulse.plans import views

POINT_SCHEMA = "window_start timestamp_ntz, window_end timestamp_ntz, category string, gmv double"


def pts(spark, rows):
    out = []
    for hhmm, cat, gmv in rows:
        start = dt.datetime(2024, 1, 1, int(hhmm[:2]), int(hhmm[3:]))
        out.append((start, start + dt.timedelta(minutes=5), cat, gmv))
    return spark.createDataFrame(out, POINT_SCHEMA)


def test_rank_trend_share_and_zero_previous(spark):
    p = pts(spark, [
        ("10:00", "A", 100.0), ("10:01", "A", 150.0),  # +50 %
        ("10:00", "B", 0.0), ("10:03", "B", 80.0),     # previous is 0 -> no trend
        ("10:02", "C", 90.0), ("10:04", "C", 45.0),    # -50 %
        ("10:04", "D", 150.0),                          # no previous; ties A on GMV
    ])
    rows = {r["category"]: r for r in views.category_rank(p).collect()}
    assert [rows[c]["rank"] for c in "ADBC"] == [1, 2, 3, 4]  # ties broken by name
    assert rows["A"]["trend_pct"] == 50.0 and rows["A"]["direction"] == "up"
    assert rows["B"]["trend_pct"] is None and rows["B"]["direction"] is None
    assert rows["C"]["trend_pct"] == -50.0 and rows["C"]["direction"] == "down"
    assert rows["D"]["trend_pct"] is None
    assert [rows[c]["share_pct"] for c in "ADBC"] == [35.3, 35.3, 18.8, 10.6]
    top2 = views.category_top_k(views.category_rank(p), 2).collect()
    assert [r["category"] for r in top2] == ["A", "D"]


def test_latest_and_closed_window(spark):
    p = pts(spark, [("10:00", "A", 1.0), ("10:07", "A", 2.0), ("10:01", "B", 3.0)])
    latest = {r["category"]: (r["window"], r["gmv"]) for r in views.latest_window(p).collect()}
    assert latest == {"A": ("10:07", 2.0), "B": ("10:01", 3.0)}
    closed = {r["category"]: r["window"] for r in views.latest_closed_window(p, "2024-01-01 10:06:00").collect()}
    assert closed == {"A": "10:00", "B": "10:01"}
    assert views.latest_closed_window(p, None).count() == 0


def test_aligned_axis_last_n_and_arrays(spark):
    p = pts(spark, [("10:00", "A", 1.0), ("10:01", "B", 2.0), ("10:02", "A", 3.0)])
    aligned = {(r["window_start"].strftime("%H:%M"), r["category"]): r["gmv"] for r in views.trend_aligned(p).collect()}
    assert aligned == {("10:00", "A"): 1.0, ("10:00", "B"): None, ("10:01", "A"): None,
                       ("10:01", "B"): 2.0, ("10:02", "A"): 3.0, ("10:02", "B"): None}
    last2 = {r["window_start"].strftime("%H:%M") for r in views.trend_last_n(p, 2).collect()}
    assert last2 == {"10:01", "10:02"}
    arrays = {r["category"]: (r["times"], r["values"]) for r in views.trend_arrays(p).collect()}
    assert arrays["A"] == (["10:00", "10:02"], [1.0, 3.0])
    tail = {r["category"]: r["times"] for r in views.trend_arrays_last_n(views.trend_arrays(p), 1).collect()}
    assert tail == {"A": ["10:02"], "B": ["10:01"]}
    lookup = {r["category"]: r["gmv_by_time"] for r in views.trend_lookup(views.trend_arrays(p)).collect()}
    assert lookup["A"] == {"10:00": 1.0, "10:02": 3.0}
    back = views.trend_from_arrays(views.trend_arrays(p))
    assert back.count() == 3


def _orders(spark, rows):
    return spark.createDataFrame(
        [(oid, uid, 1, Decimal(amt), dt.datetime.fromisoformat(ts)) for oid, uid, amt, ts in rows],
        "order_id string, user_id long, sku_id long, amount decimal(18,2), event_time timestamp",
    )


def test_kpi_trend_deltas_and_feed_cap(spark):
    o = _orders(spark, [
        ("O1", 1, 10, "2024-01-01 10:00:00"),
        ("O2", 2, 20, "2024-01-02 10:00:00"), ("O3", 1, 5, "2024-01-02 11:00:00"),
        ("O4", 3, 5, "2024-01-03 10:00:00"), ("O5", 4, 5, "2024-01-03 10:00:00"),
        ("O6", 5, 5, "2024-01-03 10:00:00"), ("O7", None, 5, "2024-01-03 10:00:00"),
        ("O8", 6, 5, "2024-01-03 10:00:00"),
    ])
    kpi = {str(r["dt"]): r for r in views.kpi_trend(o).collect()}
    assert [kpi[d]["orders"] for d in sorted(kpi)] == [1, 3, 8]
    assert [kpi[d]["dau"] for d in sorted(kpi)] == [1, 2, 6]
    assert kpi["2024-01-02"]["gmv_pct"] == 250.0 and kpi["2024-01-01"]["gmv_pct"] is None
    deltas = {str(r["dt"]): r for r in views.activity_deltas(views.kpi_trend(o)).collect()}
    assert set(deltas) == {"2024-01-02", "2024-01-03"}
    assert deltas["2024-01-03"]["new_orders"] == 5 and deltas["2024-01-03"]["shown"] == 3
    ov = views.overview(o).first()
    assert (ov["order_total"], ov["dau"], ov["gmv_total"]) == (8, 6, 60.0)
    assert views.overview(o.limit(0)).first()["aov"] == 0.0


def test_business_day_offset(spark):
    o = _orders(spark, [("O1", 1, 10, "2024-01-01 23:30:00"), ("O2", 2, 10, "2024-01-02 00:30:00")])
    utc = {str(r["dt"]): r["orders"] for r in totals(o, by_day=True).collect()}
    shifted = {str(r["dt"]): r["orders"] for r in totals(o, by_day=True, offset_hours=8).collect()}
    assert utc == {"2024-01-01": 1, "2024-01-02": 1}
    assert shifted == {"2024-01-02": 2}
    assert {str(r["dt"]) for r in active_users(o, by_day=True, offset_hours=8).collect()} == {"2024-01-02"}


def test_metrics_combined_payload(spark):
    o = _orders(spark, [("O1", 1, 10, "2024-01-01 10:00:00")])
    p = pts(spark, [("10:00", "A", 10.0)])
    row = views.metrics_combined(o, p).first()
    assert (row["category"], str(row["dt"]), row["window"], row["gmv"]) == ("A", "2024-01-01", "10:00", 10.0)
    assert row["window_ms"] == 1704103200000
    assert (row["gmv_total"], row["order_total"], row["dau"]) == (10.0, 1, 1)
