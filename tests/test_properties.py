"""Property tests: operators against brute-force Python on random small inputs."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shoppulse.operators.dedup import first_arrival
from shoppulse.operators.windows import window_gmv

BASE = dt.datetime(2024, 1, 1, 23, 50)
SCHEMA = "order_id string, user_id long, sku_id long, amount decimal(18,2), event_time timestamp_ntz, category string"

row = st.tuples(
    st.sampled_from(["O1", "O2", "O3", None]),
    st.one_of(st.none(), st.integers(0, 3)),
    st.integers(1, 3),
    st.one_of(st.none(), st.integers(0, 500).map(lambda c: Decimal(c) / 100)),
    st.one_of(st.none(), st.integers(0, 30 * 60).map(lambda s: BASE + dt.timedelta(seconds=s))),
    st.sampled_from(["A", "B"]),
)
SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))


def nulls_first(v):
    return (v is not None, v)


def nulls_last(v):
    return (v is None, v)


@SETTINGS
@given(st.lists(row, max_size=25))
def test_first_arrival_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in first_arrival(df).collect()]
    best = {}
    for r in rows:
        k = (nulls_last(r[4]), nulls_first(r[1]), nulls_first(r[2]), nulls_first(r[3]), nulls_first(r[5]))
        if r[0] not in best or k < best[r[0]][0]:
            best[r[0]] = (k, r)
    want = [v[1] for v in best.values()]
    key = lambda t: tuple(nulls_first(x) for x in t)
    assert sorted(got, key=key) == sorted(want, key=key)


@SETTINGS
@given(st.lists(row, max_size=25))
def test_sliding_windows_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {
        (r["window_start"], r["category"]): (r["gmv"], r["order_cnt"])
        for r in window_gmv(df).collect()
    }
    want = {}
    for oid, _, _, amount, ts, cat in rows:
        if ts is None:
            continue
        minute = ts.replace(second=0, microsecond=0)
        for k in range(5):  # 5-minute windows sliding by 1 minute
            start = minute - dt.timedelta(minutes=k)
            g, n = want.get((start, cat), (None, 0))
            if amount is not None:
                g = (g or Decimal(0)) + amount
            want[(start, cat)] = (g, n + (oid is not None))
    want = {k: (None if g is None else float(g), n) for k, (g, n) in want.items()}
    assert got == want
