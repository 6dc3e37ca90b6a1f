"""Independent SQL (DuckDB dialect) for each registered query.

Written from the semantics, not generated from the Spark plans.  Shared CTEs:
``raw_orders`` (events as orders + the 2 % re-sent copies), ``dedup`` (first
arrival per order id), ``dim`` (seeded SKU dimension), ``enriched`` and
``win`` (5 min / 1 min sliding windows).
"""

from __future__ import annotations

ORDERS = """
ev AS (
  SELECT event_id,
         'O' || CAST(event_id AS VARCHAR) AS order_id,
         user_id,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS sku_id,
         CAST(value AS DECIMAL(18,2)) AS amount,
         ts AS event_time
  FROM events
),
raw_orders AS (
  SELECT event_id, order_id, user_id, sku_id, amount, event_time FROM ev
  UNION ALL
  SELECT event_id, order_id, user_id, sku_id, amount, event_time FROM ev WHERE event_id % 50 = 0
),
dedup AS (
  SELECT event_id, order_id, user_id, sku_id, amount, event_time FROM (
    SELECT *, row_number() OVER (
      PARTITION BY order_id
      ORDER BY event_time NULLS LAST, user_id NULLS FIRST, sku_id NULLS FIRST,
               amount NULLS FIRST) AS rn
    FROM raw_orders)
  WHERE rn = 1
)"""

DIM = """
catalogue AS (
  SELECT p_partkey AS id, p_name AS sku_name, p_type AS category,
         CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS price
  FROM part
),
dim AS (
  SELECT c.id + 10 * s.n AS id, c.sku_name, c.category, c.price
  FROM catalogue c, (SELECT range AS n FROM range(0, 20)) s
  WHERE c.id BETWEEN 1 AND 10
)"""

ENRICHED = """
enriched AS (
  SELECT o.order_id, o.user_id, o.sku_id, o.amount, o.event_time,
         COALESCE(d.category, '未知') AS category
  FROM dedup o LEFT JOIN catalogue d ON o.sku_id = d.id
)"""

WIN = """
win AS (
  SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, category,
         CAST(SUM(amount) AS DOUBLE) AS gmv, COUNT(order_id) AS order_cnt
  FROM (
    SELECT time_bucket(INTERVAL 1 MINUTE, event_time) - k.k * INTERVAL 1 MINUTE AS window_start,
           category, amount, order_id
    FROM enriched, (SELECT range AS k FROM range(0, 5)) k
    WHERE event_time IS NOT NULL)
  GROUP BY window_start, category
),
points AS (
  SELECT window_start, window_end, category, gmv FROM win WHERE gmv IS NOT NULL
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


BASE = _with(ORDERS)
FULL = _with(ORDERS, DIM, ENRICHED, WIN)
DIMS = _with(DIM)

RANK = """
last AS (
  SELECT category, max(window_start) AS last_ws, arg_max(gmv, window_start) AS gmv
  FROM points GROUP BY category
),
prev AS (
  SELECT p.category, arg_max(p.gmv, p.window_start) AS prev
  FROM points p JOIN last l ON p.category = l.category
  WHERE p.window_start < l.last_ws GROUP BY p.category
),
board AS (
  SELECT l.category, COALESCE(l.gmv, 0.0) AS gmv,
         CASE WHEN pr.prev IS NOT NULL AND pr.prev <> 0 AND l.gmv IS NOT NULL
              THEN (l.gmv - pr.prev) / pr.prev * 100.0 END AS trend
  FROM last l LEFT JOIN prev pr ON l.category = pr.category
),
ranked AS (
  SELECT CAST(row_number() OVER (ORDER BY gmv DESC, category) AS BIGINT) AS rank,
         category, gmv,
         floor(trend * 10.0 + 0.5) / 10.0 AS trend_pct,
         CASE WHEN trend >= 0 THEN 'up' WHEN trend < 0 THEN 'down' END AS direction,
         CASE WHEN sum(gmv) OVER () > 0
              THEN floor(gmv / sum(gmv) OVER () * 100.0 * 10.0 + 0.5) / 10.0
              ELSE 0.0 END AS share_pct
  FROM board
)"""

KPI = """
daily AS (
  SELECT CAST(event_time AS DATE) AS dt, SUM(amount) AS gmv_d, COUNT(order_id) AS orders_d
  FROM dedup GROUP BY 1
),
first_seen AS (
  SELECT dt, COUNT(*) AS new_users FROM (
    SELECT user_id, MIN(CAST(event_time AS DATE)) AS dt FROM dedup
    WHERE user_id IS NOT NULL GROUP BY user_id)
  GROUP BY dt
),
snap AS (
  SELECT dt,
         CAST(SUM(COALESCE(gmv_d, 0)) OVER w AS DOUBLE) AS gmv,
         CAST(SUM(COALESCE(orders_d, 0)) OVER w AS BIGINT) AS orders,
         CAST(SUM(COALESCE(new_users, 0)) OVER w AS BIGINT) AS dau
  FROM daily FULL JOIN first_seen USING (dt)
  WINDOW w AS (ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
snap2 AS (
  SELECT *, CASE WHEN orders <> 0 THEN gmv / CAST(orders AS DOUBLE) ELSE 0.0 END AS aov FROM snap
),
kpi AS (
  SELECT dt, gmv, orders, dau, aov,
    CASE WHEN lag(gmv) OVER o <> 0 THEN (gmv - lag(gmv) OVER o) / lag(gmv) OVER o * 100.0 END AS gmv_pct,
    CASE WHEN lag(orders) OVER o <> 0
         THEN (CAST(orders AS DOUBLE) - lag(orders) OVER o) / lag(orders) OVER o * 100.0 END AS orders_pct,
    CASE WHEN lag(dau) OVER o <> 0
         THEN (CAST(dau AS DOUBLE) - lag(dau) OVER o) / lag(dau) OVER o * 100.0 END AS dau_pct,
    CASE WHEN lag(orders) OVER o > 0 AND lag(aov) OVER o <> 0
         THEN (aov - lag(aov) OVER o) / lag(aov) OVER o * 100.0 END AS aov_pct
  FROM snap2 WINDOW o AS (ORDER BY dt)
)"""

ALIGNED = """
axis AS (SELECT DISTINCT window_start FROM points),
cats AS (SELECT DISTINCT category FROM points),
aligned AS (
  SELECT a.window_start, c.category, p.gmv
  FROM axis a CROSS JOIN cats c
  LEFT JOIN points p ON p.window_start = a.window_start AND p.category = c.category
)"""

LINES = """
li AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate NULLS LAST, l_partkey NULLS FIRST, l_extendedprice NULLS FIRST,
               l_discount NULLS FIRST) AS rn
    FROM lineitem)
  WHERE rn = 1
),
line_orders AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS order_id,
         l.l_partkey AS sku_id,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS amount,
         o.o_orderdate AS event_time
  FROM li l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
line_enriched AS (
  SELECT lo.*, COALESCE(p.p_type, '未知') AS category
  FROM line_orders lo LEFT JOIN part p ON lo.sku_id = p.p_partkey
)"""

SQL: dict[str, str] = {
    "dim_scan": DIMS + " SELECT id, sku_name, category, price FROM catalogue",
    "dim_seed": DIMS + " SELECT id, sku_name, category, price FROM dim",
    "dim_lookup": DIMS
    + " SELECT id, sku_name, category, price FROM catalogue WHERE id IN (91, 46, 45, 200, 137)",
    "dim_head": DIMS + " SELECT id, sku_name, category, price FROM catalogue ORDER BY id LIMIT 3",
    "dim_stats": DIMS
    + " SELECT COUNT(*) AS total_rows, MIN(id) AS min_id, MAX(id) AS max_id FROM catalogue",
    "dim_by_category": DIMS + " SELECT category, COUNT(*) AS cnt FROM catalogue GROUP BY category",
    "dim_key_violations": """
SELECT l_orderkey, l_linenumber, COUNT(*) AS cnt FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "decode_orders": BASE
    + """
SELECT order_id, user_id, sku_id, CAST(amount AS DOUBLE) AS amount,
       date_trunc('second', event_time) AS event_time
FROM raw_orders""",
    "orders_as_json": BASE
    + """
SELECT order_id,
       CAST(to_json(struct_pack(order_id := order_id, user_id := user_id, sku_id := sku_id,
                                amount := CAST(amount AS DOUBLE),
                                ts := strftime(event_time, '%Y-%m-%d %H:%M:%S'))) AS VARCHAR) AS json
FROM raw_orders""",
    "dedup_orders": BASE
    + " SELECT order_id, user_id, sku_id, CAST(amount AS DOUBLE) AS amount, event_time FROM dedup",
    "enrich_orders": FULL
    + """
SELECT order_id, user_id, sku_id, CAST(amount AS DOUBLE) AS amount, event_time, category
FROM enriched""",
    "window_gmv": FULL + " SELECT window_start, window_end, category, gmv, order_cnt FROM win",
    "window_store": FULL
    + " SELECT 'rt:gmv:cat:' || category AS store_key, category, window_start, gmv FROM points",
    "totals_all": BASE
    + " SELECT CAST(SUM(amount) AS DOUBLE) AS gmv, COUNT(order_id) AS orders FROM dedup",
    "totals_daily": BASE
    + """
SELECT CAST(event_time AS DATE) AS dt, CAST(SUM(amount) AS DOUBLE) AS gmv,
       COUNT(order_id) AS orders
FROM dedup GROUP BY 1""",
    "dau_all": BASE + " SELECT COUNT(DISTINCT user_id) AS dau FROM dedup",
    "dau_daily": BASE
    + " SELECT CAST(event_time AS DATE) AS dt, COUNT(DISTINCT user_id) AS dau FROM dedup GROUP BY 1",
    "batch_deltas": BASE
    + """
SELECT CAST(floor(event_id / 1000) AS BIGINT) AS batch_id, CAST(SUM(amount) AS DOUBLE) AS gmv,
       COUNT(order_id) AS orders, COUNT(DISTINCT user_id) AS users
FROM dedup GROUP BY 1 HAVING SUM(amount) IS NOT NULL""",
    "late_orders": BASE
    + """,
arrivals AS (
  SELECT event_time,
         CAST(floor(epoch_us(event_time + to_seconds((event_id * 7919) % 3601)) / 600000000)
              AS BIGINT) AS batch
  FROM raw_orders
),
per_batch AS (SELECT batch, max(event_time) AS max_et FROM arrivals GROUP BY batch),
marks AS (
  SELECT batch,
         date_trunc('millisecond', max(max_et) OVER (
           ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING))
         - INTERVAL 10 MINUTE AS watermark
  FROM per_batch
)
SELECT a.batch, CAST(COUNT(*) FILTER (WHERE a.event_time <= m.watermark) AS BIGINT) AS n
FROM arrivals a LEFT JOIN marks m ON a.batch = m.batch
GROUP BY a.batch""",
    "overview": BASE
    + """
SELECT CAST(COALESCE(SUM(amount), 0) AS DOUBLE) AS gmv_total, COUNT(order_id) AS order_total,
       COUNT(DISTINCT user_id) AS dau,
       CASE WHEN COUNT(order_id) <> 0
            THEN CAST(COALESCE(SUM(amount), 0) AS DOUBLE) / CAST(COUNT(order_id) AS DOUBLE)
            ELSE 0.0 END AS aov
FROM dedup""",
    "latest_window": FULL
    + """
SELECT category, max(window_start) AS window_start,
       strftime(max(window_start), '%H:%M') AS "window",
       arg_max(gmv, window_start) AS gmv
FROM points GROUP BY category ORDER BY gmv DESC, category""",
    "latest_closed_window": FULL
    + """,
wm AS (
  SELECT date_trunc('millisecond', max(event_time)) - INTERVAL 10 MINUTE AS as_of FROM raw_orders
)
SELECT category, max(window_start) AS window_start,
       strftime(max(window_start), '%H:%M') AS "window",
       arg_max(gmv, window_start) AS gmv
FROM points WHERE window_end <= (SELECT as_of FROM wm)
GROUP BY category ORDER BY gmv DESC, category""",
    "trend_long": FULL
    + " SELECT category, window_start, gmv FROM points ORDER BY category, window_start",
    "trend_arrays": FULL
    + """
SELECT category, CAST(window_start AS DATE) AS dt,
       CAST(row_number() OVER (PARTITION BY category, CAST(window_start AS DATE)
                               ORDER BY window_start) - 1 AS INTEGER) AS pos,
       strftime(window_start, '%H:%M') AS time, gmv
FROM points""",
    "trend_arrays_last_n": FULL
    + """
SELECT category, dt, CAST(p - greatest(c - 60, 0) - 1 AS INTEGER) AS pos, time, gmv FROM (
  SELECT category, CAST(window_start AS DATE) AS dt, strftime(window_start, '%H:%M') AS time, gmv,
         row_number() OVER (PARTITION BY category, CAST(window_start AS DATE) ORDER BY window_start) AS p,
         count(*) OVER (PARTITION BY category, CAST(window_start AS DATE)) AS c
  FROM points)
WHERE p > c - 60""",
    "trend_lookup": FULL
    + """,
days AS (SELECT DISTINCT category, CAST(window_start AS DATE) AS dt FROM points)
SELECT d.category, d.dt, CAST(h.h AS INTEGER) AS hour, p.gmv
FROM days d CROSS JOIN (SELECT range AS h FROM range(0, 24)) h
LEFT JOIN points p ON p.category = d.category
  AND p.window_start = CAST(d.dt AS TIMESTAMP) + h.h * INTERVAL 1 HOUR""",
    "metrics_combined": FULL
    + """,
head AS (
  SELECT CAST(COALESCE(SUM(amount), 0) AS DOUBLE) AS gmv_total, COUNT(order_id) AS order_total,
         COUNT(DISTINCT user_id) AS dau FROM dedup
)
SELECT category, CAST(window_start AS DATE) AS dt, strftime(window_start, '%H:%M') AS "window",
       CAST(epoch_ms(window_start) AS BIGINT) AS window_ms, gmv, gmv_total, order_total, dau
FROM points CROSS JOIN head""",
    "trend_aligned": FULL + "," + ALIGNED + " SELECT window_start, category, gmv FROM aligned",
    "trend_last_n": FULL
    + ","
    + ALIGNED
    + """,
recent AS (SELECT window_start FROM axis ORDER BY window_start DESC LIMIT 60)
SELECT window_start, category, gmv FROM aligned
WHERE window_start IN (SELECT window_start FROM recent)""",
    "category_rank": FULL
    + ","
    + RANK
    + " SELECT rank, category, gmv, trend_pct, direction, share_pct FROM ranked",
    "category_top_k": FULL
    + ","
    + RANK
    + " SELECT rank, category, gmv, trend_pct, direction, share_pct FROM ranked ORDER BY rank LIMIT 5",
    "kpi_trend": BASE
    + ","
    + KPI
    + " SELECT dt, gmv, orders, dau, aov, gmv_pct, orders_pct, dau_pct, aov_pct FROM kpi",
    "activity_deltas": BASE
    + ","
    + KPI
    + """
SELECT dt, new_orders, new_users,
       CAST(CASE WHEN new_orders > 0 THEN least(new_orders, 3) ELSE 0 END AS BIGINT) AS shown
FROM (
  SELECT dt, orders - lag(orders) OVER (ORDER BY dt) AS new_orders,
         dau - lag(dau) OVER (ORDER BY dt) AS new_users
  FROM kpi)
WHERE new_orders IS NOT NULL""",
    "line_window_revenue": "WITH "
    + LINES
    + """
SELECT window_start, window_start + INTERVAL 5 DAY AS window_end, category,
       CAST(SUM(amount) AS DOUBLE) AS gmv, COUNT(order_id) AS order_cnt
FROM (
  SELECT time_bucket(INTERVAL 1 DAY, event_time) - k.k * INTERVAL 1 DAY AS window_start,
         category, amount, order_id
  FROM line_enriched, (SELECT range AS k FROM range(0, 5)) k
  WHERE event_time IS NOT NULL)
GROUP BY window_start, category""",
}

SQL["sku_rank"] = (
    "WITH "
    + LINES
    + """,
sold AS (SELECT sku_id, SUM(amount) AS gmv FROM line_enriched GROUP BY sku_id)
SELECT row_number() OVER (ORDER BY gmv DESC, sku_id) AS rank, sku_id, CAST(gmv AS DOUBLE) AS gmv,
       CAST(SUM(gmv) OVER (ORDER BY gmv DESC, sku_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS gmv_upto
FROM sold WHERE gmv IS NOT NULL"""
)

# The streaming ledgers must equal the batch answers.
SQL["stream_overview"] = SQL["overview"]
SQL["stream_dau_daily"] = SQL["dau_daily"]
SQL["stream_latest_window"] = SQL["latest_window"]
SQL["stream_category_rank"] = SQL["category_rank"]
SQL["stream_closed_window"] = SQL["latest_closed_window"]
SQL["stream_kpi_trend"] = SQL["kpi_trend"]
SQL["stream_late_rows"] = (
    BASE
    + """,
arrivals AS (
  SELECT event_time,
         CAST(floor(epoch_us(event_time + to_seconds((event_id * 7919) % 518400)) / 259200000000)
              AS BIGINT) AS batch
  FROM raw_orders
),
per_batch AS (SELECT batch, max(event_time) AS max_et FROM arrivals GROUP BY batch),
marks AS (
  SELECT batch, row_number() OVER (ORDER BY batch) - 1 AS batch_id,
         date_trunc('millisecond', max(max_et) OVER (
           ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING))
         - INTERVAL 10 MINUTE AS watermark
  FROM per_batch
)
SELECT CAST(m.batch_id AS BIGINT) AS batch_id,
       CAST(COUNT(*) FILTER (WHERE a.event_time <= m.watermark) AS BIGINT) AS n
FROM arrivals a JOIN marks m ON a.batch = m.batch
GROUP BY m.batch_id"""
)
SQL["stream_resent_exact"] = SQL["overview"]
SQL["stream_resent_ledger"] = SQL["overview"]
# A copy that comes after all originals, dated anew, is admitted by the bounded dedup when
# its original's state has expired: event time + 10 minutes is not after the watermark the
# last batch of originals evicted with (from the batches before it).
SQL["stream_resent_within"] = (
    BASE
    + """,
span AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events),
b AS (
  SELECT order_id, user_id, amount, event_id, date_trunc('second', event_time) AS t,
         CAST(floor((event_id - lo) * 10 / (hi - lo + 1)) AS BIGINT) AS batch
  FROM ev, span
),
mark AS (SELECT max(t) - INTERVAL 10 MINUTE AS w FROM b WHERE batch <= 8),
passed AS (
  SELECT order_id, user_id, amount FROM b
  UNION ALL
  SELECT order_id, user_id, amount FROM b, mark
  WHERE event_id % 50 = 0 AND t + INTERVAL 10 MINUTE <= w
)
SELECT CAST(COALESCE(SUM(amount), 0) AS DOUBLE) AS gmv_total, COUNT(order_id) AS order_total,
       COUNT(DISTINCT user_id) AS dau,
       CASE WHEN COUNT(order_id) <> 0
            THEN CAST(COALESCE(SUM(amount), 0) AS DOUBLE) / CAST(COUNT(order_id) AS DOUBLE)
            ELSE 0.0 END AS aov
FROM passed"""
)
