"""The SQL face: the dimension checks and views as plain Spark SQL."""

from conftest import SF01
from shoppulse.plans.sql import VIEWS, register_views


def test_dimension_checks_in_sql(spark):
    assert register_views(spark, SF01) == list(VIEWS)
    assert spark.sql("SELECT COUNT(*) AS total_rows FROM sku_dim").first()["total_rows"] == 200
    per_cat = spark.sql("SELECT category, COUNT(*) AS cnt FROM sku_dim GROUP BY category").collect()
    assert sum(r["cnt"] for r in per_cat) == 200
    lo_hi = spark.sql("SELECT MIN(id) AS min_id, MAX(id) AS max_id FROM sku_dim").first()
    assert (lo_hi["min_id"], lo_hi["max_id"]) == (1, 200)
    lookup = spark.sql(
        "SELECT id, sku_name, category, price FROM sku_dim WHERE id IN (91, 46, 45, 200, 137)"
    )
    assert lookup.count() == 5
    assert spark.sql("SELECT * FROM sku_catalogue ORDER BY id LIMIT 3").count() == 3


def test_views_compose_in_sql(spark):
    register_views(spark, SF01)
    total = spark.sql("SELECT COUNT(*) AS n FROM window_gmv").first()["n"]
    assert total == 45_395
    latest = spark.sql(
        """SELECT category, max(window_start) AS window_start, max_by(gmv, window_start) AS gmv
           FROM window_points GROUP BY category ORDER BY gmv DESC"""
    ).collect()
    assert len(latest) == 6
    dau = spark.sql(
        "SELECT to_date(event_time) AS dt, count(DISTINCT user_id) AS dau FROM orders_dedup GROUP BY 1"
    )
    assert dau.count() == 30
