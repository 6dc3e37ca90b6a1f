"""SQL face: the pipeline's stages as temp views, for ``spark.sql`` users.

    register_views(spark, "/data/tables")
    spark.sql("SELECT category, COUNT(*) AS cnt FROM sku_dim GROUP BY category")
    spark.sql("SELECT * FROM window_gmv WHERE category = 'SMALL'")

Views are lazy plans over the tables: a query over them is planned and
optimised as a whole (filters and projections still reach the parquet scans).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.dedup import first_arrival
from ..operators.joins import enrich_orders
from ..operators.windows import window_gmv
from ..sources.dimension import sku_catalogue, sku_dimension
from ..sources.tables import orders, read_table
from . import views

VIEWS = (
    "raw_orders",
    "orders_dedup",
    "sku_catalogue",
    "sku_dim",
    "enriched_orders",
    "window_gmv",
    "window_points",
)


def register_views(spark: SparkSession, sf_dir: str, prefix: str = "") -> list[str]:
    raw = orders(spark, sf_dir)
    dedup = first_arrival(raw)
    catalogue = sku_catalogue(read_table(spark, sf_dir, "part"))
    enriched = enrich_orders(dedup, catalogue)
    windows = window_gmv(enriched)
    frames = {
        "raw_orders": raw,
        "orders_dedup": dedup,
        "sku_catalogue": catalogue,
        "sku_dim": sku_dimension(spark, sf_dir),
        "enriched_orders": enriched,
        "window_gmv": windows,
        "window_points": views.window_points(windows),
    }
    names = []
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
