"""Dimension joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import UNKNOWN_CATEGORY


def one_row_per_id(dim: DataFrame) -> DataFrame:
    """(id, category) with the least category of each id: a repeated id never multiplies orders."""
    return dim.groupBy("id").agg(F.min("category").alias("category"))


def enrich_orders(orders: DataFrame, dim: DataFrame, label: str = UNKNOWN_CATEGORY) -> DataFrame:
    """Left join orders to the dimension on ``sku_id = id``; unmatched -> ``label``.

    Only ``id`` and ``category`` are taken from the dimension, so its scan reads two
    columns.  There is no broadcast hint: Spark's size threshold decides, and AQE from
    the sizes it measures, so a dimension that has grown is shuffled and a skewed
    key is split.
    """
    side = one_row_per_id(dim).select(
        F.col("id").alias("_dim_id"), F.col("category").alias("_dim_category")
    )
    joined = orders.join(side, orders["sku_id"] == side["_dim_id"], "left")
    return joined.select(
        *[orders[c] for c in orders.columns],
        F.coalesce(F.col("_dim_category"), F.lit(label)).alias("category"),
    )
