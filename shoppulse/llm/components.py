"""Connected components of a link table, with every step on Spark.

Large-star and small-star steps alternate: each links the neighbours of a node to the
smallest of them, until every node points at its component's smallest id.  Each round
is written to the shared folder; only two counters come back to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b), component being the smallest id reachable.

    Self links and repeated links are allowed.  An empty table gives an empty result.
    """
    spark = links.sparkSession
    edges = (
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    edges = stored(spark, edges, "cc-edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: larger neighbours to the smallest of the neighbourhood
        least = _smallest(both).select("u", F.least("u", "m").alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        large = stored(spark, large, "cc-large")
        # small star: smaller neighbours and the node itself to the smallest
        least = _smallest(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        small = stored(spark, small, "cc-small")
        changed = small.join(edges, ["u", "v"], "left_anti").limit(1).count()
        changed += edges.join(small, ["u", "v"], "left_anti").limit(1).count()
        discard(edges, large)
        edges = small
        if not changed:
            break
    # every edge now points at its component's smallest id
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
