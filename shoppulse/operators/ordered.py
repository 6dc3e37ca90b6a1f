"""Positions and running totals in a global order, without gathering the rows in one task.

Rows are range-partitioned by the order's columns and written once with the number of
their range (the ranges come from a sample, so they must not be drawn twice).  Windows
then run inside each range; what the earlier ranges hold is added from one row a range.
A key that holds very many rows is one range's: name enough columns to tell rows apart.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root, ensure_checkpoint_dir

# how a running figure goes on from the ranges before it
MERGE = {
    "sum": (F.sum, lambda before, own: before + own),
    "max": (F.max, lambda before, own: F.greatest(before, own)),
    "min": (F.min, lambda before, own: F.least(before, own)),
}


def ranged(rows: DataFrame, keys: list[Column | str], ranges: int | None = None) -> DataFrame:
    """``rows`` cut into ranges of the order, with ``_range``, as a written table."""
    spark = rows.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = rows.repartitionByRange(n, *keys).withColumn("_range", F.spark_partition_id())
    ensure_checkpoint_dir(spark)
    path = f"{checkpoint_root(spark)}/ordered/{uuid.uuid4().hex[:12]}"
    cut.write.parquet(path)
    return spark.read.schema(cut.schema).parquet(path)


def ordered(
    rows: DataFrame,
    keys: list[Column | str],
    running: dict[str, tuple[str, str]] | None = None,
    position: str = "position",
    ranges: int | None = None,
) -> DataFrame:
    """``rows`` with their place in the order (from 1) and running figures up to each row.

    ``running`` maps a new column to (``sum``, ``max`` or ``min``, column).  Nulls count as
    in the aggregates of the same names; ties of all keys are placed in any order.
    """
    running = running or {}
    cut = ranged(rows, keys, ranges)
    figures = [MERGE[how][0](column).alias(f"_{name}") for name, (how, column) in running.items()]
    totals = cut.groupBy("_range").agg(F.count("*").alias("_rows"), *figures)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    before = totals.select(
        F.col("_range"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        *(MERGE[how][0](f"_{name}").over(earlier).alias(f"_{name}_before") for name, (how, _) in running.items()),
    )
    inside = Window.partitionBy("_range").orderBy(*keys)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = cut.withColumns(
        {
            "_place": F.row_number().over(inside),
            **{f"_{name}_own": MERGE[how][0](column).over(upto) for name, (how, column) in running.items()},
        }
    ).join(before, "_range")

    def merged(name: str, how: str) -> Column:
        own, sofar = F.col(f"_{name}_own"), F.col(f"_{name}_before")
        kind = placed.schema[f"_{name}_own"].dataType
        both = F.coalesce(MERGE[how][1](sofar, own), own, sofar)
        return both.cast(kind).alias(name)

    return placed.select(
        *(F.col(f"`{c}`") for c in rows.columns),
        (F.col("_rows_before") + F.col("_place")).cast("bigint").alias(position),
        *(merged(name, how) for name, (how, _) in running.items()),
    )
