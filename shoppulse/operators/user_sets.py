"""Exact, mergeable sets of user ids, by day.

Ids are cut into buckets of 32,768 numbers (``bitmap_bucket_number``).  A bucket with more
than ``SPARSE`` users is a bitmap of 4 KB, any other an array of places, so ids that
lie close together cost a bit each and scattered ones a few bytes each.  Sets of any two
inputs unite by bucket, exactly, for all long ids; nothing is ever counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPARSE = 256  # users of a bucket that are listed one by one


def user_sets(users: DataFrame, sets: DataFrame | None = None) -> DataFrame:
    """dt, bucket, bits, places, n: the users (dt, user_id) united with earlier ``sets``.

    Null ids are no users; a null dt is a day of its own.  ``sets`` may hold a bucket
    several times, which unites them too.  A group has at most 32,768 different places.
    """
    pairs = users.filter("user_id is not null").select(
        "dt",
        F.bitmap_bucket_number("user_id").alias("bucket"),
        F.bitmap_bit_position("user_id").cast("int").alias("place"),
    )
    known = None
    if sets is not None:
        pairs = pairs.unionByName(sets.select("dt", "bucket", F.explode("places").alias("place")))
        known = sets.filter("bits is not null").select("dt", "bucket", "bits")
    pairs = pairs.distinct().withColumn("n", F.count("*").over(Window.partitionBy("dt", "bucket")))
    dense = F.col("n") > SPARSE
    if known is not None:
        held = known.select(F.col("dt").alias("_dt"), F.col("bucket").alias("_bucket")).distinct()
        same = F.col("dt").eqNullSafe(F.col("_dt")) & (F.col("bucket") == F.col("_bucket"))
        pairs = pairs.join(held, same, "left")
        dense = dense | F.col("_bucket").isNotNull()
    bits = pairs.filter(dense).groupBy("dt", "bucket").agg(F.bitmap_construct_agg("place").alias("bits"))
    if known is not None:
        bits = bits.unionByName(known).groupBy("dt", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    listed = pairs.filter(~dense).groupBy("dt", "bucket").agg(F.sort_array(F.collect_list("place")).alias("places"))
    return bits.unionByName(listed, allowMissingColumns=True).select(
        "dt",
        "bucket",
        "bits",
        "places",
        F.coalesce(F.bitmap_count("bits"), F.size("places")).cast("bigint").alias("n"),
    )


def count_users(sets: DataFrame, by_day: bool = False) -> DataFrame:
    """``dau`` of united sets (one row a bucket), per day or in all."""
    if by_day:
        return sets.groupBy("dt").agg(F.sum("n").alias("dau"))
    return sets.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("dau"))


def first_seen(sets: DataFrame) -> DataFrame:
    """dt, new_users: how many users were seen on each day for the first time.

    ``sets`` has one row a day and bucket.  Buckets that are a bitmap on any day are united
    day by day (a bucket's days are one group, 4 KB a day); in the others each user's
    least day counts.  A user without a day (null dt) is new there only if no day has them.
    """
    day = F.col("dt")
    dense = sets.groupBy("bucket").agg(F.max(F.col("bits").isNotNull()).alias("dense"))
    marked = sets.join(dense, "bucket")
    listed = marked.filter(~F.col("dense")).select("bucket", "dt", F.explode("places").alias("place"))
    sparse = listed.groupBy("bucket", "place").agg(F.min("dt").alias("dt")).groupBy("dt").agg(F.count("*").alias("n"))

    held = marked.filter("dense")
    made = held.filter("bits is null").select("bucket", "dt", F.explode("places").alias("place"))
    made = made.groupBy("bucket", "dt").agg(F.bitmap_construct_agg("place").alias("bits"))
    bitmaps = held.filter("bits is not null").select("bucket", "dt", "bits").unionByName(made)
    by_day = Window.partitionBy("bucket").orderBy(day.asc_nulls_last())
    upto = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    united = bitmaps.withColumn("n", F.bitmap_count(F.bitmap_or_agg("bits").over(upto)))
    fresh = united.select("dt", (F.col("n") - F.coalesce(F.lag("n").over(by_day), F.lit(0))).alias("n"))
    return sparse.unionByName(fresh).groupBy("dt").agg(F.sum("n").alias("new_users"))
