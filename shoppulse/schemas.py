"""Declared schemas and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# --- Fixed values (must equal the reference's for equal results) -------------
# Order event timestamp text format, as produced by the order simulator.
EVENT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Label for orders whose SKU has no dimension row.
UNKNOWN_CATEGORY = "未知"
# Watermark delay, sliding window length and slide, trigger interval.
WATERMARK_DELAY = "10 minutes"
WINDOW_LENGTH = "5 minutes"
WINDOW_SLIDE = "1 minute"
TRIGGER_INTERVAL = "30 seconds"
# Intake cap per trigger (offsets for Kafka; files for the file source here).
MAX_OFFSETS_PER_TRIGGER = 1000
# Store key prefix of the per-category window hash.
WINDOW_KEY_PREFIX = "rt:gmv:cat:"
# Dimension seed: base SKU ids 1..10, repeated as id + 10*n for n = 1..19.
DIM_BASE_IDS = 10
DIM_COPIES = 20
# Default size of the ranking board and the trend range (axis points).
TOP_K = 5
TREND_RANGES = {"15M": 15, "30M": 30, "1H": 60, "ALL": None}
# Activity feed: at most this many order items per poll.
FEED_MAX_ITEMS = 3
# Sample ids used to check the dimension lookup.
DIM_SAMPLE_IDS = (91, 46, 45, 200, 137)
# ------------------------------------------------------------------------------

# Money is summed exactly as DECIMAL(18,2) and cast to double on output.
MONEY = DecimalType(18, 2)

# Order event as published on the topic (all fields nullable).
ORDER_EVENT = StructType(
    [
        StructField("order_id", StringType()),
        StructField("user_id", LongType()),
        StructField("sku_id", LongType()),
        StructField("amount", DoubleType()),
        StructField("ts", StringType()),
    ]
)

SKU_DIM = StructType(
    [
        StructField("id", LongType()),
        StructField("sku_name", StringType()),
        StructField("category", StringType()),
        StructField("price", DecimalType(10, 2)),
    ]
)

ORDER_COLUMNS = ("order_id", "user_id", "sku_id", "amount", "event_time")
