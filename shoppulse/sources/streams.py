"""Streaming sources of order events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import decode_orders
from ..storage import publish, read_text


EARLIEST, LATEST = "earliest", "latest"
START_MARK = "start_position"  # file in the folder of a stream's checkpoints


def start_position(spark: SparkSession, folder: str, starting: str = LATEST) -> str:
    """Where a file stream begins, settled at its first start and kept in ``folder`` afterwards.

    ``earliest``, ``latest`` (what arrives from now on) or a UTC timestamp.  As on a topic,
    later starts go on from the checkpoint whatever they ask for.
    """
    path = f"{folder.rstrip('/')}/{START_MARK}"
    known = read_text(spark, path)
    if known:
        return known
    if starting == LATEST:
        at = str(spark.sql("SELECT date_format(current_timestamp(), 'yyyy-MM-dd HH:mm:ss.SSS') AS t").first()["t"])
    elif starting == EARLIEST:
        at = EARLIEST
    else:
        parsed = spark.sql("SELECT try_to_timestamp(:at) AS t", args={"at": starting}).first()["t"]
        if parsed is None:
            raise ValueError(f"start position {starting!r} is neither earliest, latest nor a timestamp")
        at = starting
    publish(spark, path, at)
    return at


def file_order_stream(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    starting: str = EARLIEST,
) -> DataFrame:
    """Order events as JSON lines in files under ``path`` (one record per line).

    Each line plays the role of a topic record's value: it is decoded with the
    fixed schema, never inferred.  ``max_files_per_trigger`` or
    ``max_bytes_per_trigger`` caps the intake per micro-batch, like
    ``maxOffsetsPerTrigger`` on a topic; unset: no cap.  ``starting`` (a settled
    ``start_position``) leaves out files that arrived before that time: they are not
    opened, since the filter is on the file's own time.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    lines = reader.load(path)
    if starting != EARLIEST:
        arrived = F.col("_metadata.file_modification_time")
        lines = lines.filter(arrived >= F.lit(starting).cast("timestamp")).select("value")
    return decode_orders(lines, "value")


def kafka_order_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Order events from a topic.  Needs the Spark Kafka connector on the class path.

    ``starting_offsets`` only applies to the first start; afterwards the
    checkpoint decides.  Partitions of the topic become parallel tasks.
    ``max_offsets_per_trigger`` caps the intake (the reference's setting is
    ``schemas.MAX_OFFSETS_PER_TRIGGER``); unset: all there is.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    try:
        raw = reader.load()
    except Exception as exc:
        if "kafka" in str(exc).lower() and "data source" in str(exc).lower():
            raise KafkaConnectorMissing(
                "the Spark Kafka connector is not on the class path; add the "
                "spark-sql-kafka package, or stage order JSON files and use "
                "file_order_stream"
            ) from exc
        raise
    return decode_orders(raw, "value")


class KafkaConnectorMissing(RuntimeError):
    pass


def publish_order_stream(orders_stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Publish a stream of orders as JSON lines (one object per order) to files.

    The file sink is exactly-once with its checkpoint; on a cluster with the
    connector, ``to_json`` output can go to a topic the same way.
    """
    from ..functions.codec import encode_orders

    writer = (
        encode_orders(orders_stream)
        .select(F.col("json").alias("value"))
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def publish_order_stream_to_topic(
    orders_stream: DataFrame,
    bootstrap_servers: str,
    topic: str,
    checkpoint: str,
    trigger: dict | None = None,
):
    """Publish a stream of orders as JSON records to a topic, continuously."""
    from ..functions.codec import encode_orders

    writer = (
        encode_orders(orders_stream)
        .select(F.col("order_id").alias("key"), F.col("json").alias("value"))
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def kafka_publish(orders_json: DataFrame, bootstrap_servers: str, topic: str):
    """Write (order_id, json) rows to a topic (batch); stream frames use writeStream."""
    (
        orders_json.selectExpr("CAST(json AS STRING) AS value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .save()
    )
