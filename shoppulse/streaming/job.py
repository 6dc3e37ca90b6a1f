"""Run the streaming job: order events in, ledgers out, until a query ends.

    python -m shoppulse.streaming.job --source /shared/orders/ \
        --dim-parquet /shared/sku_dim/ --trigger "30 seconds"

(or the same module as the main file of a spark-submit with the package on --py-files).

The dimension comes from published snapshots, parquet or JDBC and is joined as read on
every micro-batch.  A parquet folder's file listing is taken once at start, so a
dimension that changes while the job runs belongs in snapshots
(``DimensionSnapshots.publish``) or in JDBC, which are looked up at each trigger.
Ledgers and checkpoints go under ``--root``, default ``<spark.checkpoint.dir>/<name>``.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from ..operators.dedup import EXACT, EXACT_LEDGER, WITHIN_WATERMARK
from ..schemas import TRIGGER_INTERVAL
from ..session import checkpoint_root, configure
from ..sources.dimension import DimensionSnapshots, read_jdbc_dimension
from ..sources.streams import EARLIEST, file_order_stream, kafka_order_stream, start_position
from .streams import MetricStreams, StreamConfig, start_streams


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="shoppulse.streaming.job")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--source", help="folder of order events as JSON lines")
    src.add_argument("--kafka", help="bootstrap servers; needs --topic and the Kafka connector")
    p.add_argument("--topic", default="orders")
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--starting", default=EARLIEST,
                   help="file source: earliest, latest or a UTC timestamp; the first start decides")
    p.add_argument("--max-bytes", type=int, default=None, help="file source: bytes per micro-batch")
    p.add_argument("--max-per-trigger", type=int, default=None,
                   help="files (file source) or offsets (Kafka) per micro-batch; unset: no cap")
    dim = p.add_mutually_exclusive_group(required=True)
    dim.add_argument("--dim-snapshots", help="SKU dimension as published snapshots")
    dim.add_argument("--dim-parquet", help="SKU dimension as parquet (id, category, ...)")
    dim.add_argument("--dim-jdbc-url", help="SKU dimension over JDBC")
    p.add_argument("--dim-table", default="sku_dim")
    p.add_argument("--dim-driver", default=None)
    p.add_argument("--dim-user", default=None)
    p.add_argument("--dim-password-env", default=None,
                   help="environment variable that holds the database password")
    p.add_argument("--dim-partition-column", default=None,
                   help="numeric column to split the JDBC read by")
    p.add_argument("--dim-lower-bound", type=int, default=None)
    p.add_argument("--dim-upper-bound", type=int, default=None)
    p.add_argument("--dim-partitions", type=int, default=None)
    p.add_argument("--name", default="shoppulse")
    p.add_argument("--root", default=None)
    p.add_argument("--layout", choices=["single", "three"], default="single")
    p.add_argument("--dedup", choices=[EXACT, WITHIN_WATERMARK, EXACT_LEDGER], default=WITHIN_WATERMARK)
    p.add_argument("--trigger", default=TRIGGER_INTERVAL)
    p.add_argument("--available-now", action="store_true", help="drain what is there, then stop")
    p.add_argument("--offset-hours", type=int, default=0)
    p.add_argument("--compact-every", type=int, default=100)
    p.add_argument("--closed-windows", action="store_true",
                   help="also emit each window once, when the watermark has passed it")
    p.add_argument("--state-partitions", type=int, default=None,
                   help="state/shuffle partitions of the stateful operators (fixed at first start)")
    return p.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> MetricStreams:
    configure(spark)
    if args.source:
        root = (args.root or f"{checkpoint_root(spark)}/{args.name}").rstrip("/")
        starting = start_position(spark, f"{root}/checkpoint", args.starting)
        stream = file_order_stream(spark, args.source, args.max_per_trigger, args.max_bytes, starting)
    else:
        stream = kafka_order_stream(
            spark, args.kafka, args.topic, args.starting_offsets, args.max_per_trigger
        )
    if args.dim_snapshots:
        dim = DimensionSnapshots(args.dim_snapshots)
    elif args.dim_parquet:
        dim = spark.read.parquet(args.dim_parquet)
    else:
        props = {
            k: v
            for k, v in {
                "driver": args.dim_driver,
                "user": args.dim_user,
                "password": os.environ[args.dim_password_env] if args.dim_password_env else None,
            }.items()
            if v
        }
        dim = read_jdbc_dimension(
            spark,
            args.dim_jdbc_url,
            args.dim_table,
            props,
            args.dim_partition_column,
            args.dim_lower_bound,
            args.dim_upper_bound,
            args.dim_partitions,
        )
    trigger = {"availableNow": True} if args.available_now else {"processingTime": args.trigger}
    cfg = StreamConfig(
        name=args.name,
        dedup_mode=args.dedup,
        trigger=trigger,
        offset_hours=args.offset_hours,
        compact_every=args.compact_every,
        layout=args.layout,
        root=args.root,
        state_partitions=args.state_partitions,
        closed_windows=args.closed_windows,
    )
    return start_streams(spark, stream, dim, cfg)


def main(argv: list[str] | None = None) -> MetricStreams:
    args = parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    pipe = run(spark, args)
    if args.available_now:
        pipe.await_all()
    else:
        pipe.await_any()
    return pipe


if __name__ == "__main__":
    main()
