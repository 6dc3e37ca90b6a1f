"""Batch-keyed ledger sinks: the exactly-once replacement of the key-value store.

Every ``foreachBatch`` callback writes its result to ``<kind>/<generation>/deltas/batch_id=N``
with overwrite.  A micro-batch replayed after a failure carries the same id, so it
replaces its own earlier output instead of adding to it (the counters of the
reference double-count in that case).  Writing the explicit partition path
also makes an empty result replace an earlier non-empty one.

Reads fold the ledger back into the served values:
- windows: per (window_start, category) the row of the greatest batch id;
- totals: sum of the per-batch deltas.  A batch whose amounts are all null adds
  nothing, not even its order count, as in the reference; so the order total of
  such orders depends on how the stream was cut into batches;
- users: exact sets of user ids per day (``user_sets``), united over days for all time.

Folding is kept as *versions*.  A version is a small manifest that names one folder for
each day and the last batch they hold.  Compaction reads the new deltas and the days that
these touch, writes those days anew, and publishes a manifest that keeps all other days'
folders: behind the watermark a day gets no more rows, so closed days are never read or
written again.  Manifests are written aside and renamed; one that is cut short or empty
counts as not there, and the version before it is served with the deltas it needs.

Batch ids restart at 0 when a checkpoint is deleted.  So a ledger is kept by *generation*:
its id lies in the checkpoint folder and in the ledger.  A fresh checkpoint opens a new
generation, which starts empty; a checkpoint of another generation than the ledger's
is refused, and so is a batch that has been folded already.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    DoubleType,
)

from ..operators.totals import business_date
from ..operators.user_sets import count_users, first_seen, user_sets
from ..operators.windows import window_aggregate
from ..plans.views import kpi_snapshots
from ..schemas import WINDOW_LENGTH, WINDOW_SLIDE
from ..storage import children, publish, published, read_text, remove

WINDOWS = "windows"
WINDOW_SUMS = "window_sums"
TOTALS = "totals"
USERS = "users"
DAYS = "day_totals"
CLOSED = "closed_windows"
SEEN = "seen"  # order ids counted so far (``seen.SeenIds``)
LATE = "late"  # rows dropped behind the watermark (``late_rows.LateRows``)

UNBOUND = "unbound"  # generation of a ledger that is used without a checkpoint
GENERATION_MARK = "ledger_generation"  # file in a query's checkpoint folder
NO_DAY = "none"  # rows without event time
ALL_DAYS = "all"  # the one folder of the running totals

SCHEMAS = {
    WINDOWS: StructType(
        [
            StructField("window_start", TimestampNTZType()),
            StructField("window_end", TimestampNTZType()),
            StructField("category", StringType()),
            StructField("gmv", DoubleType()),
            StructField("order_cnt", LongType()),
            StructField("batch_id", LongType()),
        ]
    ),
    WINDOW_SUMS: StructType(
        [
            StructField("window_start", TimestampNTZType()),
            StructField("window_end", TimestampNTZType()),
            StructField("category", StringType()),
            StructField("gmv", DecimalType(28, 2)),
            StructField("order_cnt", LongType()),
            StructField("batch_id", LongType()),
        ]
    ),
    TOTALS: StructType(
        [
            StructField("gmv", DecimalType(28, 2)),
            StructField("orders", LongType()),
            StructField("batch_id", LongType()),
        ]
    ),
    USERS: StructType(
        [
            StructField("dt", DateType()),
            StructField("user_id", LongType()),
            StructField("batch_id", LongType()),
        ]
    ),
}


SCHEMAS[DAYS] = StructType(
    [
        StructField("dt", DateType()),
        StructField("gmv", DecimalType(28, 2)),
        StructField("orders", LongType()),
        StructField("batch_id", LongType()),
    ]
)
SCHEMAS[CLOSED] = SCHEMAS[WINDOWS]
KINDS = (*SCHEMAS, SEEN, LATE)

# What a folded day holds, where it differs from a delta.
FOLDED = {
    USERS: StructType(
        [
            StructField("dt", DateType()),
            StructField("bucket", LongType()),
            StructField("bits", BinaryType()),
            StructField("places", ArrayType(IntegerType())),
            StructField("n", LongType()),
        ]
    )
}


class LedgerMismatch(RuntimeError):
    """Checkpoint and ledger do not belong together."""


@dataclass(frozen=True)
class Version:
    """One state of a kind's folded days: the last batch they hold and each day's folder."""

    upto: int
    days: dict[str, str]

    def text(self) -> str:
        return json.dumps({"upto": self.upto, "days": self.days}, sort_keys=True)

    @classmethod
    def of(cls, text: str | None) -> Version | None:
        try:
            held = json.loads(text or "")
            return cls(int(held["upto"]), dict(held["days"]))
        except (ValueError, KeyError, TypeError):
            return None  # cut short or empty


@dataclass
class Ledger:
    root: str
    offset_hours: int = 0
    # Fold new deltas into a version every N batches (0 = never); reads then
    # touch one folder a day plus at most 2 N delta folders.
    compact_every: int = 0
    # WINDOWS: update-mode rows of a stateful window query (newest batch wins).
    # WINDOW_SUMS: per-batch partial sums of a stateless window aggregate
    # (summed on read); used when one query feeds all three ledgers.
    windows_kind: str = WINDOWS
    window_length: str = WINDOW_LENGTH
    window_slide: str = WINDOW_SLIDE
    generations: dict[str, str] = field(default_factory=dict)

    # -- generations -----------------------------------------------------------
    def folder(self, kind: str) -> str:
        return f"{self.root.rstrip('/')}/{kind}/{self.generations.get(kind, UNBOUND)}"

    def path(self, kind: str, batch_id: int | None = None) -> str:
        base = f"{self.folder(kind)}/deltas"
        return base if batch_id is None else f"{base}/batch_id={batch_id}"

    def _opened(self, spark: SparkSession, kind: str) -> list[str]:
        names = published(spark, f"{self.root.rstrip('/')}/{kind}/generations")
        return [name.split("-", 1)[1] for name in names]

    def open(self, spark: SparkSession) -> Ledger:
        """Point a reader at the newest generation of every kind."""
        for kind in KINDS:
            opened = self._opened(spark, kind)
            if opened:
                self.generations[kind] = opened[-1]
        return self

    def bind(self, spark: SparkSession, kinds: list[str], checkpoint: str) -> None:
        """Tie ``kinds`` to the query whose checkpoint lies at ``checkpoint``.

        A checkpoint without mark is fresh and opens a new generation, which starts
        empty; older generations stay on disk until ``forget_older``.
        """
        own = read_text(spark, f"{checkpoint}/{GENERATION_MARK}")
        if own is None:
            if published(spark, f"{checkpoint}/commits"):
                raise LedgerMismatch(f"checkpoint {checkpoint} has run, but not into this ledger")
            own = uuid.uuid4().hex[:12]
            for kind in kinds:
                number = len(self._opened(spark, kind))
                publish(spark, f"{self.root.rstrip('/')}/{kind}/generations/{number:06d}-{own}", own)
            publish(spark, f"{checkpoint}/{GENERATION_MARK}", own)
        for kind in kinds:
            opened = self._opened(spark, kind)
            if opened[-1:] != [own]:
                raise LedgerMismatch(
                    f"checkpoint {checkpoint} wrote generation {own} of {kind}; the ledger is at {opened[-1:]}"
                )
            self.generations[kind] = own

    def forget_older(self, spark: SparkSession) -> None:
        """Remove the rows of all generations but the newest."""
        for kind in KINDS:
            for own in self._opened(spark, kind)[:-1]:
                remove(spark, f"{self.root.rstrip('/')}/{kind}/{own}")

    # -- sinks (foreachBatch callbacks) --------------------------------------
    def _write(self, df: DataFrame, kind: str, batch_id: int) -> None:
        spark = df.sparkSession
        if self.compact_every:
            version = self.version(spark, kind)
            if version is not None and batch_id <= version.upto:
                raise LedgerMismatch(f"batch {batch_id} of {kind} has been folded and cannot run again")
        df.write.mode("overwrite").parquet(self.path(kind, batch_id))
        if self.compact_every and batch_id > 0 and batch_id % self.compact_every == 0:
            self.compact(spark, kind, batch_id)

    def write_windows(self, batch_df: DataFrame, batch_id: int) -> None:
        """Update-mode window rows of this batch; windows with null GMV are not published."""
        rows = batch_df.select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("window.end").cast("timestamp_ntz").alias("window_end"),
            "category",
            F.col("gmv_dec").cast("double").alias("gmv"),
            "order_cnt",
        ).filter(F.col("gmv").isNotNull())
        self._write(rows, WINDOWS, batch_id)

    def write_window_sums(self, batch_df: DataFrame, batch_id: int) -> None:
        """Window partial sums of this batch's (deduplicated, enriched) orders."""
        sums = window_aggregate(batch_df, self.window_length, self.window_slide).select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("window.end").cast("timestamp_ntz").alias("window_end"),
            "category",
            F.col("gmv_dec").cast(DecimalType(28, 2)).alias("gmv"),
            "order_cnt",
        )
        self._write(sums, WINDOW_SUMS, batch_id)

    def write_closed(self, batch_df: DataFrame, batch_id: int) -> None:
        """Windows that an append-mode query emits, each once, when the watermark has passed them.

        A row is final: it is never replaced by a later batch, only by its own batch run again.
        """
        rows = batch_df.select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("window.end").cast("timestamp_ntz").alias("window_end"),
            "category",
            F.col("gmv_dec").cast("double").alias("gmv"),
            "order_cnt",
        ).filter(F.col("gmv").isNotNull())
        self._write(rows, CLOSED, batch_id)

    def write_all(self, batch_df: DataFrame, batch_id: int) -> None:
        """One callback for all ledgers: the batch is computed once, read once for each.

        The batch is cached first (one job), then the ledger writes run as
        concurrent jobs over the cached rows.
        """
        batch_df.persist()
        try:
            batch_df.count()
            writers = (self.write_window_sums, self.write_totals, self.write_days, self.write_users)
            with ThreadPoolExecutor(max_workers=len(writers)) as pool:
                for done in [pool.submit(w, batch_df, batch_id) for w in writers]:
                    done.result()
        finally:
            batch_df.unpersist()

    def write_totals(self, batch_df: DataFrame, batch_id: int) -> None:
        """One delta row for the batch (sum and count run on the executors)."""
        delta = batch_df.agg(
            F.sum("amount").cast(DecimalType(28, 2)).alias("gmv"),
            F.count("order_id").alias("orders"),
        )
        self._write(delta, TOTALS, batch_id)

    def write_days(self, batch_df: DataFrame, batch_id: int) -> None:
        """Totals of the batch by business day."""
        days = batch_df.groupBy(business_date(offset_hours=self.offset_hours).alias("dt")).agg(
            F.sum("amount").cast(DecimalType(28, 2)).alias("gmv"), F.count("order_id").alias("orders")
        )
        self._write(days, DAYS, batch_id)

    def write_running(self, batch_df: DataFrame, batch_id: int) -> None:
        """The running totals and those by day, of a query that feeds nothing else.

        The batch is kept for both: run twice, its late rows would be counted twice.
        """
        batch_df.persist()
        try:
            self.write_totals(batch_df, batch_id)
            self.write_days(batch_df, batch_id)
        finally:
            batch_df.unpersist()

    def write_users(self, batch_df: DataFrame, batch_id: int) -> None:
        """Distinct (day, user) pairs of the batch; null users are not active users."""
        users = (
            batch_df.filter(F.col("user_id").isNotNull())
            .select(
                business_date(offset_hours=self.offset_hours).alias("dt"), "user_id"
            )
            .distinct()
        )
        self._write(users, USERS, batch_id)

    # -- reads -----------------------------------------------------------------
    def _load(self, spark: SparkSession, path: str, schema: StructType) -> DataFrame:
        try:
            return spark.read.schema(schema).option("basePath", path).parquet(path)
        except Exception as exc:  # nothing written yet
            if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
                raise
            return spark.createDataFrame([], schema)

    # A version that holds the batches < N is published when batch N has been written.
    # Batch N itself is not folded: it may run again, and then replaces its own delta.
    def version(self, spark: SparkSession, kind: str) -> Version | None:
        """The newest version whose manifest is whole."""
        folder = f"{self.folder(kind)}/versions"
        for name in reversed(published(spark, folder)):
            found = Version.of(read_text(spark, f"{folder}/{name}"))
            if found is not None:
                return found
        return None

    def latest_snapshot(self, spark: SparkSession, kind: str) -> int | None:
        """Greatest batch id that the current version holds."""
        version = self.version(spark, kind)
        return None if version is None else version.upto

    def read(self, spark: SparkSession, kind: str) -> DataFrame:
        """All per-batch deltas of ``kind`` that are still there (batch_id is the partition column)."""
        return self._load(spark, self.path(kind), SCHEMAS[kind])

    def _day(self, kind: str):
        if kind == TOTALS:
            return F.lit(ALL_DAYS)
        start = F.col("dt") if kind in (USERS, DAYS) else F.to_date("window_start")
        return F.coalesce(F.date_format(start, "yyyy-MM-dd"), F.lit(NO_DAY))

    def _folders(self, spark: SparkSession, kind: str, version: Version | None, days=None) -> DataFrame:
        """The folded rows of a version, of some days or of all."""
        schema = FOLDED.get(kind, SCHEMAS[kind])
        named = {} if version is None else version.days
        paths = [f"{self.folder(kind)}/days/{at}" for day, at in sorted(named.items()) if days is None or day in days]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def _parts(self, spark: SparkSession, kind: str, days=None) -> tuple[DataFrame, DataFrame]:
        """(folded rows, deltas after them), of some days or of all."""
        version = self.version(spark, kind)
        deltas = self.read(spark, kind)
        if version is not None:
            deltas = deltas.filter(F.col("batch_id") > version.upto)
        if days is not None:
            deltas = deltas.filter(self._day(kind).isin(list(days)))
        return self._folders(spark, kind, version, days), deltas

    def _fold(self, kind: str, folded: DataFrame, deltas: DataFrame, upto: int) -> DataFrame:
        if kind == USERS:
            return user_sets(deltas.select("dt", "user_id"), folded)
        rows = folded.unionByName(deltas)
        if kind == WINDOWS:
            return self._newest_windows(rows)
        if kind == WINDOW_SUMS:
            return self._summed_windows(rows)
        if kind == CLOSED:
            return rows
        if kind == DAYS:
            return self._summed_days(rows)
        return rows.agg(
            F.coalesce(F.sum("gmv"), F.lit(0)).cast(DecimalType(28, 2)).alias("gmv"),
            F.coalesce(F.sum(F.when(F.col("gmv").isNotNull(), F.col("orders"))), F.lit(0))
            .cast("bigint")
            .alias("orders"),
        ).withColumn("batch_id", F.lit(upto).cast("bigint"))

    def compact(self, spark: SparkSession, kind: str, batch_id: int) -> None:
        """Fold every batch before ``batch_id`` into the days it touches; then clear away.

        What only the version before the last one named is removed, so readers of the
        former version find its folders and deltas until the next compaction.
        """
        upto, older = batch_id - 1, self.version(spark, kind)
        if older is not None and older.upto >= upto:
            return  # this batch is replayed: its version is complete
        deltas = self.read(spark, kind).filter(F.col("batch_id") <= upto)
        if older is not None:
            deltas = deltas.filter(F.col("batch_id") > older.upto)
        touched = [r["day"] for r in deltas.select(self._day(kind).alias("day")).distinct().collect()]
        before = {} if older is None else older.days
        days = dict(before)
        if touched:
            folded = self._fold(kind, self._folders(spark, kind, older, touched), deltas, upto)
            fresh = uuid.uuid4().hex[:12]
            at = f"{self.folder(kind)}/days/{fresh}"
            folded.withColumn("day", self._day(kind)).write.partitionBy("day").parquet(at)
            days.update({n.split("=", 1)[1]: f"{fresh}/{n}" for n in children(spark, at) if n.startswith("day=")})
        versions = f"{self.folder(kind)}/versions"
        name = f"{upto:020d}-{uuid.uuid4().hex[:12]}"
        publish(spark, f"{versions}/{name}", Version(upto, days).text())
        self._clear(spark, kind, name, older, set(days.values()) | set(before.values()))

    def _clear(self, spark: SparkSession, kind: str, newest: str, older: Version | None, used: set[str]) -> None:
        """Remove what neither the newest version nor the one before it needs."""
        versions = f"{self.folder(kind)}/versions"
        kept, found = [newest], [n for n in published(spark, versions) if n != newest]
        for name in reversed(found):
            if len(kept) < 2 and Version.of(read_text(spark, f"{versions}/{name}")) == older:
                kept.append(name)
            else:
                remove(spark, f"{versions}/{name}")
        folder = f"{self.folder(kind)}/days"
        for fresh in children(spark, folder):
            inside = {f"{fresh}/{n}" for n in children(spark, f"{folder}/{fresh}") if n.startswith("day=")}
            if not inside & used:
                remove(spark, f"{folder}/{fresh}")
            else:
                for path in inside - used:
                    remove(spark, f"{folder}/{path}")
        if older is not None:
            for batch in children(spark, self.path(kind)):
                if batch.startswith("batch_id=") and int(batch.split("=")[1]) <= older.upto:
                    remove(spark, f"{self.path(kind)}/{batch}")

    @staticmethod
    def _newest_windows(rows: DataFrame) -> DataFrame:
        newest = rows.groupBy("window_start", "category").agg(
            F.max_by(F.struct("window_end", "gmv", "order_cnt"), "batch_id").alias("r"),
            F.max("batch_id").alias("batch_id"),
        )
        return newest.select(
            "window_start",
            F.col("r.window_end").alias("window_end"),
            "category",
            F.col("r.gmv").alias("gmv"),
            F.col("r.order_cnt").alias("order_cnt"),
            "batch_id",
        )

    @staticmethod
    def _summed_windows(rows: DataFrame) -> DataFrame:
        return rows.groupBy("window_start", "category").agg(
            F.max("window_end").alias("window_end"),
            F.sum("gmv").cast(DecimalType(28, 2)).alias("gmv"),
            F.sum("order_cnt").cast("bigint").alias("order_cnt"),
            F.max("batch_id").alias("batch_id"),
        ).select("window_start", "window_end", "category", "gmv", "order_cnt", "batch_id")

    @staticmethod
    def _summed_days(rows: DataFrame) -> DataFrame:
        return rows.groupBy("dt").agg(
            F.sum("gmv").cast(DecimalType(28, 2)).alias("gmv"),
            F.sum("orders").cast("bigint").alias("orders"),
            F.max("batch_id").alias("batch_id"),
        )

    def closed_windows(self, spark: SparkSession, days: list[str] | None = None) -> DataFrame:
        """All windows that were closed so far, as they were emitted."""
        folded, deltas = self._parts(spark, CLOSED, days)
        return folded.unionByName(deltas)

    def kpi_trend(self, spark: SparkSession) -> DataFrame:
        """The overview as it stood at the end of each day (``views.kpi_trend``), from the ledgers."""
        folded, deltas = self._parts(spark, DAYS)
        days = self._summed_days(folded.unionByName(deltas)).select("dt", "gmv", "orders")
        sets, users = self._parts(spark, USERS)
        return kpi_snapshots(days, first_seen(user_sets(users.select("dt", "user_id"), sets)))

    def window_rows(self, spark: SparkSession, days: list[str] | None = None) -> DataFrame:
        """State of the window hash: one row per (window_start, category), GMV published.

        ``days`` (``yyyy-MM-dd`` of the window start) reads the folders of those days only.
        """
        folded, deltas = self._parts(spark, self.windows_kind, days)
        rows = folded.unionByName(deltas)
        if self.windows_kind == WINDOW_SUMS:
            summed = self._summed_windows(rows)
            return summed.withColumn("gmv", F.col("gmv").cast("double")).filter(
                F.col("gmv").isNotNull()
            )
        return self._newest_windows(rows)

    def totals(self, spark: SparkSession) -> DataFrame:
        folded, deltas = self._parts(spark, TOTALS)
        rows = folded.unionByName(deltas).filter(F.col("gmv").isNotNull())
        return rows.agg(
            F.coalesce(F.sum("gmv"), F.lit(0)).cast("double").alias("gmv_total"),
            F.coalesce(F.sum("orders"), F.lit(0)).cast("bigint").alias("order_total"),
            F.max("batch_id").alias("batch_id"),
        )

    def active_users(self, spark: SparkSession, by_day: bool = False) -> DataFrame:
        folded, deltas = self._parts(spark, USERS)
        rows = deltas.select("dt", "user_id")
        if by_day:
            return count_users(user_sets(rows, folded), by_day=True)
        never = F.lit(None).cast("date")
        return count_users(user_sets(rows.withColumn("dt", never), folded.withColumn("dt", never)))

    def overview(self, spark: SparkSession) -> DataFrame:
        """Overview from the ledgers (each query's latest batch id is reported)."""
        return self.totals(spark).select(
            "gmv_total",
            "order_total",
            self.active_users(spark).scalar().alias("dau"),
            F.when(F.col("order_total") > 0, F.col("gmv_total") / F.col("order_total"))
            .otherwise(F.lit(0.0))
            .alias("aov"),
            F.col("batch_id").alias("totals_batch_id"),
        )
