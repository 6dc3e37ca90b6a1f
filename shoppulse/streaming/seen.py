"""Order ids that a stream has counted, for exact dedup with a bounded state store.

The stream itself only remembers ids for the watermark's span
(``dropDuplicatesWithinWatermark``).  What it lets through is compared here with all ids
of earlier batches:

- each batch writes its new ids to ``deltas/batch_id=N`` (overwritten when it runs again,
  and a batch only looks at batches before it, so a replay gives the same answer);
- every ``fold_every`` batches the deltas become a *run*: ids in ``PARTS`` folders by hash,
  never written again, and a Bloom filter of 32,768 bits for every bucket of about
  ``BUCKET_IDS`` ids.  ``FAN`` runs of one size are merged into one of the next, so an id is
  rewritten once a size and a batch meets few runs;
- a batch tests its ids against the Bloom filters and reads only the folders of a run that
  may hold one of them.

Manifests are those of the ledger: written aside, renamed, the one before it kept.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import children, publish, published, read_text, remove

PARTS = 64  # folders of a run
BUCKET_IDS = 2048  # ids that share a Bloom filter: 16 bits each
BLOOM_BITS = 1 << 15
HASHES = 4
FAN = 8  # runs of one size that are merged
NO_ID = "\u0000"  # stands for a null id, which is an id like any other

IDS = "id string, part int, bucket int"


@dataclass(frozen=True)
class Run:
    """Ids of some batches: where they lie and into how many buckets a folder is cut."""

    name: str
    level: int
    buckets: int
    rows: int


def _part(seen_id: Column) -> Column:
    return F.pmod(F.xxhash64(seen_id), F.lit(PARTS)).cast("int")


def _bucket(seen_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(seen_id, F.lit(1)), F.lit(buckets)).cast("int")


def _places(seen_id: Column) -> list[Column]:
    """The bits of an id in its Bloom filter."""
    mixed = F.xxhash64(seen_id, F.lit(2))
    return [F.shiftright(mixed, 15 * k).bitwiseAND(F.lit(BLOOM_BITS - 1)).cast("int") for k in range(HASHES)]


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.expr("1").bitwiseAND(F.call_function("shiftright", byte, place % 8)) == 1


class SeenIds:
    """All ids below one folder of the shared file system."""

    def __init__(self, folder: str, fold_every: int = 10):
        self.folder, self.fold_every = folder.rstrip("/"), fold_every
        self._held: list[DataFrame] = []

    # -- manifests -------------------------------------------------------------
    def _manifest(self, spark: SparkSession) -> tuple[int, list[Run]]:
        """(last batch held by the runs, the runs)."""
        for name in reversed(published(spark, f"{self.folder}/versions")):
            try:
                held = json.loads(read_text(spark, f"{self.folder}/versions/{name}") or "")
                return int(held["upto"]), [Run(**r) for r in held["runs"]]
            except (ValueError, KeyError, TypeError):
                continue  # cut short: the one before it is still whole
        return -1, []

    def runs(self, spark: SparkSession) -> list[Run]:
        return self._manifest(spark)[1]

    # -- reading -----------------------------------------------------------------
    def _deltas(self, spark: SparkSession, after: int, before: int) -> DataFrame:
        path = f"{self.folder}/deltas"
        names = [n for n in children(spark, path) if n.startswith("batch_id=")]
        wanted = [f"{path}/{n}" for n in names if after < int(n.split("=")[1]) < before]
        reader = spark.read.schema("id string")
        return reader.parquet(*wanted) if wanted else spark.createDataFrame([], "id string")

    def _blooms(self, spark: SparkSession, run: Run) -> DataFrame:
        return spark.read.schema("part int, bucket int, bits binary").parquet(f"{self.folder}/blooms/{run.name}")

    def _ids(self, spark: SparkSession, run: Run, parts: list[int] | None = None) -> DataFrame:
        rows = spark.read.schema(IDS).parquet(f"{self.folder}/runs/{run.name}")
        return rows if parts is None else rows.filter(F.col("part").isin(parts))

    def _suspects(self, spark: SparkSession, ids: DataFrame, run: Run) -> DataFrame:
        """The ids that the run's Bloom filters cannot rule out."""
        seen_id = F.col("id")
        keyed = ids.select("id", _part(seen_id).alias("part"), _bucket(seen_id, run.buckets).alias("bucket"))
        found = keyed.join(self._blooms(spark, run), ["part", "bucket"])
        for place in _places(seen_id):
            found = found.filter(_is_set(F.col("bits"), place))
        return found.select("id", "part")

    def known(self, spark: SparkSession, ids: DataFrame, batch_id: int) -> DataFrame:
        """Those of ``ids`` (id) that a batch before ``batch_id`` has counted."""
        upto, runs = self._manifest(spark)
        out = ids.join(self._deltas(spark, upto, batch_id), "id", "left_semi")
        for run in runs:
            suspects = self._suspects(spark, ids, run).persist()
            self._held.append(suspects)
            parts = [r["part"] for r in suspects.select("part").distinct().collect()]  # at most PARTS
            if parts:
                held = self._ids(spark, run, parts).select("id")
                out = out.unionByName(suspects.select("id").join(held, "id", "left_semi"))
        return out.distinct()

    def new_rows(self, rows: DataFrame, key: str, batch_id: int) -> DataFrame:
        """``rows`` (one a key) without those whose key was counted before."""
        spark = rows.sparkSession
        own = F.coalesce(F.col(key).cast("string"), F.lit(NO_ID))
        known = self.known(spark, rows.select(own.alias("id")), batch_id).withColumnRenamed("id", "_seen")
        return rows.join(known, own == F.col("_seen"), "left_anti")

    def release(self) -> None:
        """Drop what ``known`` keeps in memory for a batch."""
        while self._held:
            self._held.pop().unpersist()

    # -- writing -----------------------------------------------------------------
    def write(self, rows: DataFrame, key: str, batch_id: int) -> None:
        """Keep the keys of a batch; fold what came before it every ``fold_every`` batches."""
        ids = rows.select(F.coalesce(F.col(key).cast("string"), F.lit(NO_ID)).alias("id"))
        ids.write.mode("overwrite").parquet(f"{self.folder}/deltas/batch_id={batch_id}")
        if batch_id and batch_id % self.fold_every == 0:
            self.fold(rows.sparkSession, batch_id)

    def _write_run(self, spark: SparkSession, ids: DataFrame, level: int, rows: int) -> Run:
        run = Run(uuid.uuid4().hex[:12], level, max(1, -(-rows // (PARTS * BUCKET_IDS))), rows)
        seen_id = F.col("id")
        cut = ids.select("id", _part(seen_id).alias("part"), _bucket(seen_id, run.buckets).alias("bucket"))
        # a folder in one file each: ids are hashed, so no folder is larger than the others
        cut.repartition("part").write.partitionBy("part").parquet(f"{self.folder}/runs/{run.name}")
        bits = (
            self._ids(spark, run)
            .select("part", "bucket", F.explode(F.array(*_places(seen_id))).alias("place"))
            .groupBy("part", "bucket")
            .agg(F.bitmap_construct_agg("place").alias("bits"))
        )
        bits.write.parquet(f"{self.folder}/blooms/{run.name}")
        return run

    def fold(self, spark: SparkSession, batch_id: int) -> None:
        """Make a run of the batches before ``batch_id``, merge runs of one size, clear away."""
        upto, runs = self._manifest(spark)
        if upto >= batch_id - 1:
            return
        before = {r.name for r in runs}
        fresh = self._deltas(spark, upto, batch_id)
        rows = fresh.count()
        if rows:
            runs = [*runs, self._write_run(spark, fresh, 0, rows)]
        for level in range(64):
            same = [r for r in runs if r.level == level]
            if len(same) < FAN:
                continue
            ids = self._ids(spark, same[0]).select("id")
            for run in same[1:]:
                ids = ids.unionByName(self._ids(spark, run).select("id"))
            merged = self._write_run(spark, ids, level + 1, sum(r.rows for r in same))
            runs = [*(r for r in runs if r.level != level), merged]
        text = json.dumps({"upto": batch_id - 1, "runs": [asdict(r) for r in runs]})
        name = f"{batch_id - 1:020d}-{uuid.uuid4().hex[:12]}"
        publish(spark, f"{self.folder}/versions/{name}", text)
        used = before | {r.name for r in runs}
        for kind in ("runs", "blooms"):
            for old in children(spark, f"{self.folder}/{kind}"):
                if old not in used:
                    remove(spark, f"{self.folder}/{kind}/{old}")
        for old in published(spark, f"{self.folder}/versions")[:-2]:
            remove(spark, f"{self.folder}/versions/{old}")
        for old in children(spark, f"{self.folder}/deltas"):
            if old.startswith("batch_id=") and int(old.split("=")[1]) <= upto:
                remove(spark, f"{self.folder}/deltas/{old}")
