"""Nearest neighbours by multiprobe p-stable hashing with exact reranking.

``TABLES`` hash tables of ``PROJECTIONS`` Gaussian projections cut into cells whose width
follows a radius: the distance of the tenth neighbour, measured exactly for a bounded
sample of rows against all rows.  Every row is indexed in every table.  A query does not
only visit its own bucket: the probability that a neighbour at the radius lies in a
neighbouring cell follows from the query's place in its own cell, and buckets are
visited in the order of these probabilities until their sum reaches the share that,
over all tables, finds a neighbour with probability ``SUCCESS``.  Candidates of all tables
are merged and reranked by their exact distance in double precision.

Rows with one vector: only the smallest ids of equal vectors can be among the nearest, so
only those are indexed, and equal queries are searched once.  Repeated rows (same id, same
vector) count once.  A bucket with many rows is
cut into slices that its probes visit all.  A query that finds fewer rows than asked
for is compared with all rows, in blocks.

Vectors that are null, empty, zero, or hold a null or non-finite component take no part,
nor do vectors whose length is not the most common one.  Ties go to the smaller id.
An empty table, or one without queries, gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import mix, partitions, read, stored

NEIGHBOURS = 10
TABLES = 6
PROJECTIONS = 8
CELLS = 3  # cells of a projection that are considered, the likeliest ones
WIDTH = 2.3  # cell width in radii
SUCCESS = 0.975
SAMPLE = 256  # rows whose neighbours are measured exactly for the radius
RADIUS_SHARE = 0.9  # quantile of the sample's distances
SLICE_ROWS = 4096
SEED = 11

ROWS = "table int, bucket long, slice int, role int, id long, vec array<float>"
_ROWS_ARROW = pa.schema(
    [
        ("table", pa.int32()),
        ("bucket", pa.int64()),
        ("slice", pa.int32()),
        ("role", pa.int32()),
        ("id", pa.int64()),
        ("vec", pa.list_(pa.float32())),
    ]
)
FOUND = "query_id long, vec_id long, distance double"


@dataclass
class Tables:
    """Projections, offsets and cell width of all tables."""

    projections: np.ndarray  # tables x dimension x PROJECTIONS
    offsets: np.ndarray  # tables x PROJECTIONS
    width: float
    radius: float

    @classmethod
    def of(cls, dimension: int, radius: float) -> Tables:
        rng = np.random.default_rng(SEED)
        width = WIDTH * radius
        return cls(
            rng.normal(size=(TABLES, dimension, PROJECTIONS)),
            rng.uniform(0, 1, size=(TABLES, PROJECTIONS)),
            width,
            radius,
        )

    def cells(self, vectors: np.ndarray, t: int) -> np.ndarray:
        return vectors @ self.projections[t] / self.width + self.offsets[t]

    def probes(self, place: np.ndarray) -> np.ndarray:
        """Buckets (rows of cell numbers) to visit for one query, likeliest first."""
        home = np.floor(place)
        inside = place - home
        step = np.arange(-(CELLS // 2) - 1, CELLS // 2 + 2)
        spread = self.radius / self.width  # a projected difference is normal with this deviation
        upper, lower = ((step[None, :] + d - inside[:, None]) / spread for d in (1, 0))
        mass = _normal(upper) - _normal(lower)
        best = np.argsort(-mass, axis=1, kind="stable")[:, :CELLS]
        total = np.ones(1)
        chosen = np.zeros((1, 0), dtype=np.int64)
        for j in range(len(place)):
            p = mass[j, best[j]]
            total = (total[:, None] * p[None, :]).ravel()
            cell = (home[j] + step[best[j]]).astype(np.int64)
            chosen = np.hstack([np.repeat(chosen, CELLS, axis=0), np.tile(cell, len(chosen))[:, None]])
        order = np.argsort(-total, kind="stable")
        share = 1.0 - (1.0 - SUCCESS) ** (1.0 / len(self.projections))
        visits = int(np.searchsorted(np.cumsum(total[order]), share)) + 1
        return chosen[order[:visits]]


def _normal(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.vectorize(math.erf)(x / math.sqrt(2.0)))


def bucket_keys(cells: np.ndarray) -> np.ndarray:
    key = np.zeros(len(cells), dtype=np.uint64)
    for j in range(cells.shape[1]):
        key = mix(key * np.uint64(31) + cells[:, j].astype(np.int64).view(np.uint64))
    return key.view(np.int64)


def _vectors(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), dtype=np.float32)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _rows(table: int, bucket, role: int, ids, vectors: pa.Array) -> pa.RecordBatch:
    n = len(ids)
    same = lambda v: pa.array(np.full(n, v, np.int32))
    return pa.RecordBatch.from_arrays(
        [same(table), pa.array(bucket, pa.int64()), same(0), same(role), ids, vectors],
        schema=_ROWS_ARROW,
    )


def _index_map(tables: Tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _vectors(batch.column("vec")).astype(np.float64)
                for t in range(len(tables.projections)):
                    key = bucket_keys(np.floor(tables.cells(x, t)))
                    yield _rows(t, key, 0, batch.column("id"), batch.column("vec"))

    return run


def _probe_map(tables: Tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch.column("vec")).astype(np.float64)
            for t in range(len(tables.projections) if len(x) else 0):
                place = tables.cells(x, t)
                for a in range(0, len(x), 64):
                    visits = [tables.probes(p) for p in place[a : a + 64]]
                    at = np.repeat(np.arange(a, a + len(visits)), [len(v) for v in visits])
                    yield _rows(
                        t,
                        bucket_keys(np.concatenate(visits)),
                        1,
                        batch.column("id").take(pa.array(at)),
                        batch.column("vec").take(pa.array(at)),
                    )

    return run


class Nearest:
    """The nearest rows found so far of each query of a task, bounded by periodic reduction."""

    LIMIT = 400_000

    def __init__(self, keep: int):
        self.keep, self.held, self.size = keep, [], 0

    def add(self, query: np.ndarray, vec: np.ndarray, distance: np.ndarray) -> None:
        self.held.append((query, vec, distance))
        self.size += len(query)

    def full(self) -> bool:
        return self.size > self.LIMIT

    def take(self) -> pa.RecordBatch:
        """All queries' nearest rows; starts anew."""
        query, vec, distance = (
            np.concatenate(x) if self.held else np.zeros(0) for x in (zip(*self.held) if self.held else [()] * 3)
        )
        self.held, self.size = [], 0
        if len(query):
            order = np.lexsort((vec, distance, query))
            query, vec, distance = query[order], vec[order], distance[order]
            # the same row found in several buckets has the same distance: neighbours here
            fresh = np.append(True, (query[1:] != query[:-1]) | (vec[1:] != vec[:-1]))
            query, vec, distance = query[fresh], vec[fresh], distance[fresh]
            first = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
            rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
            good = rank < self.keep
            query, vec, distance = query[good], vec[good], distance[good]
        return pa.RecordBatch.from_arrays(
            [pa.array(query, pa.int64()), pa.array(vec, pa.int64()), pa.array(distance, pa.float64())],
            names=["query_id", "vec_id", "distance"],
        )


def nearest_rows(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, keep: int):
    """(query position, id, exact distance) of the ``keep`` nearest ``rows`` of each query."""
    q, x = queries.astype(np.float64), rows.astype(np.float64)
    rough = (q * q).sum(1)[:, None] + (x * x).sum(1)[None, :] - 2.0 * (q @ x.T)
    if len(x) > keep:
        last = np.partition(rough, keep - 1, axis=1)[:, keep - 1]
        slack = 1e-9 * ((q * q).sum(1) + (x * x).sum(1).max())
        at, of = np.nonzero(rough <= (last + slack)[:, None])
    else:
        at, of = (v.ravel() for v in np.indices(rough.shape))
    exact = np.sqrt(((q[at] - x[of]) ** 2).sum(axis=1))
    return at, ids[of], exact


def _search_map(keep: int):
    """Rows sorted by bucket, indexed rows before probes: one bucket's rows are held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Nearest(keep)
        key, ids, rows = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            part = [batch.column(c).to_numpy() for c in ("table", "bucket", "slice", "role")]
            fresh = np.zeros(batch.num_rows, dtype=bool)
            fresh[0] = True
            for column in part:
                fresh[1:] |= column[1:] != column[:-1]
            cuts = np.flatnonzero(fresh)
            number = batch.column("id").to_numpy()
            x = _vectors(batch.column("vec"))
            for a, b in zip(cuts, np.append(cuts[1:], batch.num_rows)):
                here = tuple(int(c[a]) for c in part[:3])
                if here != key:
                    key, ids, rows = here, [], []
                if part[3][a] == 0:
                    ids.append(number[a:b])
                    rows.append(x[a:b])
                elif ids:
                    if len(ids) > 1:
                        ids, rows = [np.concatenate(ids)], [np.concatenate(rows)]
                    for c in range(a, b, 512):
                        d = min(b, c + 512)
                        at, found, distance = nearest_rows(x[c:d], rows[0], ids[0], keep)
                        best.add(number[c:d][at], found, distance)
                        if best.full():
                            yield best.take()
        yield best.take()

    return run


def search(indexed: DataFrame, probes: DataFrame, keep: int) -> DataFrame:
    """Nearest rows of each probe within its buckets (query_id, vec_id, distance), best per task."""
    n = partitions(indexed.sparkSession)
    key = ["table", "bucket", "slice"]
    return (
        indexed.unionByName(probes)
        .repartition(n, *key)
        .sortWithinPartitions(*key, "role", "id")
        .mapInArrow(_search_map(keep), FOUND)
    )


def best_of(found: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` nearest distinct rows of each query over all tasks and tables."""
    order = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return (
        found.dropDuplicates(["query_id", "vec_id"])
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= keep)
    )


def all_blocks(rows: DataFrame, queries: DataFrame, n_rows: int, keep: int) -> DataFrame:
    """Exact search of ``queries`` against all ``rows`` in blocks of about ``SLICE_ROWS``."""
    blocks = max(1, -(-n_rows // SLICE_ROWS))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    form = lambda df, slice_, role: df.select(
        F.lit(-1).alias("table"), F.lit(0).cast("long").alias("bucket"), slice_.alias("slice"),
        F.lit(role).alias("role"), "id", "vec",
    )
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    return search(form(rows, block, 0), form(queries, everywhere, 1), keep)


def usable(table: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, vec) of the vectors that take part."""
    rows = table.select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("vec"))
    rows = rows.filter(
        "id is not null and vec is not null and size(vec) > 0 "
        "and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) "
        "and exists(vec, x -> x <> 0)"
    )
    sizes = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), "d").limit(1).collect()
    return rows.filter(F.size("vec") == (common[0]["d"] if common else 0))


def sliced(rows: DataFrame, crowded: DataFrame, role: int) -> DataFrame:
    """Rows or probes of crowded buckets dealt to (or repeated for) the buckets' slices."""
    joined = rows.drop("slice").join(crowded, ["table", "bucket"], "left")
    slices = F.coalesce("slices", F.lit(1))
    if role == 0:
        number = F.pmod(F.xxhash64("id"), slices).cast("int")
    else:
        number = F.explode(F.sequence(F.lit(0), slices - 1))
    return joined.select("table", "bucket", number.alias("slice"), "role", "id", "vec")


def neighbours(
    table: DataFrame,
    queries: DataFrame,
    id_column: str,
    vector: str,
    k: int = NEIGHBOURS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows of ``table`` found for each query row."""
    spark = table.sparkSession
    keep = k + 1  # a query may find itself
    everything = usable(table, id_column, vector)
    asked = queries.select(F.col(id_column).cast("long").alias("query_id")).distinct()

    # only the smallest ids of equal vectors can be among the nearest
    equal = Window.partitionBy("vec").orderBy("id")
    rows = everything.dropDuplicates(["id", "vec"]).withColumn("r", F.row_number().over(equal)).filter(F.col("r") <= keep)
    rows = stored(spark, rows.select("id", "vec"), "ann-rows")
    n_rows = rows.count()
    # equal queries are searched once, by the smallest of them
    askers = everything.join(asked, everything["id"] == asked["query_id"], "left_semi")
    askers = askers.dropDuplicates(["id", "vec"])
    reps = stored(spark, askers.groupBy("vec").agg(F.min("id").alias("id")).select("id", "vec"), "ann-queries")
    members = askers.join(reps.select(F.col("id").alias("rep"), "vec"), "vec")
    members = stored(spark, members.select("rep", F.col("id").alias("query_id")), "ann-askers")

    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
    measured = best_of(all_blocks(rows, stored(spark, sample, "ann-sample"), n_rows, keep), keep)
    far = measured.groupBy("query_id").agg(F.max("distance").alias("d")).select("d").collect()
    radius = float(np.quantile([r["d"] for r in far], RADIUS_SHARE)) if far else 0.0

    found = None
    if radius > 0:
        first = rows.limit(1).collect()
        tables = Tables.of(len(first[0]["vec"]), radius)
        indexed = stored(spark, rows.mapInArrow(_index_map(tables), ROWS), "ann-index")
        crowded = indexed.groupBy("table", "bucket").agg(
            F.ceil(F.count("*") / SLICE_ROWS).cast("int").alias("slices")
        )
        crowded = stored(spark, crowded.filter("slices > 1"), "ann-crowded")
        probes = reps.repartition(partitions(spark)).mapInArrow(_probe_map(tables), ROWS)
        found = search(sliced(indexed, crowded, 0), sliced(probes, crowded, 1), keep)
        found = stored(spark, best_of(found, keep).drop("rank"), "ann-found")
        enough = found.groupBy("query_id").count().filter(F.col("count") >= min(keep, n_rows))
        short = reps.join(enough, reps["id"] == enough["query_id"], "left_anti")
    else:
        short = reps
    short = stored(spark, short, "ann-short")
    if short.limit(1).count():
        rest = all_blocks(rows, short, n_rows, keep)
        found = best_of(rest if found is None else found.unionByName(rest), keep).drop("rank")
    elif found is None:
        found = spark.createDataFrame([], FOUND)

    order = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return (
        found.withColumnRenamed("query_id", "rep")
        .join(members, "rep")
        .filter("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", F.col("distance").alias("score"))
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: ten nearest rows of every hundredth embedding."""
    table = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours(table, table.filter("vec_id % 100 = 0"), "vec_id", "embedding")
