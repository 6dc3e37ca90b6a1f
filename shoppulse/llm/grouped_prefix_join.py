"""Set-similarity self-join on word shingles with grouped prefixes, as connected classes.

A document's set holds its distinct shingles of ``width`` words as 64-bit hashes.  Two sets
with Jaccard similarity of at least ``percent`` per cent share one of the first
n - ceil(percent * n / 100) + 1 shingles in any common order; rare shingles come first.

1. Equal sets collapse to one class (its smallest doc_id).
2. Classes with the same size and the same prefix collapse to one group.
3. Groups that share a prefix shingle are candidates.  First each group is verified
   against one partner only, the smallest group it shares most prefix shingles with, and
   each member against its group's smallest: one comparison a class.  What links gets
   a common label.
4. Prefix shingles whose groups all have one label need nothing more.  The members of
   the other groups go through the prefix filter once more, in a finer order: a table of
   bounded size (``HitTable``) tells which shingles no other document holds; these come
   first and match nobody, so a document whose whole prefix is made of them is done, and
   of the others only the rest of the prefix leaves the map task.  Pairs with different
   labels that pass the size and position filters are verified.  Pairs inside one label
   are already connected, so no link between labels is lost.
5. Verification first bounds the overlap from compact sketches of both sets, then reads
   the texts of what is left: each hub document's set is held once while its partners
   stream past, with the partners of a busy hub dealt over several tasks.

The result is one row per document with its class; copies are never expanded into
pairs.  Null, empty and wordless texts have an empty set and are alone; a text with
fewer than ``width`` words has one shingle, its whole sequence.  Rows without doc_id
cannot be named in a class and take no part; they come back with 0 shingles and a null
class, as in the SQL; repeated rows (same doc_id)
get a row each, and of several texts of one doc_id the smallest stands for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (
    blocks,
    discard,
    forget,
    mix,
    partitions,
    read,
    shuffle_cleanup,
    span_hashes,
    stored,
    text_buffer,
    window_hashes,
    word_spans,
)
from .components import components

SHINGLE = 3
PERCENT = 90
SKETCH_BITS = 20  # buckets that tell frequent shingles from rare ones
PARTNERS = 256  # partners of one hub that a task verifies

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SKETCH_SHIFT = np.uint64(64 - SKETCH_BITS)


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text."""
    raw, offsets = text_buffer(column)
    for a, b in blocks(offsets):
        part, edges = _LOWER[raw[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a]
        starts, ends, first = word_spans(part, edges)
        words = span_hashes(part, starts, ends)
        runs = window_hashes(words, width, 5)
        for row in range(b - a):
            n = first[row + 1] - first[row]
            if n >= width:
                yield a + row, np.unique(runs[first[row] : first[row + 1] - width + 1])
            elif n:
                whole = mix(window_hashes(words[first[row] : first[row + 1]], int(n), 5) + np.uint64(n))
                yield a + row, whole
            else:
                yield a + row, np.zeros(0, np.uint64)


def prefix_length(n, percent: int):
    """How many first shingles two sets of similarity ``percent`` must share one of."""
    return n - (percent * n + 99) // 100 + 1


# ---- the common order of shingles ----------------------------------------------


def _frequent_map(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in batches:
            for _, found in shingle_sets(batch.column("text"), width):
                np.add.at(counts, (found >> _SKETCH_SHIFT).astype(np.int64), 1)
        often = np.flatnonzero(counts >= 8 + 4 * counts.mean())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(often, -1), pa.int32()),
                pa.array(np.append(counts[often], counts.sum()), pa.int64()),
            ],
            names=["at", "n"],
        )

    return run


def frequency_sketch(docs: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """Rough counts of frequent shingles by hash bucket (a table of fixed size), and of all.

    They only order the shingles, and any order gives the same result.
    """
    sums = docs.select("text").mapInArrow(_frequent_map(width), "at int, n long")
    out, shingles = np.zeros(1 << SKETCH_BITS, dtype=np.float32), 0
    for r in sums.groupBy("at").agg(F.sum("n").alias("n")).collect():
        if r["at"] < 0:
            shingles = r["n"]
        else:
            out[r["at"]] = r["n"]
    return out, shingles


_SETS_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("set_a", pa.int64()),
        ("set_b", pa.int64()),
        ("prefix_sum", pa.int64()),
        ("prefix", pa.list_(pa.int64())),
        ("alone", pa.int64()),
        ("finer", pa.list_(pa.int64())),
        ("sketch", pa.binary()),
    ]
)
SETS = (
    "doc_id long, n long, set_a long, set_b long, prefix_sum long, prefix array<long>, "
    "alone long, finer array<long>, sketch binary"
)


def _signature(values: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over a set (independent of its order)."""
    a = int(mix(values).sum(dtype=np.uint64))
    b = int(mix(values * np.uint64(0x9E3779B97F4A7C15) + np.uint64(77)).sum(dtype=np.uint64))
    return a - (1 << 64) if a >> 63 else a, b - (1 << 64) if b >> 63 else b


def _sets_map(sketch, table, percent: int, width: int):
    """Each document's set: its size, signatures, its prefix in two orders, and a sketch.

    ``prefix`` is in the rough order and ``finer`` begins, after ``alone`` shingles, with those
    that come first in the finer one; both leave out shingles that no other document holds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, hits = sketch.value, table.value
        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            rows = []
            for i, found in shingle_sets(batch.column("text"), width):
                n = len(found)
                prefix, finer, first, alone = np.zeros(0, np.uint64), np.zeros(0, np.uint64), 0, 0
                if n:
                    frequent, kind = often[(found >> _SKETCH_SHIFT).astype(np.int64)], hits.kind(found)
                    most = prefix_length(n, percent)
                    alone = int((kind == 0).sum())
                    rough = np.lexsort((found, frequent))[:most]
                    first = _signature(found[rough])[0]
                    prefix = found[rough[kind[rough] > 0]]
                    if alone < most:
                        finer = found[np.lexsort((found, frequent, kind))[alone:most]]
                lists = (prefix.view(np.int64), alone, finer.view(np.int64))
                rows.append((docs[i], n, *_signature(found), first, *lists, pack_sketch(found)))
                if len(rows) >= 2000:
                    yield _batch(rows, _SETS_ARROW)
                    rows = []
            if rows:
                yield _batch(rows, _SETS_ARROW)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


# ---- verification -----------------------------------------------------------------
#
# A sketch holds the leading bits of a set's hashes, about a byte a shingle.  Equal shingles
# have equal leading bits, so what two sketches have in common is an upper bound of what
# the sets have in common: a pair whose bound is too small needs no texts.


def _sketch_bits(n: int) -> int:
    return max(int(n - 1).bit_length(), 1) + 7


def pack_sketch(found: np.ndarray) -> bytes:
    """Gaps between the sorted leading bits, a byte each (255: 255 and the rest follows)."""
    if len(found) == 0:
        return b""
    lead = (found >> np.uint64(64 - _sketch_bits(len(found)))).astype(np.int64)  # ``found`` is sorted
    return pack_gaps(lead)


def read_sketch(data: bytes) -> np.ndarray:
    gaps = np.frombuffer(data, np.uint8)
    return np.cumsum(gaps, dtype=np.int64)[gaps != 255]


def most_in_common(a: np.ndarray, b: np.ndarray) -> int:
    """Upper bound of the shingles that the sets behind two sketches share."""
    few, many = (a, b) if len(a) <= len(b) else (b, a)
    shift = _sketch_bits(len(many)) - _sketch_bits(len(few))
    many = many >> shift
    values, count = np.unique(many, return_counts=True)
    own, times = np.unique(few, return_counts=True)
    at = np.minimum(np.searchsorted(values, own), max(len(values) - 1, 0))
    if len(values) == 0:
        return 0
    return int(np.minimum(times, np.where(values[at] == own, count[at], 0)).sum())


def _bound_map(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, base = None, np.zeros(0, np.int64)
        for batch in batches:
            hubs, role = batch.column("hub").to_pylist(), batch.column("role").to_pylist()
            docs, data = batch.column("doc_id").to_pylist(), batch.column("sketch").to_pylist()
            likely = []
            for i, packed in enumerate(data):
                found = read_sketch(packed)
                if role[i] == 0:
                    hub, base = hubs[i], found
                elif hub != hubs[i]:
                    raise ValueError(f"hub {hubs[i]} of a pair has no sketch")
                else:
                    both = most_in_common(base, found)
                    if 100 * both >= percent * (len(base) + len(found) - both):
                        likely.append((hub, docs[i]))
            yield _batch(likely, _LINK_ARROW)

    return run


_LINK_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _verify_map(percent: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, base = None, np.zeros(0, np.uint64)
        for batch in batches:
            hubs, role = batch.column("hub").to_pylist(), batch.column("role").to_pylist()
            docs = batch.column("doc_id").to_pylist()
            links = []
            for i, found in shingle_sets(batch.column("text"), width):
                if role[i] == 0:
                    hub, base = hubs[i], found
                    continue
                if hub != hubs[i]:
                    raise ValueError(f"hub {hubs[i]} of a pair has no text")
                both = len(np.intersect1d(base, found, assume_unique=True))
                if 100 * both >= percent * (len(base) + len(found) - both):
                    links.append((hub, docs[i]))
            yield _batch(links, _LINK_ARROW)

    return run


NEEDED_BITS = 24
_MAP_BITS = 1 << 15  # of a bitmap of Spark's bitmap functions


def needed(content: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``content`` whose doc_id is, or by its hash may be, one of ``ids``.

    The ids' hashes become at most 2 ** NEEDED_BITS bits (2 MB) that are broadcast, so that rows
    which nobody asks for stay where they lie instead of being shuffled to a join.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << NEEDED_BITS))
    place = F.pmod(slot, F.lit(_MAP_BITS)).cast("int")
    bucket = F.shiftright(slot, 15).alias("_bucket")
    bitmaps = ids.select(bucket, place.alias("_place")).groupBy("_bucket").agg(
        F.bitmap_construct_agg("_place").alias("_bits")
    )
    byte = F.expr("cast(conv(hex(substring(_bits, _place div 8 + 1, 1)), 16, 10) as int)")
    asked = F.call_function("shiftright", byte, F.expr("cast(_place % 8 as int)")).bitwiseAND(F.lit(1)) == 1
    return (
        content.withColumns({"_bucket": bucket, "_place": place})
        .join(F.broadcast(bitmaps), "_bucket")
        .filter(asked)
        .drop("_bucket", "_place", "_bits")
    )


def _by_hub(pairs: DataFrame, content: DataFrame, column: str) -> DataFrame:
    """Rows (hub, role, doc_id, ``column``), each hub's own row before its partners.

    ``content`` has one row a doc_id.  The partners of a busy hub are dealt over shares
    of about ``PARTNERS``, each of which gets the hub's row.
    """
    n = partitions(pairs.sparkSession)
    busy = pairs.groupBy("hub").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("shares"))
    dealt = pairs.join(busy, "hub").select(
        "hub",
        F.pmod(F.xxhash64("doc_id"), F.col("shares")).cast("int").alias("share"),
        F.lit(1).alias("role"),
        "doc_id",
    )
    hubs = busy.select(
        "hub",
        F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"),
        F.lit(0).alias("role"),
        F.col("hub").alias("doc_id"),
    )
    rows = dealt.unionByName(hubs)
    return (
        rows.join(needed(content.select("doc_id", column), rows), "doc_id")
        .repartition(n, "hub", "share")
        .sortWithinPartitions("hub", "share", "role", "doc_id")
        .select("hub", "role", "doc_id", column)
    )


def verified(
    docs: DataFrame, sketches: DataFrame, pairs: DataFrame, percent: int, width: int
) -> DataFrame:
    """The pairs (hub, doc_id) whose sets are similar enough, as links (a, b)."""
    spark = docs.sparkSession
    bounded = _by_hub(pairs, sketches, "sketch").mapInArrow(_bound_map(percent), "a long, b long")
    likely = stored(spark, bounded, "join-likely")
    exact = _by_hub(likely.toDF("hub", "doc_id"), docs, "text").mapInArrow(
        _verify_map(percent, width), "a long, b long"
    )
    links = stored(spark, exact, "join-links")
    discard(likely)
    return links


# ---- the join -----------------------------------------------------------------------


def _relabelled(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``rows`` (doc_id, ...) with the component of each as ``label`` (itself where alone)."""
    named = parts.select(F.col("id").alias("doc_id"), "component")
    return rows.join(named, "doc_id", "left").withColumn(
        "label", F.coalesce("component", "doc_id")
    ).drop("component")


# ---- how often shingles occur ---------------------------------------------------------
#
# A table of two bits a slot, its size in step with the number of shingles up to
# 2 ** TABLE_BITS slots: 0 tells that a shingle in this slot is in one document only, 1 to 3
# that the slot was hit 2 or 3 times, up to ``OFTEN`` times, or more.  A slot
# that several shingles share only makes them look more frequent.

TABLE_BITS = 27  # 32 MB
SEGMENT_BITS = 16  # slots merged together
OFTEN = 32
HELD_SHINGLES = 1 << 19  # shingles that a task counts before it passes them on

_PART_ARROW = pa.schema([("segment", pa.int32()), ("hits", pa.binary())])


def pack_gaps(sorted_values: np.ndarray) -> bytes:
    """Ascending numbers (repeats allowed) as gaps, a byte each (255: 255 and the rest follows)."""
    gaps = np.diff(sorted_values, prepend=0)
    more, rest = gaps // 255, gaps % 255
    out = np.full(len(gaps) + int(more.sum()), 255, dtype=np.uint8)
    out[np.cumsum(more + 1) - 1] = rest
    return out.tobytes()


def _hits_map(bits: int, width: int):
    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        slot = np.sort(np.concatenate(held) >> np.uint64(64 - bits)).astype(np.int64)
        segment = slot >> SEGMENT_BITS
        cuts = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
        parts = np.split(slot & ((1 << SEGMENT_BITS) - 1), cuts[1:])
        return pa.RecordBatch.from_arrays(
            [pa.array(segment[cuts], pa.int32()), pa.array(map(pack_gaps, parts), pa.binary())],
            schema=_PART_ARROW,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, found in shingle_sets(batch.column("text"), width):
                if len(found):
                    held.append(found)
                    size += len(found)
                if size >= HELD_SHINGLES:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    return run


def _merge_hits(table: pa.Table) -> pa.Table:
    total = np.zeros(1 << SEGMENT_BITS, dtype=np.int64)
    for hits in table.column("hits").to_pylist():
        total += np.bincount(read_sketch(hits), minlength=len(total))
    kind = (total > 1).astype(np.uint8) + (total > 3) + (total > OFTEN)
    packed = (kind.reshape(-1, 4) << np.arange(0, 8, 2, dtype=np.uint8)).sum(axis=1, dtype=np.uint8)
    return pa.table({"segment": table.column("segment")[:1], "kinds": pa.array([packed.tobytes()], pa.binary())})


class HitTable:
    """Two bits for every slot."""

    def __init__(self, bits: int):
        self.bits = bits
        self.kinds = np.zeros(1 << (bits - 2), dtype=np.uint8)

    def kind(self, found: np.ndarray) -> np.ndarray:
        slot = (found >> np.uint64(64 - self.bits)).astype(np.int64)
        return (self.kinds[slot >> 2] >> (2 * (slot & 3)).astype(np.uint8)) & 3


def hit_table(docs: DataFrame, shingles: int, width: int, most: int = TABLE_BITS) -> HitTable:
    """The merged table of all documents."""
    table = HitTable(min(most, max(SEGMENT_BITS, int(shingles).bit_length())))
    rows = docs.select("text").mapInArrow(_hits_map(table.bits, width), "segment int, hits binary")
    size = 1 << (SEGMENT_BITS - 2)
    with shuffle_cleanup(docs.sparkSession):
        for row in rows.groupBy("segment").applyInArrow(_merge_hits, "segment int, kinds binary").collect():
            at = row["segment"] * size  # 2 ** bits / 4 bytes in all
            table.kinds[at : at + size] = np.frombuffer(row["kinds"], np.uint8)
    return table


def _finer_pairs(sets: DataFrame, left: DataFrame, percent: int) -> DataFrame:
    """Pairs (hub, doc_id) of ``left`` (doc_id, label) with different labels that may be similar.

    The prefix filter once more, with shingles that no other document holds first: a copy
    that differs in more shingles than its prefix holds shares nothing and meets nobody.
    """
    spark = sets.sparkSession
    rest = sets.filter("size(finer) > 0").select("doc_id", "n", "alone", "finer")
    entries = rest.join(left.select("doc_id", "label"), "doc_id").select(
        "doc_id", "n", "label", "alone", F.posexplode("finer").alias("at", "token")
    )
    entries = entries.select("doc_id", "n", "label", "token", (F.col("alone") + F.col("at")).alias("pos"))
    entries = stored(spark, entries, "join-entries")
    shared = entries.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    shared = shared.filter("low <> high").select("token")
    open_ = stored(spark, entries.join(shared, "token"), "join-open-entries")
    discard(entries)
    side = lambda x: open_.select("token", *(F.col(c).alias(f"{c}_{x}") for c in ("doc_id", "n", "label", "pos")))
    need = f"ceil({percent} * (n_a + n_b) / {100 + percent})"
    pairs = (
        side("a")
        .join(side("b"), "token")
        .filter("label_a <> label_b and (n_a < n_b or (n_a = n_b and doc_id_a < doc_id_b))")
        .filter(f"100 * n_a >= {percent} * n_b")
        .filter(f"least(n_a - pos_a, n_b - pos_b) >= {need}")  # pos counts from 0
        .select(F.least("doc_id_a", "doc_id_b").alias("hub"), F.greatest("doc_id_a", "doc_id_b").alias("doc_id"))
        .distinct()
    )
    pairs = stored(spark, pairs, "join-pairs")
    discard(open_)
    return pairs


def similar_classes(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    unnamed = docs.filter("doc_id is null").select("doc_id")
    docs = docs.select("doc_id", "text").filter("doc_id is not null")
    named = docs.select("doc_id")
    repeated = bool(named.groupBy("doc_id").count().filter("count > 1").limit(1).count())
    if repeated:
        docs = stored(spark, docs.groupBy("doc_id").agg(F.min("text").alias("text")), "join-docs")
    frequent, shingles = frequency_sketch(docs, width)  # a table of fixed size
    often = spark.sparkContext.broadcast(frequent)
    table = spark.sparkContext.broadcast(hit_table(docs, shingles, width))  # at most 2 ** TABLE_BITS / 4 bytes
    sets = stored(spark, docs.mapInArrow(_sets_map(often, table, percent, width), SETS), "join-sets")
    often.unpersist()
    table.unpersist()

    # 1. equal sets
    same = ["n", "set_a", "set_b"]
    narrow = sets.select("doc_id", "prefix_sum", *same)
    copies = narrow.filter("n > 0").groupBy(*same).agg(F.min("doc_id").alias("class_id"), F.count("*").alias("c"))
    copies = stored(spark, copies.filter("c > 1").drop("c"), "join-copies")
    member = narrow.join(copies, same, "left")
    member = member.select("doc_id", "n", "prefix_sum", F.coalesce("class_id", "doc_id").alias("class_id"))
    member = stored(spark, member, "join-member")
    discard(copies)

    # 2. equal sizes and prefixes
    alike = ["n", "prefix_sum"]
    classes = member.filter("n > 0 and doc_id = class_id").select("doc_id", *alike)
    group = classes.groupBy(*alike).agg(F.min("doc_id").alias("group_id"), F.count("*").alias("c"))
    group = stored(spark, group.filter("c > 1").drop("c"), "join-groups")
    grouped = classes.join(group, alike, "left").withColumn("group_id", F.coalesce("group_id", "doc_id"))
    inside = stored(spark, grouped.select("doc_id", "n", "group_id"), "join-inside")

    # 3. prefix shingles that several groups share, and one partner for each group
    firsts = inside.filter("doc_id = group_id").select("doc_id", "group_id", "n")
    held = sets.filter("size(prefix) > 0").select("doc_id", "prefix").join(firsts, "doc_id")
    entries = stored(spark, held.select("group_id", "n", F.explode("prefix").alias("token")), "join-prefixes")
    shared = entries.groupBy("token").agg(F.min("group_id").alias("first"), F.max("group_id").alias("last"))
    shared = shared.filter("first <> last").select("token", "first")
    tokens = stored(spark, entries.join(shared, "token"), "join-tokens")
    discard(entries)
    first_n = inside.select(F.col("doc_id").alias("first"), F.col("n").alias("first_n"))
    fits = f"100 * least(n, first_n) >= {percent} * greatest(n, first_n)"
    partner = (
        tokens.filter("group_id <> first")
        .groupBy("group_id", "n", "first")
        .agg(F.count("*").alias("both"))
        .join(first_n, "first")
        .filter(fits)
        .groupBy("group_id")
        .agg(F.max_by("first", F.struct("both", -F.col("first"))).alias("hub"))
        .select("hub", F.col("group_id").alias("doc_id"))
    )
    own = inside.filter("doc_id <> group_id").select(F.col("group_id").alias("hub"), "doc_id")
    tried = stored(spark, partner.unionByName(own), "join-tried")
    links = verified(docs, sets, tried, percent, width)
    parts = stored(spark, components(links), "join-parts")

    # 4. what is left: groups that share a prefix shingle but not a label
    labels = stored(spark, _relabelled(inside, parts), "join-labels")
    of_group = labels.groupBy("group_id").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_ = tokens.select("token", "group_id").join(of_group, "group_id")
    open_ = stored(spark, open_, "join-open")
    discard(tokens, parts)
    mixed = open_.groupBy("token").agg(F.min("low").alias("l"), F.max("high").alias("h"))
    mixed = mixed.filter("l <> h").select("token")
    left = open_.join(mixed, "token").select("group_id").distinct()
    split = of_group.filter("low <> high").select("group_id")
    left = labels.join(left.unionByName(split).distinct(), "group_id", "left_semi")
    left = stored(spark, left.select("doc_id", "label"), "join-left")
    discard(open_, inside)
    pairs = _finer_pairs(sets, left, percent)
    rest = stored(spark, pairs.join(tried, ["hub", "doc_id"], "left_anti"), "join-rest")
    discard(pairs)
    more = verified(docs, sets, rest, percent, width)
    discard(sets, group, rest, tried, left, links)

    # 5. labels joined by the remaining links, and back to the documents
    name = lambda end: labels.select(F.col("doc_id").alias(end), F.col("label").alias(f"l{end}"))
    bridges = more.join(name("a"), "a").join(name("b"), "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    top = components(bridges).select(F.col("id").alias("label"), "component")
    final = labels.select("doc_id", "label").join(top, "label", "left")
    final = final.select(F.col("doc_id").alias("class_id"), F.coalesce("component", "label").alias("component_id"))
    final = stored(spark, final, "join-final")
    discard(labels, more)
    out = member.join(final, "class_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
    if repeated:
        out = named.join(out, "doc_id")
    return out.unionByName(
        unnamed.select(
            "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")
        )
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each class (its smallest doc_id); rows without doc_id stay."""
    first = similar_classes(docs, percent, width).filter("doc_id = component_id").select("doc_id")
    kept = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.union(docs.filter("doc_id is null"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: classes of documents linked by 3-word shingle similarity of 0.9 or more."""
    return similar_classes(read(spark, sf_dir, "documents"), PERCENT)


SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {SHINGLE - 2})) AS i FROM d WHERE len(w) >= {SHINGLE}) x
  UNION ALL
  SELECT doc_id, array_to_string(w, ' ') AS g FROM d WHERE len(w) BETWEEN 1 AND {SHINGLE - 1}
), n AS (
  SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id
), link AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id) p
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * shared >= {PERCENT} * (na.c + nb.c - shared)
), reach(doc_id, other) AS (
  SELECT a, b FROM link
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other
), low AS (
  SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(c, 0) AS BIGINT) AS n_shingles,
       CAST(least(d.doc_id, coalesce(other, d.doc_id)) AS BIGINT) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN low ON low.doc_id = d.doc_id
"""
