"""Prefix trie of conversations, held as balanced parentheses, one shard at a time.

A conversation is a path of turns; a node is a distinct sequence of first turns.  A turn is
an element of 20 bytes: 16 of the SHA-256 of role and text, and the text's code points.

1. Turns shuffle as elements, never as texts, by the block of 100 conversations that may
   share first turns, and become one path a conversation (``rebuilt_paths``).
2. Equal paths are gathered with their conv_ids in runs of at most ``SPAN`` numbers, so a
   path that a third of all conversations take is never one group.
3. Paths are range-partitioned in order and cut into shards of about ``SHARD_ELEMENTS``
   elements.  A shard writes its nodes as balanced parentheses; blocks of the excess with a
   tree of their least values find the closing one of each node (``find_close``), which
   delimits its subtree; rank over the pairs ``()`` counts leaves, and cumulative
   arrays give members and savings.
4. Nodes on a shard's first or last path, its spines, may go on in the neighbouring shards.
   All their figures are sums: each shard counts as if it were alone, and where two
   neighbours share the first k turns, correction rows take back what both counted
   (``_corrections``).  Spines merge by one aggregate; every other node is final.
5. Digests of member lists are streamed in order, a path at a time.  A SHA-256 is
   sequential by nature, so the ids of one path, not its turns or texts, pass one task.

Turns go by turn (null first), then role, then the digest; null role or text is empty.
Repeated rows are turns of their own.  Rows without conv_id take no part.  Empty texts
are turns of no code points.  A conversation's elements (20 bytes a turn) are held at
once, its texts never.  An empty table has no node.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, partitions, read, stored

BLOCK_OF = 100  # conversations c with the same c - c % 100 may share first turns
MOST_SHARED = 6  # a conversation takes crc32(c) % 6 first turns of its block's head
SPAN = 1024  # conv_ids gathered into one row
SHARD_ELEMENTS = 1 << 19
BLOCK = 64  # parentheses whose least excess is kept
ELEMENT = np.dtype([("a", "<u8"), ("b", "<u8"), ("size", ">u4")])
WIDE = ELEMENT.itemsize
NOBODY = np.iinfo(np.int64).max


# ---- paths --------------------------------------------------------------------------


def element(role: Column, text: Column) -> Column:
    """A turn as 20 bytes (equal turns, equal bytes)."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    size = F.lpad(F.hex(F.char_length(text)), 8, "0")
    return F.unhex(F.concat(F.substring(F.sha2(whole, 256), 1, 32), size))


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """conv_id and path (elements) of every conversation, first turns taken from its block's head."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = (
        conversations.filter("conv_id is not null")
        .select(
            F.col("conv_id").cast("long"),
            F.struct("turn", role.alias("role"), element(role, text).alias("element")).alias("turn"),
        )
        .withColumn("head", F.expr(f"conv_id - conv_id % {BLOCK_OF}"))
        .repartition("head")
    )
    own = turns.groupBy("head", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    own = own.select("head", "conv_id", F.col("turns.element").alias("own"))
    first = F.when(F.col("conv_id") == F.col("head"), F.slice("own", 1, MOST_SHARED - 1))
    shared = F.max(first).over(Window.partitionBy("head"))  # at most BLOCK_OF rows
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).cast("int")
    taken = F.slice(F.coalesce(F.col("shared"), F.array().cast("array<binary>")), F.lit(1), F.col("h"))
    rest = F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0)))
    return own.withColumns({"shared": shared, "h": h}).select("conv_id", F.concat(taken, rest).alias("path"))


def gathered(paths: DataFrame) -> DataFrame:
    """path, span, ids: the conversations of each path in ascending runs."""
    span = F.expr(f"(conv_id - pmod(conv_id, {SPAN})) div {SPAN}")
    return paths.groupBy("path", span.alias("span")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))


# ---- balanced parentheses -----------------------------------------------------------


def excess_tree(excess: np.ndarray) -> list[np.ndarray]:
    """Least excess of each block, of each pair of blocks, and so on up to one."""
    far = np.iinfo(excess.dtype).max
    full = np.full(-(-len(excess) // BLOCK) * BLOCK, far, dtype=excess.dtype)
    full[: len(excess)] = excess
    levels = [full.reshape(-1, BLOCK).min(axis=1)]
    while len(levels[-1]) > 1:
        low = levels[-1]
        if len(low) % 2:
            low = levels[-1] = np.append(low, far)
        levels.append(low.reshape(-1, 2).min(axis=1))
    return levels


def find_close(excess: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """The closing parenthesis of each opening one: the next place with one less excess."""
    target = excess[opens] - 1
    out = np.full(len(opens), -1, dtype=np.int64)

    def scan(who: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Looks on from ``at`` to the end of its block; those still open come back."""
        while len(who):
            hit = excess[np.minimum(at, len(excess) - 1)] == target[who]
            out[who[hit]] = at[hit]
            who, at = who[~hit], at[~hit] + 1
            inside = (at % BLOCK != 0) & (at < len(excess))
            left.append(who[~inside])
            who, at = who[inside], at[inside]
        return who

    left: list[np.ndarray] = []
    at = opens + 1
    edge = at % BLOCK == 0  # the block ends with the opening one itself
    scan(np.flatnonzero(~edge), at[~edge])
    who = np.concatenate([*left, np.flatnonzero(edge)])
    if len(who) == 0:
        return out
    levels = excess_tree(excess)
    start = np.cumsum([0] + [len(x) for x in levels])
    tree = np.concatenate(levels)
    level = np.zeros(len(who), dtype=np.int64)
    node = opens[who] // BLOCK + 1
    climbing = np.arange(len(who))
    while len(climbing):  # to the right, and up where a pair is complete
        l, n = level[climbing], node[climbing]
        low = tree[start[l] + n] > target[who[climbing]]
        climbing, l, n = climbing[low], l[low], n[low] + 1
        up = n % 2 == 0
        level[climbing], node[climbing] = l + up, np.where(up, n >> 1, n)
    down = np.flatnonzero(level > 0)
    while len(down):
        level[down] -= 1
        node[down] *= 2
        node[down] += tree[start[level[down]] + node[down]] > target[who[down]]
        down = down[level[down] > 0]
    scan(who, node * BLOCK)
    return out


def subtree_min(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Least of values[k : k + size[k]] for each k, doubling the reach of one array at a time."""
    out = values.copy()
    reach, table = 1, values
    while True:
        mine = np.flatnonzero((size >= reach) & (size < 2 * reach))
        out[mine] = np.minimum(table[mine], table[mine + size[mine] - reach])
        if not (size >= 2 * reach).any():
            return out
        table = np.minimum(table[:-reach], table[reach:]) if len(table) > reach else table
        reach *= 2


class Shard:
    """The trie of distinct paths in ascending order, its nodes in preorder.

    ``ends`` and ``least`` are the members that end with each path: how many, the smallest.
    """

    def __init__(self, paths: list[bytes], ends: np.ndarray, least: np.ndarray):
        flat = np.frombuffer(b"".join(paths), ELEMENT)
        length = np.array([len(p) // WIDE for p in paths], dtype=np.int64)
        first = np.cumsum(length) - length
        common = np.full(len(paths), -1, dtype=np.int64)  # turns shared with the path before
        common[1:] = self._common(flat, first, length)
        fresh = length - common
        last = np.cumsum(fresh) - 1
        self.n = n = int(fresh.sum())
        path = np.repeat(np.arange(len(paths)), fresh)
        self.depth = np.arange(n) - np.repeat(last - fresh + 1, fresh) + common[path] + 1
        at = first[path] + self.depth - 1
        self.chars = np.zeros(n, dtype=np.int64)
        self.chars[self.depth > 0] = flat["size"][at[self.depth > 0]]
        self.end_of = np.full(n, -1, dtype=np.int64)
        self.end_of[last] = np.arange(len(paths))

        # one parenthesis pair a node: as many close before node k as are no ancestors of it
        opens = 2 * np.arange(n) - self.depth
        self.bits = np.zeros(2 * n, dtype=bool)
        self.bits[opens] = True
        excess = np.cumsum(np.where(self.bits, 1, -1), dtype=np.int32)
        closes = find_close(excess, opens)
        size = (closes - opens + 1) // 2
        pairs = np.cumsum(np.append(self.bits[:-1] & ~self.bits[1:], False))
        self.leaves = pairs[closes] - np.where(opens > 0, pairs[opens - 1], 0)

        own = np.zeros(n, dtype=np.int64)
        own[last] = ends
        below = np.append(0, np.cumsum(own))
        self.members = below[np.arange(n) + size] - below[:n]
        small = np.full(n, NOBODY, dtype=np.int64)
        small[last] = least
        self.least = subtree_min(small, size)
        saved = np.append(0, np.cumsum((self.members - 1) * self.chars))
        self.saved = saved[np.arange(n) + size] - saved[:n]

        self.parent = self._parents()
        self.children = np.bincount(self.parent[1:], minlength=n)
        self.spine = np.zeros(n, dtype=bool)
        self.spine[: length[0] + 1] = True  # the first path
        node = n - 1
        while node >= 0 and not self.spine[node]:
            self.spine[node] = True
            node = int(self.parent[node])

    @staticmethod
    def _common(flat: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        most = np.minimum(length[:-1], length[1:])
        pair = np.repeat(np.arange(len(most)), most)
        step = np.arange(len(pair)) - np.repeat(np.cumsum(most) - most, most)
        differ = np.flatnonzero(flat[first[:-1][pair] + step] != flat[first[1:][pair] + step])
        out = most.copy()
        where, at = np.unique(pair[differ], return_index=True)
        out[where] = step[differ[at]]
        return out

    def _parents(self) -> np.ndarray:
        """The last node before each one that is a level higher."""
        n = self.n
        key = self.depth * n + np.arange(n)
        order = np.argsort(key)
        found = np.searchsorted(key[order], (self.depth - 1) * n + np.arange(n)) - 1
        return np.where(self.depth > 0, order[np.maximum(found, 0)], -1)


def node_ids(path: bytes) -> list[bytes]:
    """An id of each node on a path, the root first."""
    h = hashlib.blake2b(digest_size=16)
    out = [h.digest()]
    for a in range(0, len(path), WIDE):
        h.update(path[a : a + WIDE])
        out.append(h.digest())
    return out


# ---- shards on Spark ----------------------------------------------------------------

CLOSED, SPINE, EDGE = 0, 1, 2
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODES = (
    "kind int, shard long, node binary, parent binary, conv_id long, parent_conv_id long, depth long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
    "first_path binary, last_path binary"
)
_NODES_ARROW = pa.schema(
    [
        ("kind", pa.int32()),
        ("shard", pa.int64()),
        ("node", pa.binary()),
        ("parent", pa.binary()),
        ("conv_id", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("depth", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("ends_sha256", pa.string()),
        ("first_path", pa.binary()),
        ("last_path", pa.binary()),
    ]
)


def _shard_rows(number: int, paths: list[bytes], ends: list[int], least: list[int], digests: list[str]):
    """Closed nodes with final figures, spine nodes with this shard's share, and the edge paths."""
    trie = Shard(paths, np.array(ends), np.array(least))
    ids: dict[int, bytes] = {}
    for end, path in ((len(paths[0]) // WIDE, paths[0]), (trie.n - 1, paths[-1])):
        node = end
        for name in reversed(node_ids(path)):
            ids[node] = name
            node = int(trie.parent[node])
    parent = trie.parent.copy()
    under = (parent >= 0) & trie.spine[np.maximum(parent, 0)]
    inside = (parent >= 0) & ~under
    order = np.array([NO_ENDS, *digests], dtype=object)
    ends_sha = order[trie.end_of + 1]
    ends_sha[trie.spine & (trie.end_of < 0)] = None  # another shard may know better
    table = {
        "kind": pa.array(trie.spine.astype(np.int32)),
        "shard": pa.array(np.full(trie.n, number)),
        "node": pa.array([ids.get(k) for k in range(trie.n)], pa.binary()),
        "parent": pa.array([ids[int(p)] if u else None for p, u in zip(parent, under)], pa.binary()),
        "conv_id": pa.array(trie.least),
        "parent_conv_id": pa.array(trie.least[np.maximum(parent, 0)], mask=~inside),
        "depth": pa.array(trie.depth),
        "n_convs": pa.array(trie.members),
        "n_children": pa.array(trie.children),
        "n_leaves": pa.array(trie.leaves),
        "saved_tokens": pa.array(trie.saved),
        "ends_sha256": pa.array(ends_sha, pa.string()),
    }
    nodes = pa.RecordBatch.from_arrays(
        [table.get(f.name, pa.nulls(trie.n, f.type)) for f in _NODES_ARROW], schema=_NODES_ARROW
    )
    edge = {"kind": EDGE, "shard": number, "first_path": paths[0], "last_path": paths[-1]}
    yield from (nodes.slice(a, 10_000) for a in range(0, trie.n, 10_000))
    yield pa.RecordBatch.from_pylist([edge], schema=_NODES_ARROW)


def _path_bytes(column: pa.Array) -> list[bytes]:
    """Each path's elements in one string."""
    edges = column.offsets.to_numpy()
    elements = column.values.cast(pa.large_binary())
    _, offsets, data = elements.buffers()
    if len(elements) == 0:
        return [b""] * len(column)
    at = np.frombuffer(offsets, np.int64)[elements.offset : elements.offset + len(elements) + 1]
    raw = memoryview(data)
    return [bytes(raw[at[a] : at[b]]) for a, b in zip(edges, edges[1:])]


def _build(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        held: tuple[list, list, list, list] = ([], [], [], [])
        size, path, sha, ends, least = 0, None, None, 0, NOBODY
        for batch in batches:
            for own, ids in zip(_path_bytes(batch.column("path")), batch.column("ids").to_pylist()):
                if own != path:
                    if path is not None:
                        for x, value in zip(held, (path, ends, least, sha.hexdigest())):
                            x.append(value)
                        size += len(path) // WIDE + 1
                    if size >= limit:
                        yield from _shard_rows(base + number, *held)
                        held, size, number = ([], [], [], []), 0, number + 1
                    path, sha, ends, least = own, hashlib.sha256(), 0, NOBODY
                if ends:
                    sha.update(b",")
                sha.update(",".join(map(str, ids)).encode())
                ends, least = ends + len(ids), min(least, ids[0])
        if path is not None:
            for x, value in zip(held, (path, ends, least, sha.hexdigest())):
                x.append(value)
            yield from _shard_rows(base + number, *held)

    return run


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What two neighbours both counted on the turns that they share, a row for each node there."""
    for batch in batches:
        for before, path in zip(batch.column("before").to_pylist(), batch.column("first_path").to_pylist()):
            a, b = np.frombuffer(before, ELEMENT), np.frombuffer(path, ELEMENT)
            most = min(len(a), len(b))
            differ = np.flatnonzero(a[:most] != b[:most])
            k = int(differ[0]) if len(differ) else most
            chars = np.append(0, b["size"][:k].astype(np.int64))  # of the node at each depth
            below = np.cumsum(chars[::-1])[::-1]
            n = k + 1
            made = {
                "node": pa.array(node_ids(path)[:n], pa.binary()),
                "n_children": pa.array(np.append(np.full(k, -1), 0)),
                # a path that goes on in the next shard is no leaf
                "n_leaves": pa.array(np.full(n, -1 if len(a) == k else 0)),
                "saved_tokens": pa.array(below),
                "n_convs": pa.array(np.zeros(n, dtype=np.int64)),
            }
            yield pa.RecordBatch.from_arrays(list(made.values()), names=list(made))


FIGURES = ("n_convs", "n_children", "n_leaves", "saved_tokens")
RESULT = ("conv_id", "depth", "parent_conv_id", *FIGURES, "ends_sha256")


def trie(conversations: DataFrame, shard_elements: int = SHARD_ELEMENTS) -> DataFrame:
    """One row a node of the trie of rebuilt conversations (columns ``RESULT``)."""
    spark = conversations.sparkSession
    rows = stored(spark, gathered(rebuilt_paths(conversations)), "trie-paths")
    dealt = rows.repartitionByRange(partitions(spark), "path").sortWithinPartitions("path", "span")
    nodes = stored(spark, dealt.select("path", "ids").mapInArrow(_build(shard_elements), NODES), "trie-nodes")
    discard(rows)

    # one row a shard meets here
    in_order = Window.orderBy("first_path")
    edges = nodes.filter(F.col("kind") == EDGE).select(
        "first_path", F.lag("last_path").over(in_order).alias("before")
    )
    fix = edges.filter("before is not null").mapInArrow(
        _corrections,
        "node binary, n_children long, n_leaves long, saved_tokens long, n_convs long",
    )
    shares = nodes.filter(F.col("kind") == SPINE).select(
        "shard", "node", "parent", "conv_id", "depth", *FIGURES, "ends_sha256"
    )
    merged = (
        shares.unionByName(fix, allowMissingColumns=True)
        .groupBy("node")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.max("depth").alias("depth"),
            F.max("parent").alias("parent"),
            *(F.sum(c).alias(c) for c in FIGURES),
            F.coalesce(F.max("ends_sha256"), F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )
    merged = stored(spark, merged, "trie-spines")
    named = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    spines = merged.join(named, "parent", "left").select(*RESULT)

    closed = nodes.filter(F.col("kind") == CLOSED)
    # the parents' final ids, by shard: no shard has more than its two spines
    parents = shares.select("shard", F.col("node").alias("parent")).join(named, "parent")
    hanging = (
        closed.filter("parent is not null").drop("parent_conv_id").join(parents, ["shard", "parent"]).select(*RESULT)
    )
    return closed.filter("parent is null").select(*RESULT).unionByName(hanging).unionByName(spines)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the prefix trie of all rebuilt conversations."""
    return trie(read(spark, sf_dir, "conversations"))


SQL = """
WITH o AS (
  SELECT conv_id AS c, conv_id - conv_id % 100 AS head,
         list({'r': r, 'x': x} ORDER BY turn NULLS FIRST, r, sha256(strlen(r) || ':' || r || x)) AS own,
         xor(list_reduce(list_prepend(4294967295,
               list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
             lambda sum, byte: list_reduce(list_prepend(xor(sum, byte), range(8)),
               lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)),
             4294967295) % 6 AS h
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x
        FROM conversations WHERE conv_id IS NOT NULL) t
  GROUP BY conv_id
), p AS (
  SELECT o.c, CASE WHEN b.c IS NULL THEN o.own[o.h + 1:] ELSE list_concat(b.own[1:o.h], o.own[o.h + 1:]) END AS path
  FROM o LEFT JOIN o b ON b.c = o.head
), n AS (
  SELECT c, len(path) AS total, d, path[1:d] AS node
  FROM (SELECT c, path, unnest(range(0, len(path) + 1)) AS d FROM p) x
), g AS (
  SELECT node, d, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE total = d), '')) AS ends_sha256,
         (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE len(node[d].x) END AS own
  FROM n GROUP BY node, d
), k AS (
  SELECT node[1:d - 1] AS node, d - 1 AS d, count(*) AS n_children FROM g WHERE d > 0 GROUP BY ALL
), f AS (
  SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN k ON k.node = g.node AND k.d = g.d
), s AS (
  SELECT node[1:up] AS node, up AS d, sum(own) AS saved, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves
  FROM (SELECT node, own, n_children, unnest(range(0, d + 1)) AS up FROM f) x GROUP BY ALL
)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN s ON s.node = f.node AND s.d = f.d
LEFT JOIN g u ON f.d > 0 AND u.d = f.d - 1 AND u.node = f.node[1:f.d - 1]
"""
