"""Conversation trie: parentheses against plain loops, whole tries against brute force."""

import binascii
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoppulse.llm import conversation_trie as ct
from shoppulse.session import ship_package

SCHEMA = "conv_id long, turn long, role string, text string, head long, path string, `a.b` long, depth int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def random_tree(seed, n):
    """Depths in preorder of a random tree with n nodes."""
    r = random.Random(seed)
    depths, d = [0], 0
    for _ in range(n - 1):
        d = r.choice([d + 1, d + 1, r.randint(1, d + 1)])
        depths.append(d)
    return np.array(depths)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 700))
def test_closing_parentheses(seed, n):
    depth = random_tree(seed, n)
    opens = 2 * np.arange(n) - depth
    bits = np.zeros(2 * n, dtype=bool)
    bits[opens] = True
    got = ct.find_close(np.cumsum(np.where(bits, 1, -1), dtype=np.int32), opens)
    stack, want = [], {}
    for at, bit in enumerate(bits):
        if bit:
            stack.append(at)
        else:
            want[stack.pop()] = at
    assert got.tolist() == [want[a] for a in opens]
    size = (got - opens + 1) // 2
    values = np.random.default_rng(seed).integers(0, 1000, n)
    assert ct.subtree_min(values, size).tolist() == [values[k : k + s].min() for k, s in enumerate(size)]


def sequences(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))

    def tie(t):
        return (*t[:3], hashlib.sha256(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).hexdigest()[:32])

    own = {c: [t[2:] for t in sorted(turns, key=tie)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = binascii.crc32(str(c).encode()) % 6
        head = c - int(np.fmod(c, 100))
        out[c] = tuple(own.get(head, [])[:h] + turns[h:])
    return out


def brute(rows):
    seqs = sequences(rows)
    members, ends = {}, {}
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    saved, leaves = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[x] for x in below)
        leaves[node] = sum(leaves[x] for x in below) or 1
    out = []
    for node, who in members.items():
        listed = ",".join(map(str, sorted(ends.get(node, []))))
        out.append(
            (
                min(who), len(node), min(members[node[:-1]]) if node else -1, len(who),
                len(children.get(node, [])), leaves[node], saved[node], hashlib.sha256(listed.encode()).hexdigest(),
            )
        )
    return sorted(out)


def got_rows(df):
    return sorted(
        (r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], r["n_convs"],
         r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"])
        for r in df.collect()
    )


def conversations(seed=5):
    r = random.Random(seed)
    rows = []
    for c in [*range(0, 260), *range(990, 1110), -7, 10**15 + 3]:
        if c % 11 == 10:
            continue
        for t in range(r.randint(0, 6)):
            rows.append((c, t, r.choice(["user", "assistant"]), r.choice(["a", "bb", "", "ü\U0001f600", "long " * 50])))
    for c in range(5000, 5400):  # a hot first turn, and a hot conversation
        rows += [(c, 0, "system", "same"), (c, 1, "user", "same too")]
        if c % 3:
            rows.append((c, 2, "user", f"own {c % 7}"))
    rows += [(70_001, t, "user", f"turn {t % 4}") for t in range(700)]  # a very long one
    rows += [(70_002, None, None, None), (70_002, 1, "x", None), (70_002, 1, "x", None), (70_002, 1, None, "y")]
    rows += [(80_000, 3, "r", "tie"), (80_000, 3, "r", "eit"), (80_000, 3, "q", "z"), (None, 1, "r", "t")]
    return rows


@pytest.mark.parametrize("limit, parts", [(ct.SHARD_ELEMENTS, 8), (40, 5), (1, 3)])
def test_trie_matches_brute_force(spark, limit, parts):
    rows = conversations()
    table = spark.createDataFrame([(*x, 9, "p", 1, 2) for x in rows], SCHEMA).repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        out = ct.trie(table, limit)
        assert got_rows(out) == brute(rows)
        assert dict(out.dtypes) == {
            **{c: "bigint" for c in ct.RESULT}, "ends_sha256": "string",
        }
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_turnless_conversations_and_empty_tables(spark):
    # no head, fewer own turns than are taken from it: only the root holds such a conversation
    short = [c for c in range(101, 200) if binascii.crc32(str(c).encode()) % 6 >= 2][:5]
    rows = [(c, 0, "user", "only") for c in short]
    table = spark.createDataFrame([(*x, 9, "p", 1, 2) for x in rows], SCHEMA)
    assert got_rows(ct.trie(table)) == brute(rows)
    assert len(brute(rows)) == 1
    assert ct.trie(table.limit(0)).collect() == []
    assert ct.trie(table.withColumn("conv_id", F.lit(None).cast("long"))).collect() == []
