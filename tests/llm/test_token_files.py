"""Bit-packed token files: round trip, random access, order, and edge rows."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF001
from oracle_check import duck
from shoppulse.llm import token_files
from shoppulse.llm.queries import QUERIES
from shoppulse.session import ship_package

SCHEMA = "doc_id long, text string, `a.b` string, n long, words string, bucket string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def library():
    import public_tokenizers as tokens
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.path("byte_bpe_50k.json"))


def tokenizer_path():
    import public_tokenizers as tokens

    return tokens.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.integers(0, 6), st.integers(0, 1 << 30))
def test_packing_round_trip(width, groups, seed):
    r = np.random.default_rng(seed)
    ids = r.integers(0, 1 << width, 64 * groups, dtype=np.uint64).astype(np.uint32)
    words = token_files.pack_ids(ids, width)
    assert len(words) == groups * width
    assert (token_files.unpack_ids(words, width) == ids).all()


def test_bits_are_those_of_the_vocabulary():
    assert [token_files.bits_needed(n) for n in (1, 2, 3, 256, 257, 50_257, 65_536, 65_537)] == [
        1, 1, 2, 8, 9, 16, 16, 17,
    ]


@pytest.mark.parametrize("width", [1, 11, 16, 17])
def test_random_access(width):
    r = np.random.default_rng(width)
    sizes = np.array([1, 470_000, 3, 20_000])
    ids = r.integers(0, 1 << width, sizes.sum()).astype(np.uint32)
    writer = token_files.FileWriter(width, 3, 5)
    for doc, part in zip([None, -4, 7, 7], np.split(ids, np.cumsum(sizes)[:-1])):
        writer.add(doc, part)
    data = writer.closed()
    assert len(data) < 200 + 8 * 30 + (len(ids) + 64) * width / 8 + 8
    file = token_files.TokenFile(data + b"\n")
    assert (file.bucket, file.number, file.n_docs, file.n_ids) == (3, 5, 4, len(ids))
    assert file.named.tolist() == [False, True, True, True]
    for _ in range(50):
        a, b = sorted(r.integers(0, len(ids) + 1, 2).tolist())
        assert (file.ids(a, b) == ids[a:b]).all()
    assert (file.document(1) == ids[1:470_001]).all() and len(file.document(2)) == 3
    with pytest.raises(ValueError):
        token_files.TokenFile(data[:-10])
    with pytest.raises(ValueError):
        token_files.TokenFile(b"x" * 100)


def expected(rows):
    """(doc_id, start, n_tokens, crc) in file order, rows of one doc_id in any order."""
    tokenizer, out, at = library(), [], 0
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [token_files.END_ID]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_op12_equals_the_library(spark):
    rows = duck(SF001).execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()
    got = QUERIES["op12_token_files"](spark, SF001).collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == expected(rows)


def test_op12_edge_rows(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdé") for _ in range(r.randint(1, 6)))
    long = " ".join(word() for _ in range(60_000))
    texts = [
        (5, None), (4, ""), (-9, "below zero <|endoftext|> x"), (3, long), (2, "Straße 中文 \U0001f600"),
        (1 << 62, "far"), (None, "no id"), (None, None), (6, "same"), (6, "same"), (6, "same"), (6, "other"),
        *[(7, f"hot {i % 5}") for i in range(60)],
    ]
    docs = spark.createDataFrame([(d, t, "x", 1, "w", "b") for d, t in texts], SCHEMA).repartition(3)
    path = token_files.shared_path(spark, "test-token-files")
    token_files.write_tokens(docs, tokenizer_path(), path, ids_per_file=4000)
    got = [tuple(x) for x in token_files.read_documents(spark, path).collect()]
    got.sort(key=lambda x: x[1])
    # the stream has no gap, documents ascend, rows without doc_id come first
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n
    keys = [(d is not None, d or 0) for d, *_ in got]
    assert keys == sorted(keys)
    plain = lambda rows: sorted(((d is not None, d or 0), n, c) for d, _, n, c in rows)
    assert plain(got) == plain(expected(texts))
    files = [token_files.TokenFile(x["content"]) for x in token_files.file_contents(spark, path).collect() if x["content"]]
    assert all(f.width == 16 and (f.n_ids <= 4000 or f.n_docs == 1) for f in files) and len(files) > 3
    assert len({f.bucket for f in files if 7 in f.doc_id}) > 1  # one hot doc_id, several buckets


def test_op12_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    path = token_files.shared_path(spark, "test-token-files")
    token_files.write_tokens(docs, tokenizer_path(), path)
    out = token_files.read_documents(spark, path)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.collect() == []
