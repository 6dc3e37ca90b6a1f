"""Registered queries of the text operators against their SQL, held-out labels and recall."""

import binascii
import hashlib

import numpy as np
import pytest

from conftest import SF001, SF01
from oracle_check import digest, duck, type_mismatches
from shoppulse.llm.queries import QUERIES, SQL
from shoppulse.session import ship_package


SF1 = "/root/testdata/sf0.1"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duck(SF001)
    df = QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    columns = [d[0] for d in res.description]
    expected = res.fetchall()
    rel = con.sql(SQL[name])
    assert type_mismatches(df, rel.columns, rel.types) == {}
    assert sorted(df.columns) == sorted(columns) and len(rows) == len(expected)
    assert digest(df.columns, rows) == digest(columns, expected)


def rows_of(path, table, columns):
    return duck(path).execute(f"SELECT {columns} FROM {table}").fetchall()


def fold(doc_id, n):
    return binascii.crc32(str(doc_id).encode()) % n


def test_op1_predicts_held_out_languages(spark):
    lang = dict(rows_of(SF01, "documents", "doc_id, lang"))
    got = QUERIES["op1_kernel_langid"](spark, SF01).collect()
    assert len(got) == len(lang)
    assert all(r["held_out"] == (fold(r["doc_id"], 4) == 2) for r in got)
    held = [r for r in got if r["held_out"] and lang[r["doc_id"]] is not None]
    right = sum(r["lang_pred"] == lang[r["doc_id"]] for r in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_op3_finds_held_out_toxic_documents(spark):
    """Recall on rows that were not learned from, at sf0.1 (some labels there mark texts without any insult)."""
    toxic = dict(rows_of(SF1, "labels", "doc_id, toxic"))
    got = QUERIES["op3_subword_toxicity"](spark, SF1).collect()
    assert all(r["held_out"] == (fold(r["doc_id"], 4) == 2) for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    marked = [r for r in held if toxic.get(r["doc_id"]) == 1]
    assert sum(r["predicted"] for r in marked) >= 0.9 * len(marked) > 90
    clean = [r for r in held if toxic.get(r["doc_id"]) == 0]
    assert sum(r["predicted"] for r in clean) <= 0.03 * len(clean)


def test_op9_separates_held_out_quality(spark):
    quality = dict(rows_of(SF01, "labels", "doc_id, quality"))
    got = QUERIES["op9_quality_qda"](spark, SF01).collect()
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in quality]
    assert sum(r["predicted"] == quality[r["doc_id"]] for r in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)


def test_op4_equals_the_library(spark):
    import public_tokenizers as tokens
    import tiktoken

    from shoppulse.llm.bpe import rank_table

    ranks = rank_table(tokens.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("t", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for doc, text in rows_of(SF001, "documents", "doc_id, text"):
        ids = library.encode_ordinary(text or "")
        raw = np.array(ids, "<u4").tobytes()
        want[doc] = (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    got = QUERIES["op4_byte_bpe"](spark, SF001).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == want


def test_op8_packs_every_token_once(spark):
    import zlib

    import public_tokenizers as tokens
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.path("byte_bpe_50k.json"))
    got = QUERIES["op8_best_fit_packing"](spark, SF001).collect()
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    docs = rows_of(SF001, "documents", "doc_id, text")
    assert set(pieces) == {d for d, _ in docs}
    total = 0
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted(pieces[doc], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert len(own) == -(-len(ids) // 1024) and all(r["length"] == 1024 for r in own[1:])
        at = 0
        for r in own:
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert (r["start"], r["ids_crc32"]) == (at, zlib.crc32(part))
            at += r["length"]
        assert at == len(ids)
        total += at
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= 1.05 * -(-total // 1024)


def test_op10_recall_and_exact_distances(spark):
    rows = rows_of(SF01, "embeddings", "vec_id, embedding")
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], dtype=np.float64)
    got = {}
    for r in QUERIES["op10_multiprobe_lsh"](spark, SF01).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hit = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        distance = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        distance[q] = np.inf
        best = set(ids[np.lexsort((ids, distance))[:10]].tolist())
        own = sorted(got[int(ids[q])])
        assert [r for r, _, _ in own] == list(range(1, 11))
        for _, vec, score in own:
            assert abs(score - distance[np.flatnonzero(ids == vec)[0]]) < 1e-12
        hit += len(best & {v for _, v, _ in own})
        total += 10
    assert hit >= 0.9 * total
