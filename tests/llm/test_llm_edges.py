"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shoppulse.llm import (
    arc_to_warc,
    best_fit_packing,
    bpe,
    chunk_bpe,
    components,
    grouped_prefix_join,
    kernel_langid,
    multiprobe_lsh,
    ngrams,
    quality_qda,
    quality_rules,
    subword_toxicity,
    suffix_tree_dedup,
)
from shoppulse.session import ship_package

WORDS = "[^\x20\x09-\x0d]+"
DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, n_words string, "
    "score string, bucket string, row string, hub long, token string, n_removed string"
)
rng = random.Random(4)
VOCABULARY = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


PASSAGE = prose(60, "shared")
LONG = prose(30_000, "long") + "\n" + PASSAGE


def texts():
    base = prose(200, "base")
    words = base.split()
    near = " ".join([*words[:100], "changed", *words[101:]])
    chain = " ".join([*words[:100], "changed", *words[101:190], "again", *words[191:]])
    return [
        (1, base), (2, base), (3, near), (4, chain), (5, None), (6, ""), (7, " \t\n "), (8, "Two words"),
        (9, "two WORDS"), (10, "!!! 123 ..."), (11, LONG), (12, LONG + " tail"), (13, PASSAGE + " own " + prose(80, "a")),
        (14, prose(70, "b") + "\n" + PASSAGE), (15, "ab " * 300), (16, "line one two three\n" * 40),
        (17, "one"), (18, "Straße naïve 中文 \U0001f600 it's we'll " + prose(40, "c")), (19, prose(12, "d")),
        (20, base), (20, base),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    rows = [(i, t, "xx" if i % 2 else None, "s", len(t or ""), "n", "s", "b", "r", 1, "t", "x") for i, t in texts()]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def words_of(text):
    return re.findall(WORDS, text or "")


# ---- quality rules ------------------------------------------------------------------


def brute_measures(text):
    words = words_of(text)
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines),
        len(lines) - len(set(lines)), len(covered), sum(c.isupper() for c in text or ""),
    )


def test_quality_measures_against_brute_force(docs):
    short = docs.filter("doc_id not in (11, 12)")
    got = {r["row"]["doc_id"]: tuple(r)[1:] for r in quality_rules.measure(short).collect()}
    assert got == {i: brute_measures(t) for i, t in texts() if i not in (11, 12)}


def test_ledger_policies_and_ablations(docs, empty):
    rows = quality_rules.ledger(docs)
    assert rows.count() == len(texts())
    kept = quality_rules.apply_policy(rows, quality_rules.BASE).filter("kept")
    assert {1, 11} <= {r["doc_id"] for r in kept.collect()}
    failed = [r["failed"] for r in rows.collect()]
    for r in quality_rules.ablations(rows, quality_rules.CURRENT).collect():
        bit, mask = quality_rules.BIT[r["rule"]], quality_rules.CURRENT.mask
        assert r["n_failed"] == sum(bool(f & bit) for f in failed)
        assert r["n_failed_alone"] == sum((f & mask) == bit for f in failed)
        assert r["n_kept_without"] == sum((f & mask & ~bit) == 0 for f in failed)
    assert quality_rules.ledger(empty).count() == 0
    stage = quality_rules.kept_documents(docs, quality_rules.CURRENT)
    assert stage.columns == docs.columns


# ---- classifiers ------------------------------------------------------------------------


def test_language_edges(docs, empty):
    model = kernel_langid.fit(
        kernel_langid.presence(["the house of the wind", "and the other thing", "das haus und der wind", "die andere"])[0],
        ["en", "en", "de", "de"],
    )
    names, scores = kernel_langid.predict([None, "", "12 !", "the other house", "und das andere Haus"], model)
    assert names == ["und", "und", "und", "en", "de"] and list(scores[:3]) == [0, 0, 0]
    assert kernel_langid.train(empty) is None
    rows = kernel_langid.identify(docs, None).collect()
    assert len(rows) == len(texts()) and {r[kernel_langid.PREDICTED] for r in rows} == {"und"}
    assert kernel_langid.identify(docs, None).columns[: len(docs.columns)] == docs.columns
    one = kernel_langid.train(docs)  # only one language is labelled
    got = {r["doc_id"]: r[kernel_langid.PREDICTED] for r in kernel_langid.identify(docs, one).collect()}
    assert got[1] == "xx" and got[5] == got[6] == got[10] == "und"


def test_language_sample_is_bounded_on_the_executors(spark):
    """One doc_id repeated very often gives no more rows than any other, and is not all of the sample."""
    ship_package(spark)
    rows = [(7, f"das ist ein satz nummer {i}", "de") for i in range(3000)] + [(7, "immer das gleiche", "de")] * 2000
    rows += [(100 + i, f"this is sentence number {i}", "en") for i in range(500)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    seen = []
    fitted = kernel_langid.fit
    kernel_langid.fit = lambda found, labels: seen.append(labels) or fitted(found, labels)
    try:
        model = kernel_langid.train(table)
    finally:
        kernel_langid.fit = fitted
    (labels,) = seen
    assert 200 <= labels.count("de") <= kernel_langid.ROWS_PER_LANGUAGE == labels.count("en")
    got = kernel_langid.identify(spark.createDataFrame([(1, "das ist gut"), (2, "this is good")], "doc_id long, text string"), model)
    assert {r["doc_id"]: r[kernel_langid.PREDICTED] for r in got.collect()} == {1: "de", 2: "en"}


def test_folded_weights_equal_the_unfolded_kernel_solution():
    """Landmark map and ridge regression, solved plainly from kernel values."""
    sample = [prose(30, f"u{i}") for i in range(30)] + [prose(30, f"v{i}").upper().replace("A", "Z") for i in range(30)]
    labels = ["aa"] * 30 + ["bb"] * 30
    found, _ = kernel_langid.presence(sample)
    model = kernel_langid.fit(found, labels)
    sets = [set(np.flatnonzero(row)) for row in found]
    kernel = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    marks = [*range(30), *range(30, 60)][: 2 * kernel_langid.LANDMARKS_PER_LANGUAGE]
    value, vector = np.linalg.eigh(kernel[np.ix_(marks, marks)])
    solid = value > 1e-8 * value.max()
    features = np.hstack([kernel[:, marks] @ (vector[:, solid] / np.sqrt(value[solid])), np.ones((60, 1))])
    target = np.array([[1.0, -1.0]] * 30 + [[-1.0, 1.0]] * 30)
    left = features.T @ features / 30 + np.eye(features.shape[1]) * kernel_langid.RIDGE * 2
    plain = features @ np.linalg.solve(left, features.T @ target / 30)
    assert np.allclose(model.scores(found), plain, atol=1e-3)


def test_kernel_is_the_exact_presence_kernel():
    found, _ = kernel_langid.presence(["abc", "abd"])
    grams = [{" a", "a", "ab", " ab", "b", x, "b" + x, "ab" + x, x + " ", "b" + x + " "} for x in "cd"]
    assert found[0] @ found[1] == len(grams[0] & grams[1])
    assert found[0].sum() == len(grams[0])


def test_quality_edges(spark, docs, empty):
    x = quality_qda.features(docs).collect()
    assert len(x) == len(texts()) and all(np.isfinite(r["x"]).all() for r in x)
    assert quality_qda.features(empty).count() == 0
    assert quality_qda.train(quality_qda.features(empty).withColumn("label", F.lit(1))) == 0.5
    same = quality_qda.features(docs).withColumn("label", F.lit(1))
    assert quality_qda.train(same) == 1.0
    both = quality_qda.features(docs).withColumn("label", (F.col("doc_id") % 2).cast("int"))
    model = quality_qda.train(both)
    got = quality_qda.score(both, model).collect()
    assert all(0 <= r["score"] <= 1 for r in got) and len(got) == len(texts())


def test_discriminant_against_the_density_formula():
    r = np.random.default_rng(1)
    d = len(quality_qda.FEATURES)
    a, b = r.normal(0, 1, (300, d)), r.normal(1, 2, (200, d))
    total = np.stack([np.hstack([np.ones((len(v), 1)), v]).T @ np.hstack([np.ones((len(v), 1)), v]) for v in (a, b)])
    model = quality_qda.fit(total, shrinkage=0.2)
    z = (np.vstack([a, b]) - model.shift) / model.scale
    logs = []
    for v in (a, b):
        y = (v - model.shift) / model.scale
        cov = 0.8 * np.cov(y.T, bias=True)
        cov += 0.2 * np.trace(cov) / d * np.eye(d)
        diff = z - y.mean(axis=0)
        logs.append(np.log(len(v) / 500) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff))
    want = 1 / (1 + np.exp(logs[0] - logs[1]))
    assert np.allclose(model.score(np.vstack([a, b])), want, atol=1e-9)


def test_toxicity_edges_and_misspellings(docs, empty):
    good = [prose(60, i) for i in range(60)]
    bad = [prose(20, 100 + i) + " rottenfool " + prose(30, 200 + i) for i in range(30)]
    model = subword_toxicity.fit(good + bad, np.array([0] * 60 + [1] * 30))
    scores = model.score([bad[0], good[0], prose(900, "x") + " rottenfools " + prose(900, "y"), "rotenfool", "", None, "!!"])
    assert scores[0] > 0.5 > 0.3 > scores[1] and scores[2] > 0.3 and scores[3] > scores[1]
    assert list(scores[4:]) == [0, 0, 0]
    assert subword_toxicity.fit(good, np.zeros(60, int)) is None
    assert subword_toxicity.train(empty, empty.select("doc_id", F.lit(1).alias("toxic"))) is None
    got = subword_toxicity.score(docs, None).collect()
    assert len(got) == len(texts()) and all(r["score"] == 0 for r in got)


def plain_passage_score(model, text):
    """The forward pass by words: mean logit of a passage's subwords, the worst passage counts."""
    clean = "".join(c if c.isalnum() else " " for c in (text or "").lower())
    words, best = clean.split(), None
    for a in range(0, len(words), subword_toxicity.PASSAGE):
        logits = []
        for word in words[a : a + subword_toxicity.PASSAGE]:
            edged = f" {word} "
            for n in subword_toxicity.SIZES:
                for k in range(len(edged) - n + 1):
                    chars = np.array([ord(c) for c in edged[k : k + n]], dtype=np.uint32)
                    _, bucket = ngrams.grams(chars, n, subword_toxicity.BITS)
                    logits.append(float(model.logit[bucket[0]]))
        value = (sum(logits) / len(logits) if logits else 0.0) + model.bias
        best = value if best is None else max(best, value)
    return 0.0 if best is None else 1 / (1 + np.exp(-best))


def test_toxicity_forward_pass_against_plain_python():
    good = [prose(60, i) for i in range(40)]
    bad = [prose(20, 100 + i) + " rottenfool " + prose(30, 200 + i) for i in range(20)]
    model = subword_toxicity.fit(good + bad, np.array([0] * 40 + [1] * 20))
    asked = [*bad[:3], *good[:3], "", None, "!?", "a", "ab cd", "Rotten-Fool, rottenf00l!", "Straße naïve 中文"]
    got = model.score(asked)
    assert np.allclose(got, [plain_passage_score(model, t) for t in asked], atol=1e-6)


def test_toxicity_learns_from_long_texts_too(spark):
    """All labelled toxic texts are longer than a sampled section."""
    ship_package(spark)
    long = lambda seed: " ".join(f"{prose(5, seed * 1000 + k)} rottenfool" for k in range(400))
    rows = [(i, long(i), 1) for i in range(12)] + [(100 + i, prose(60, i), 0) for i in range(40)]
    assert all(len(t) > subword_toxicity.SAMPLE_CHARS for _, t, y in rows if y)
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    model = subword_toxicity.train(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    scores = model.score([long(50), prose(60, 900)])
    assert scores[0] > 0.3 > scores[1]


def plain_statistics(text):
    raw = text.encode()
    kinds = [quality_qda.CLASSES[b] for b in raw]
    words = raw.split()
    some = len(words) + 20
    solid = sum(map(len, words)) + 20 * 5.0
    mean = solid / some
    spread = max((sum(len(w) ** 2 for w in words) + 20 * (5.0**2 + 2.5**2)) / some - mean * mean, 0) ** 0.5
    lines = [x for x in raw.split(b"\n") if x.split()]
    share = lambda k: (kinds.count(k) / solid) ** 0.5
    return [
        np.log1p(len(words)), mean, spread, *(share(k) for k in (1, 2, 3, 4, 6, 7, 8)),
        (len(set(words)) + 20) / some, ((len(lines) - len(set(lines))) / (len(lines) + 2)) ** 0.5,
        np.log1p(some / (len(lines) + 2)),
    ]


def test_quality_statistics_against_plain_python():
    asked = [t or "" for _, t in texts()] + ["a\na\n\n b\na", "\n\n", "x" * 700, "one line\n" + "y " * 500 + "\none line"]
    raw = [t.encode() for t in asked]
    offsets = np.append(0, np.cumsum([len(r) for r in raw]))
    got = quality_qda.statistics(np.frombuffer(b"".join(raw), np.uint8), offsets)
    want = np.array([plain_statistics(t) for t in asked])
    assert got.shape == want.shape == (len(asked), len(quality_qda.FEATURES))
    assert np.allclose(got, want, atol=1e-9)


# ---- tokens -----------------------------------------------------------------------------


def test_pretokens_against_the_library():
    import public_tokenizers as tokens

    codec = chunk_bpe.Codec.of(tokens.path("byte_bpe_multi_50k.tiktoken"), tokens.PATTERN)
    r = random.Random(9)
    alphabet = "ab's tlrevmd'  \n\t\r1²é\xa0\x85!#.,ßL\x1c"
    made = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(5000)]
    made += [t or "" for _, t in texts()]
    for text, ids in zip(made, codec.encode(made)):
        assert ids.tolist() == codec.library.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()


def test_chunks_give_the_same_ids_at_every_size(docs, empty):
    import public_tokenizers as tokens

    path = tokens.path("byte_bpe_multi_50k.tiktoken")
    want = {tuple(r) for r in chunk_bpe.digests(*chunk_bpe.encode(docs, path, tokens.PATTERN)).collect()}
    unbroken = docs.filter("doc_id = 1").withColumn("text", F.repeat(F.lit("a"), 500)).withColumn("doc_id", F.lit(99).cast("long"))
    few = docs.filter("doc_id in (3, 4, 11, 18)").unionByName(unbroken)
    whole = {tuple(r) for r in chunk_bpe.digests(*chunk_bpe.encode(few, path, tokens.PATTERN)).collect()}
    for size, overlap in ((100, 8), (1000, 60)):
        got = chunk_bpe.digests(*chunk_bpe.encode(few, path, tokens.PATTERN, size, overlap))
        assert {tuple(r) for r in got.collect()} == whole
    assert chunk_bpe.digests(*chunk_bpe.encode(empty, path, tokens.PATTERN)).count() == 0
    assert len([r for r in want if r[0] in (5, 6)]) == 2 and all(r[1] == 0 for r in want if r[0] in (5, 6))


def test_long_rows_are_told_apart(spark):
    """Repeated long rows, long rows without doc_id and two long texts of one doc_id."""
    import public_tokenizers as tokens

    path = tokens.path("byte_bpe_multi_50k.tiktoken")
    a, b, c = (prose(900, f"long row {k}") for k in range(3))
    rows = [(1, a), (1, a), (1, a), (2, a), (None, a), (None, a), (None, b), (3, b), (3, c), (4, "short"), (4, "short")]
    library = chunk_bpe.Codec.of(path, tokens.PATTERN).library
    want = []
    for doc, text in rows:
        ids = np.array(library.encode_ordinary(text), "<u4")
        want.append((doc, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    ship_package(spark)
    for parts in (1, 4):
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = chunk_bpe.digests(*chunk_bpe.encode(frame, path, tokens.PATTERN, 400, 40)).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_piece_cache_starts_over_when_full(monkeypatch):
    import public_tokenizers as tokens

    codec = chunk_bpe.Codec(tokens.path("byte_bpe_multi_50k.tiktoken"), tokens.PATTERN)
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 50)
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 400)
    made = [prose(60, i) for i in range(40)]
    for text, ids in zip(made, codec.encode(made)):
        assert ids.tolist() == codec.library.encode_ordinary(text)


def test_packing_ids_equal_the_plain_call_on_added_tokens():
    import public_tokenizers as tokens
    from tokenizers import Tokenizer

    path = tokens.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    made = [
        "<|endoftext|>", "one <|endoftext|> two", "<|endoftext|><|endoftext|>\n", "<|endoftext", "x<|endoftext|>中文",
        "", "no token", "it's<|endoftext|>'s  <|endoftext|>  ", prose(40, "t") + "<|endoftext|>" + prose(40, "u"),
    ]
    made += [t for _, t in texts() if t]
    got = best_fit_packing.JsonCodec.of(path).encode(made)
    assert [x.tolist() for x in got] == [plain.encode(t, add_special_tokens=False).ids for t in made]
    assert 50256 in got[1].tolist() and 50256 not in got[3].tolist()


def test_packing_edges(spark, docs, empty):
    got = corpus_pipeline.packing(spark, docs, "").collect()
    assert {r["doc_id"] for r in got} == {i for i, _ in texts()}
    assert [r["length"] for r in got if r["doc_id"] == 5] == [1]
    assert sum(r["doc_id"] == 20 and r["piece"] == 0 for r in got) == 2
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) <= 1024
    assert corpus_pipeline.packing(spark, empty, "").count() == 0


def pieces_of(plan, capacity):
    used = np.zeros(capacity + 1, dtype=np.int64)
    for config, times in plan:
        assert sum(s * n for s, n in config.items()) <= capacity and times > 0
        for s, n in config.items():
            used[s] += n * times
    return used


def test_program_uses_every_piece_once_and_packs_tightly():
    r = np.random.default_rng(3)
    cases = (
        r.integers(1, 65, 5000), r.choice([20, 23, 41, 64], 900), np.array([64] * 7),
        np.array([33, 33, 33, 31, 31]), np.array([], dtype=int), np.array([1]), np.array([60] * 50 + [3] * 20),
    )
    for sizes in cases:
        counts = np.bincount(sizes, minlength=65).astype(np.int64)
        cover = best_fit_packing.solve_program(counts, 64)
        assert (cover.covered >= counts - 1e-6).all()  # the solution is feasible
        assert len(sizes) == 0 or cover.gap >= -1e-9
        plan, program = best_fit_packing.best_plan(counts, 64)
        assert (pieces_of(plan, 64) == counts).all()
        plain = best_fit_packing._filled([], counts.copy(), 64)
        assert (pieces_of(plain, 64) == counts).all()
        total = best_fit_packing.sequences(plan)
        assert program <= total <= best_fit_packing.sequences(plain)
        bound = -(-int(sizes.sum()) // 64)
        assert total <= max(bound + 2, 1.1 * bound, (sizes > 32).sum() + 2)
    best = best_fit_packing.best_configuration(np.array([0, 0, 3.0, 5.0, 0, 0, 0]), 6)
    assert best == {3: 2}


def test_program_packs_most_sequences_of_the_table(spark):
    """The histogram of sf0.1: the cover's gap, and how many sequences come from the program."""
    import public_tokenizers as tokens

    ship_package(spark)
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    path = tokens.path("byte_bpe_50k.json")
    cut = table.repartition(8).mapInArrow(best_fit_packing._tokenise(path, 2, 1024), best_fit_packing.PIECES)
    counts = np.zeros(1025, dtype=np.int64)
    for row in cut.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    cover = best_fit_packing.solve_program(counts, 1024)
    assert (cover.covered >= counts - 1e-6).all() and cover.gap < 0.03
    plan, program = best_fit_packing.best_plan(counts, 1024)
    total, alone = best_fit_packing.sequences(plan), int(counts[1024])
    assert (pieces_of(plan, 1024) == counts).all()
    bound = -(-int((counts * np.arange(1025)).sum()) // 1024)
    assert total <= bound + 5 and total <= best_fit_packing.sequences(best_fit_packing._filled([], counts.copy(), 1024))
    assert program > 0.5 * total and program > alone  # full pieces are not all of it


# ---- archives -----------------------------------------------------------------------------


def test_archives_round_trip(spark, docs, tmp_path):
    rows = [
        (1, "http://a/x y", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, None, None), (4, "http://a/4", ""),
        (5, "http://a/5", "WARC/1.1\r\n\r\nURL 0 0 0 5\n\n" * 3), (None, "http://a/6", "<p>one</p>"),
        (7, "http://a/7", "é中\U0001f600" * 50_000), (2, "http://a/2", "<p>one</p>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    arc, warc = f"{tmp_path}/arc", f"{tmp_path}/warc"
    arc_to_warc.write_arc(pages, arc)
    marked = arc_to_warc.mark_revisits(arc_to_warc.convert(spark, arc))
    arc_to_warc.write_warc(marked, warc)
    back = arc_to_warc.read_warc(spark, warc).withColumn("first", arc_to_warc.page_of("refers_to_id"))
    got = back.filter("record_type <> 'warcinfo'").collect()
    want = []
    for page, _, html in rows:
        raw = (html or "").encode()
        equal = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        again = page is not None and page != min(equal)
        want.append((page, len(raw), arc_to_warc.sha1_base32(raw), "revisit" if again else "response", min(equal) if again else None))
    key = lambda t: tuple(str(x) for x in t)
    have = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["first"]) for r in got]
    assert sorted(have, key=key) == sorted(want, key=key)
    ids = [r["record_id"] for r in got if r["page_id"] not in (2,)]
    assert len(set(ids)) == len(ids)
    large = arc_to_warc.mark_revisits(arc_to_warc.convert(spark, arc), min_bytes=5)
    assert {r["page_id"] for r in large.filter("record_type = 'revisit'").collect()} == {2}
    none = f"{tmp_path}/none"
    arc_to_warc.write_arc(pages.limit(0), none)
    assert arc_to_warc.convert(spark, none).filter("kind = 'response'").count() == 0


def test_arc_versions_and_truncation():
    for version in (1, 2):
        block = arc_to_warc._version_block(version, "f.arc", "2020")
        one = arc_to_warc._arc_record(version, "http://a/", "20200102030405", "text/html", b"HTTP/1.1 200 OK\r\n\r\nbody\n\nx", 0, "f")
        content = block + b"\n" + one + b"\n" + one[:-3]
        records = [arc_to_warc.warc_fields(r) for r in arc_to_warc.parse_arc(content)]
        assert [r[1] for r in records] == ["warcinfo", "response", "response"]
        assert records[1][4] == "2020-01-02T03:04:05Z" and records[1][8] == b"body\n\nx"
        assert [r[6] for r in records] == [False, False, True]
    with pytest.raises(ValueError):
        list(arc_to_warc.parse_arc(b"http://a/ what is this\n"))


# ---- repeats and near duplicates ------------------------------------------------------------


def brute_repeats(rows, width):
    first = {}
    for i, text in rows:
        w = words_of(text)
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, text in rows:
        w = words_of(text)
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < i:
                gone.update(range(k, k + width))
        out[i] = (len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest())
    return out


@pytest.mark.parametrize("tree, block", [(4 << 20, 2 << 20), (1 << 10, 300)])
def test_repeats_against_brute_force(docs, monkeypatch, tree, block):
    """Also with trees and blocks so small that every prefix length is used."""
    monkeypatch.setattr(suffix_tree_dedup, "TREE_SUFFIXES", tree)
    monkeypatch.setattr(suffix_tree_dedup, "BLOCK_WORDS", block)
    cut = suffix_tree_dedup.remove_repeats(docs, joined=True)
    got = {r["doc_id"]: r for r in cut.collect()}
    want = brute_repeats(texts(), 13)
    names = (suffix_tree_dedup.N_WORDS, suffix_tree_dedup.N_REMOVED)
    have = {i: (r[names[0]], r[names[1]], hashlib.sha256(r["text"].encode()).hexdigest()) for i, r in got.items()}
    assert have == want
    assert got[2]["n_words"] == "n" and got[2]["bucket"] == "b"  # columns of the same name are carried


def test_forest_places_equal_windows_together():
    r = np.random.default_rng(2)
    words = r.integers(0, 5, 4000).astype(np.uint64)
    block = suffix_tree_dedup.Block(words, np.array([2500, 1500]), np.array([7, 3]), 13)
    counts = np.stack([
        np.bincount((block.prefix(n, n) >> suffix_tree_dedup._SHIFT).astype(np.int64), minlength=1 << 14) for n in (1, 2, 4, 8)
    ])
    forest = suffix_tree_dedup.Forest(counts, (1, 2, 4, 8), 300)
    leaf = block.prefix(13, 101)
    tree = forest.place(block, leaf)
    assert tree.min() >= 0 and tree.max() < forest.size
    for value in np.unique(leaf)[:200]:
        assert len(set(tree[leaf == value])) == 1


def test_text_keeps_its_white_space_outside_repeats(spark, docs):
    rows = corpus_pipeline.repeated_passages(spark, docs, "").collect()
    got = {r["doc_id"]: r for r in rows}
    assert got[13]["text"] == " ".join(texts()[12][1].split()[60:])
    assert got[1]["text"] == texts()[0][1] and got[5]["text"] is None and got[7]["text"] == " \t\n "
    assert got[2]["text"] == "" and got[2]["n_chars"] == 0 and got[1]["n_chars"] == len(texts()[0][1])


def shingles(text):
    w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return set()
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} or {tuple(w)}


def brute_classes(rows, percent):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_classes_against_brute_force(spark, docs, empty):
    base = prose(150, "near").split()
    r = random.Random(6)
    extra = []
    for k in range(60):  # a cloud of near copies, some linked only through others
        w = list(base)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = r.choice(VOCABULARY)
        extra.append((100 + k, " ".join(w)))
    rows = spark.createDataFrame(extra, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    got = grouped_prefix_join.similar_classes(rows, 90)
    have = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in got.collect()}
    assert have == brute_classes(extra + texts(), 90)
    assert got.count() == len(extra) + len(texts())
    assert grouped_prefix_join.similar_classes(empty, 90).count() == 0


def test_classes_keep_rows_without_doc_id(spark):
    """They come back as the SQL gives them: no shingles counted, no class."""
    import duckdb

    same = prose(40, "unnamed")
    rows = [(1, same), (2, same), (3, None), (None, same), (None, same), (None, None), (None, "two words")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ship_package(spark)
    got = [tuple(r) for r in grouped_prefix_join.similar_classes(frame).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.execute(grouped_prefix_join.SQL).fetchall()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, want))


def thue_morse():
    """Two words of 1,024 letters that collide in every polynomial hash modulo 2 ** 64."""
    word = "a"
    swap = str.maketrans("ab", "ba")
    for _ in range(10):
        word += word.translate(swap)
    return word, word.translate(swap)


def test_words_that_collide_in_polynomial_hashes_are_told_apart(spark):
    import duckdb

    ship_package(spark)
    a, b = thue_morse()
    tail = prose(30, "tail")
    rows = [(1, a), (2, b), (3, f"{a} " + " ".join([a] * 13)), (4, f"{b} " + " ".join([b] * 13)), (5, f"{a} {tail}"), (6, f"{b} {tail}")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    got = sorted(map(tuple, grouped_prefix_join.similar_classes(frame).collect()))
    assert got == sorted(con.execute(grouped_prefix_join.SQL).fetchall())
    cut = suffix_tree_dedup.remove_repeats(frame, joined=True).select(
        "doc_id", suffix_tree_dedup.N_WORDS, suffix_tree_dedup.N_REMOVED, F.sha2("text", 256)
    )
    assert sorted(map(tuple, cut.collect())) == sorted(con.execute(suffix_tree_dedup.SQL).fetchall())
    cps = bpe.code_points(a + b)
    keys = bpe.piece_keys(cps, np.array([0, len(a)]), np.array([len(a), 2 * len(a)]))
    assert keys[0] != keys[1]


def test_hit_table_never_calls_a_shared_shingle_lonely(spark):
    ship_package(spark)
    r = random.Random(5)
    rows = [(i, " ".join(r.choice(VOCABULARY[:40]) for _ in range(30))) for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    import pyarrow as pa

    sets = {i: found for i, found in grouped_prefix_join.shingle_sets(pa.array([t for _, t in rows]), 3)}
    times = {}
    for found in sets.values():
        for x in found.tolist():
            times[x] = times.get(x, 0) + 1
    tokens = np.array(sorted(times), dtype=np.uint64)
    for bits in (16, 18):
        table = grouped_prefix_join.hit_table(frame, 1 << (bits - 1), 3, bits)
        kind = table.kind(tokens)
        count = np.array([times[x] for x in tokens.tolist()])
        assert table.bits == bits
        assert (kind[count > 1] > 0).all() and (kind[count > 3] > 1).all() and (kind[count > 32] == 3).all()
        assert (kind[count == 1] == 0).mean() > 0.9


def test_several_texts_of_one_doc_id(spark):
    ship_package(spark)
    same, other = prose(40, "p"), prose(40, "q")
    rows = [(1, same), (2, min(same, other)), (2, max(same, other)), (2, max(same, other)), (3, other)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, grouped_prefix_join.similar_classes(frame).collect()))
    match = 1 if min(same, other) == same else 3
    first = {1: 1, 2: min(2, match), 3: 3 if match == 1 else 2}
    assert [(d, c) for d, _, c in got] == [(1, first[1]), (2, first[2]), (2, first[2]), (2, first[2]), (3, first[3])]
    kept = grouped_prefix_join.one_of_each(frame).select("doc_id").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(first.values()))


def test_components_on_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(20, 60)] + [(1, k) for k in range(100, 140)] + [(5, 5), (140, 139)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r["id"]: r["component"] for r in components.components(frame).collect()}
    assert {got[i] for i in range(20, 61)} == {20} and {got[i] for i in (1, *range(100, 141))} == {1}
    assert components.components(frame.limit(0)).count() == 0


# ---- neighbours -------------------------------------------------------------------------------


def test_neighbours_edges(spark):
    r = np.random.default_rng(8)
    vectors = {i: r.normal(size=8).astype(np.float32).tolist() for i in range(300)}
    for i in range(40, 80):  # a vector that many rows share, queries among them
        vectors[i] = vectors[40]
    odd = {300: None, 301: [0.0] * 8, 302: [float("nan")] * 8, 303: [None] * 8, 304: [float("inf")] * 8, 305: [1.0] * 3, 306: []}
    rows = [(i, v, "x") for i, v in {**vectors, **odd}.items()]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, bucket string").repartition(4)
    ask = frame.filter("vec_id % 20 = 0")
    got = {}
    for x in multiprobe_lsh.neighbours(frame, ask, "vec_id", "embedding").collect():
        got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    x = np.array([vectors[i] for i in range(300)], dtype=np.float64)
    hit = 0
    for q in range(0, 300, 20):
        distance = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        distance[q] = np.inf
        best = np.lexsort((np.arange(300), distance))[:10]
        own = sorted(got[q])
        assert [k for k, _, _ in own] == list(range(1, 11))
        if q in (40, 60):  # ties go to the smallest ids
            assert [v for _, v, _ in own] == best.tolist()
        hit += len(set(best.tolist()) & {v for _, v, _ in own})
    assert set(got) == set(range(0, 300, 20)) and hit >= 0.9 * 150
    few = frame.filter("vec_id < 4")
    small = multiprobe_lsh.neighbours(few, few.filter("vec_id = 0"), "vec_id", "embedding").collect()
    assert sorted(v["vec_id"] for v in small) == [1, 2, 3]
    assert multiprobe_lsh.neighbours(frame.limit(0), frame.limit(0), "vec_id", "embedding").count() == 0


def test_neighbours_with_repeated_rows(spark):
    """A row that is repeated 20 times hides no other id, as neighbour or as query."""
    r = np.random.default_rng(5)
    vectors = {i: r.normal(size=8).astype(np.float32).tolist() for i in range(60)}
    for i in range(10, 30):  # one vector
        vectors[i] = vectors[10]
    rows = [(i, v) for i, v in vectors.items()] + [(i, vectors[i]) for i in (10, 3) for _ in range(19)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = {}
    for x in multiprobe_lsh.neighbours(frame, frame.filter("vec_id in (3, 10, 25)"), "vec_id", "embedding").collect():
        got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    assert [v for _, v, _ in sorted(got[10])] == list(range(11, 21))
    assert [v for _, v, _ in sorted(got[25])] == list(range(10, 20))
    assert [k for k, _, _ in sorted(got[3])] == list(range(1, 11)) and len({v for _, v, _ in got[3]}) == 10
    assert all(score == 0 for q in (10, 25) for _, _, score in got[q])


# ---- the pipeline --------------------------------------------------------------------------------


def test_pipeline_stages_against_brute_force(spark, docs):
    current = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in current.collect()}
        current = corpus_pipeline.stored(spark, stage(spark, current, ""), "test-stage")
        rows = current.collect()
        if name != "best-fit packing":
            assert current.columns == docs.columns
        kept = {r["doc_id"] for r in rows}
        if name == "quality rules":
            want = set()
            for i, t in before.items():
                m = dict(zip(quality_rules.MEASURES, brute_measures(t) if len(t or "") < 50_000 else (1000, 5000, 0, 1, 0, 0, 0)))
                n, chars = m["n_words"], m["word_chars"]
                bad = n < 10 or 100 * m["n_repeat_words"] > 20 * n or 100 * m["n_symbols"] > 10 * chars
                bad |= 100 * m["n_dup_lines"] > 60 * m["n_lines"] or chars > 30 * n or chars < n + n // 4
                if not (bad or 100 * m["n_upper"] > 50 * chars):
                    want.add(i)
            assert kept == want
        elif name == "language identification":
            assert kept == {i for i, t in before.items() if any(c.isalpha() for c in t)}
        elif name == "n-gram Jaccard join":
            classes = brute_classes(list(before.items()), 90)
            assert kept == {i for i, (_, c) in classes.items() if i == c}
        elif name == "substring dedup":
            want = {i: n for i, (_, _, n) in brute_repeats(list(before.items()), 13).items()}
            assert {r["doc_id"]: hashlib.sha256(" ".join(words_of(r["text"])).encode()).hexdigest() for r in rows} == want
        else:
            assert kept == set(before) and sum(r["piece"] == 0 for r in rows) == len(before)


def brute_five_word_classes(rows, percent):
    sets = {}
    for i, text in rows:
        w = words_of(text.lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}
    low = {i: i for i in sets}
    linked = [
        (a, b) for a in sets for b in sets
        if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    for _ in sets:
        for a, b in linked:
            low[a] = low[b] = min(low[a], low[b])
    return low


def test_pipeline_joins_on_five_words_and_80_per_cent(spark):
    """Near copies with a five-word similarity over 0.8, but under 0.9 on three words."""
    rows = []
    for k in range(12):
        w = prose(200, f"five{k}").split()
        rows.append((100 * k, " ".join(w)))
        for m in (6, 10, 14, 17, 19, 24, 40):  # a run of other words
            rows.append((100 * k + m, " ".join([*w[:80], *prose(m, f"run{k}-{m}").split(), *w[80 + m :]])))
        v = list(w)
        for at in (20, 70, 120, 170):
            v[at] = "other"
        rows.append((100 * k + 50, " ".join(v)))
    rows += [(2000, "one two three four"), (2001, "One two three four"), (2002, "one two three")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ship_package(spark)
    got = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, frame, "").collect()}
    five = {i for i, c in brute_five_word_classes(rows, 80).items() if i == c}
    three = {i for i, (_, c) in brute_classes(rows, 90).items() if i == c}
    assert len(five) < len(three)
    assert got == five


def test_pipeline_keeps_texts_that_no_label_can_be_learned_from(spark, docs):
    """lang is null throughout, or labels only held-out rows."""
    letters = {i for i, t in texts() if any(c.isalpha() for c in t or "")}
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    held = kernel_langid.held_out("doc_id", kernel_langid.FOLDS, kernel_langid.HELD)
    only_held = docs.withColumn("lang", F.when(held, F.lit("xx")))
    for table in (unlabelled, only_held):
        kept = corpus_pipeline.language(spark, table, "")
        assert kept.schema == table.schema
        rows = kept.collect()
        assert {r["doc_id"] for r in rows} == letters
        assert {r["doc_id"]: r["text"] for r in rows} == {i: t for i, t in texts() if i in letters}
        assert sum(r["doc_id"] == 20 for r in rows) == 2
    current = unlabelled
    for name, stage in corpus_pipeline.STAGES:
        current = corpus_pipeline.stored(spark, stage(spark, current, ""), "test-unlabelled")
        assert current.count() > 0, name


def test_pipeline_stages_with_clashing_and_dotted_names(spark):
    """Columns named like the stages' own ones, and names with dots, come through unchanged."""
    ship_package(spark)
    schema = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, `__n_words` long, "
    schema += "`__n_removed` string, `__bucket` string, bucket int, `row` string, predicted string, `text.x` int"
    body = [prose(80, f"dots{i}") for i in range(6)]
    body[3] = body[2]
    body[5] = body[4] + " " + body[0]
    rows = [(i, t, "xx" if i % 4 else "yy", "s", len(t), "dot", -1, "r", "b", 7, "w", "p", i) for i, t in enumerate(body)]
    rows.append((None, prose(80, "none"), None, "s", 1, "dot", -1, "r", "b", 7, "w", "p", 9))
    docs = spark.createDataFrame(rows, schema).repartition(2)
    names = [f.name for f in docs.schema]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert [f.name for f in out.schema] == names
        got = {r[0]: r for r in out.collect()}
        assert got and all(tuple(r)[5:12] == ("dot", -1, "r", "b", 7, "w", "p") for r in got.values())
        assert all(r[12] == (9 if d is None else d) for d, r in got.items())
    joined = {r[0] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert joined == {0, 1, 2, 4, 5, None}
    cut = {r[0]: r for r in corpus_pipeline.repeated_passages(spark, docs, "").collect()}
    assert cut[3][1] == "" and cut[3][4] == 0 and cut[5][1] == "" and cut[0][1] == body[0]
    assert corpus_pipeline.packing(spark, docs, "").count() == len(rows)


def test_pipeline_on_an_empty_table(spark, empty):
    current = empty
    for _, stage in corpus_pipeline.STAGES:
        current = corpus_pipeline.stored(spark, stage(spark, current, ""), "test-empty")
    assert current.count() == 0
