"""Whitening, hard negatives and byte-pair encoding against plain versions."""

import hashlib
import random
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given as prop, settings, strategies as st
from pyspark.sql import functions as F

from statcube.llm import bpe, hard_negatives, queries, whitening
from statcube.llm.bpe_automaton import END, byte_characters, compile_merges
from statcube.llm.hard_negatives import Packing
from statcube.llm.spectrum import count_above, leading

FOLDER = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the driver tables")
VECTORS = "vec_id long, embedding array<float>, label int"


# --- spectrum ------------------------------------------------------------------


def symmetric(kind, n):
    a = np.random.default_rng(n).standard_normal((n, n))
    q, _ = np.linalg.qr(a)
    return {
        "gram": a @ a.T, "double": q @ np.diag(np.r_[np.full(min(3, n), 5.0), np.linspace(1, 0.1, n)][:n]) @ q.T,
        "identity": np.eye(n), "one": np.outer(a[0], a[0]), "close": q @ np.diag(1 + 1e-9 * np.arange(n)) @ q.T, "indefinite": a + a.T,
    }[kind]


@pytest.mark.parametrize("n", [1, 2, 5, 40])
@pytest.mark.parametrize("kind", ["gram", "double", "identity", "one", "close", "indefinite"])
def test_leading_eigenvectors_equal_a_dense_solver(kind, n):
    v = symmetric(kind, n)
    v = (v + v.T) / 2
    k = min(4, n)
    values, vectors = leading(v, k)
    plain = np.linalg.eigvalsh(v)[::-1]
    size = np.abs(plain).max()
    assert np.abs(values - plain[:k]).max() <= 1e-13 * size
    assert np.abs(vectors @ vectors.T - np.eye(k)).max() <= 1e-13
    assert np.abs(vectors @ v - values[:, None] * vectors).max() <= 1e-13 * size


@prop(st.integers(1, 12), st.integers(0, 10**6), st.floats(-3, 3))
@settings(max_examples=60, deadline=None)
def test_counts_above_a_shift(n, seed, shift):
    a = np.random.default_rng(seed).integers(-3, 4, (n, n)).astype(float)
    a = a + a.T
    plain = np.linalg.eigvalsh(a)
    if np.abs(plain - shift).min() > 1e-9:
        assert count_above(a, shift) == (plain > shift).sum()


def test_no_variance_has_zero_values():
    values, vectors = leading(np.zeros((3, 3)), 3)
    assert (values == 0).all() and (vectors == np.eye(3)).all()


# --- whitening -------------------------------------------------------------------


def plain_whitening(rows, k=4):
    usable = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in rows
              if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    size = max(len(v) for _, v in usable)
    usable = [(i, v + [0] * (size - len(v))) for i, v in usable]
    fit = np.array(sorted({tuple(v) for _, v in usable}), float)
    n, sums = len(fit), fit.sum(axis=0)
    v = (fit - sums / n).T @ (fit - sums / n) / n
    values, vectors = np.linalg.eigh(v)
    out = {}
    for i, x in usable:
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(x, sums))
        for c in range(min(k, size)):
            e, q = values[::-1][c], vectors[:, ::-1][:, c]
            out.setdefault((i, c + 1), []).append((n, deviation, abs((np.array(x) - sums / n) @ q) / e**0.5, e / np.trace(v)))
    return out


def held_against_plain(df, rows):
    got = {}
    for r in df.collect():
        assert abs(r.identity_error) < 1e-9
        got.setdefault((r.vec_id, r.component), []).append((r.n, r.deviation, abs(r.whitened), r.explained))
    want = plain_whitening(rows)
    assert got.keys() == want.keys()
    for key, values in want.items():
        assert len(got[key]) == len(values)
        for a, b in zip(sorted(got[key]), sorted(values)):
            assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], abs=1e-9)


@given
def test_whitening_of_the_given_vectors(spark):
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    held_against_plain(queries.QUERIES["op11_whitening"](spark, FOLDER), rows)


def test_whitening_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) * (j + 1) for j in range(6)]) for i in range(60)]
    rows += [(100, None), (101, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (102, [float("nan")] * 6), (103, [float("inf")] + [0.0] * 5),
             (104, [0.5, 0.25]), (105, []), (106, rows[0][1]), (0, rows[0][1]), (None, rows[1][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], VECTORS).withColumn("x", F.lit("clash")).withColumn("n", F.lit(0))
    held_against_plain(whitening.whiten(df.repartition(3)), rows)


def test_whitening_without_variance_and_without_rows(spark):
    same = spark.createDataFrame([(i, [0.5, 0.5, 0.5], 0) for i in range(4)], VECTORS)
    rows = whitening.whiten(same).collect()
    assert len(rows) == 12 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in rows} == {(1, 0, None, None, 0.0)}
    line = spark.createDataFrame([(i, [float(i), 2.0 * i], 0) for i in range(5)], VECTORS)
    rows = whitening.whiten(line).collect()
    assert [r.whitened is None for r in sorted(rows, key=lambda r: (r.component, r.vec_id))] == [False] * 5 + [True] * 5
    assert rows[0].explained + rows[1].explained == pytest.approx(1)
    assert whitening.whiten(same.limit(0)).collect() == []
    assert whitening.whiten(same.limit(0)).schema.names == whitening.whiten(same).schema.names


def test_wide_deviations_stay_exact():
    x = np.array([[2**40, -3], [5, 7]])
    sums = np.array([2**41, 1])
    want = [sum((10**6 * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    assert whitening._deviation(x, 10**6, sums, False) == [v if v < 2**63 else None for v in want]
    assert whitening._deviation(x[1:], 3, np.array([4, 5]), True) == [11**2 + 16**2]


# --- hard negatives ----------------------------------------------------------------


@prop(st.integers(1, 9), st.sampled_from([1, 5, 300, 2000, 10**7]), st.integers(0, 10**6))
@settings(max_examples=40, deadline=None)
def test_packed_products_are_exact(size, most, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-most, most + 1, (3, size)), rng.integers(-most, most + 1, (70, size))
    packing = Packing.of(size, int(min(a.min(), b.min())), int(max(a.max(), b.max())))
    left, right = packing.matrix(a.tolist()), packing.matrix(b.tolist())
    got = packing.scores(left, packing.pack(right), right.sum(axis=1), len(b))
    assert packing.fields > 1 and (got == a @ b.T).all()


def test_extreme_components_fill_their_fields():
    packing = Packing.of(64, -512, 511)
    assert not packing.wide and packing.fields == 2
    a, b = packing.matrix([[-512] * 64, [511] * 64]), packing.matrix([[511] * 64, [-512] * 64, [511] * 64])
    got = packing.scores(a, packing.pack(b), b.sum(axis=1), 3)
    assert got.tolist() == [[-512 * 511 * 64, 512 * 512 * 64, -512 * 511 * 64], [511 * 511 * 64, -512 * 511 * 64, 511 * 511 * 64]]


def plain_mining(rows, k=5):
    usable = [(i, lab, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, lab, v in rows
              if i is not None and lab is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for i, lab, v in usable:
        if i % 10 == 0:
            scored = sorted((-sum(x * y for x, y in zip(v, w)), j, m) for j, m, w in usable if j != i)
            for s, j, m in [t for t in scored if t[2] == lab][:k]:
                near = [t for t in scored if t[2] != lab and 80 * -s <= 100 * -t[0] <= 100 * -s][:k]
                out += [(i, j, r, t[1], -s, -t[0]) for r, t in enumerate(near, 1)]
    return sorted(out)


def mining_rows(n, size, scale=0.2, seed=4):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(3), [rng.gauss(0, scale) for _ in range(size)]) for i in range(n)]
    rows += [(n + i, rng.randrange(3), rows[7][2]) for i in range(n // 2)]  # one common vector
    return rows + [(3 * n, None, rows[0][2]), (None, 1, rows[0][2]), (3 * n + 10, 1, None), (3 * n + 20, 1, [None] * size),
                   (3 * n + 30, 2, [float("nan")] * size), (3 * n + 40, 0, [float("inf")] * size), (10, 1, rows[3][2]), (20, 2, rows[20][2]), (20, 2, rows[20][2])]


@pytest.mark.parametrize("shuffled", [False, True])
def test_mining_equals_brute_force(spark, monkeypatch, shuffled):
    if shuffled:
        monkeypatch.setattr(hard_negatives, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(hard_negatives, "ANCHORS", 4)
        monkeypatch.setattr(hard_negatives, "CANDIDATES", 16)
        monkeypatch.setattr(hard_negatives, "GROUP", 2)
    rows = mining_rows(80, 8)
    df = spark.createDataFrame([(i, v, lab) for i, lab, v in rows], VECTORS).withColumn("x", F.lit(1)).withColumn("block", F.lit(2))
    got = hard_negatives.mine(df.repartition(3), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == plain_mining(rows)


def test_mining_of_wide_components(spark):
    rows = mining_rows(30, 3, scale=5000.0)
    df = spark.createDataFrame([(i, v, lab) for i, lab, v in rows], VECTORS)
    assert sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") % 10 == 0).collect())) == plain_mining(rows)


def test_mining_of_nothing(spark):
    df = spark.createDataFrame([(1, [1.0], 1)], VECTORS)
    assert hard_negatives.mine(df, F.col("vec_id") % 10 == 0).collect() == []
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 10 == 0).collect() == []


# --- byte-pair encoding ---------------------------------------------------------------


def plain_encode(word, merges, end=None):
    """Merges in their order, each from left to right."""
    parts = list(word)
    if end and parts:
        parts[-1] += end
    for u, v in merges:
        out = []
        for p in parts:
            if out and out[-1] == u and p == v:
                out[-1] = u + v + "\0"  # this merge takes no token it has built
            else:
                out.append(p)
        parts = [p.removesuffix("\0") for p in out]
    return parts


def random_merges(rng, letters, n, end):
    tokens, merges, built = list(letters) + [c + end for c in letters if end], [], set()
    while len(merges) < n:
        u, v = rng.choice(tokens), rng.choice(tokens)
        if not (end and u.endswith(end)) and u + v not in built and u + v not in letters:
            merges.append((u, v))
            built.add(u + v)
            tokens.append(u + v)
    return merges


@pytest.mark.parametrize("end", ["</w>", ""])
@pytest.mark.parametrize("seed", range(8))
def test_automaton_paths_are_the_merges(seed, end):
    rng = random.Random(seed)
    merges = random_merges(rng, "ab" if seed % 2 else "abc", 25, end)
    base = byte_characters()
    labels = base + [c + end for c in base if end] + [u + v for u, v in merges]
    automaton = compile_merges({t: i for i, t in enumerate(labels)}, merges, end or None)
    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 14)))
        assert [labels[t] for t in automaton.encode(word.encode(), ends=bool(end))] == plain_encode(word, merges, end), (word, merges)


def test_vocabularies_that_no_training_makes_are_refused():
    base = byte_characters()
    with pytest.raises(ValueError):
        compile_merges({t: i for i, t in enumerate([*base, "ab", "abab"])}, [("ab", "ab"), ("a", "b")], None)
    with pytest.raises(ValueError):
        compile_merges({t: i for i, t in enumerate(base[1:])}, [], None)
    assert END == 256


@pytest.fixture(scope="module")
def words():
    public = pytest.importorskip("public_tokenizers")
    tokenizers = pytest.importorskip("tokenizers")
    path = public.path("word_bpe_49k.json")
    return bpe.read_vocabulary(path), tokenizers.Tokenizer.from_file(path)


ODD_TEXTS = [
    None, "", " \n\t ", "it's HERE, we'll 1234 don't", "<|endoftext|>é<|startoftext|>́x<|endoftext|", "ΑΣ ΣΑΣ'S 'LL it'Re",
    "\x1c\x1d a\x1eb᠎​ ﻿", "é ṩ ṩ ṩ", "İstanbul ǅ ß ﬁ", "日本語のテキスト한국어", "½ ² Ⅷ ٣", "😀👩‍👩‍👧 \U0001f600!!",
    "a" * 5000, "ab" * 3000 + " " + "!" * 2000, "࣓ͅ ᷷᳚", "\U00011935\U00011930",
]


def test_encoding_equals_the_library(spark, words):
    vocabulary, library = words
    rng = random.Random(9)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ODD_TEXTS + ["".join(chr(rng.choice(points) if rng.random() < 0.4 else rng.randrange(32, 0x250)) for _ in range(rng.randrange(12))) for _ in range(3000)]
    texts += ["".join(f"a{chr(c)}b 1{chr(c)}! " for c in points[k::700]) for k in range(0, 700, 7)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = bpe.decode_ids(bpe.encode_texts(df.repartition(4), vocabulary), vocabulary)
    assert got.columns == ["doc_id", "text", "ids", "decoded"]
    for r in got.collect():
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want, r.text
        assert r.decoded == library.decode(want, skip_special_tokens=False)


@given
def test_digests_of_the_given_documents(spark, words):
    _, library = words
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.QUERIES["op12_bpe"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_remembered_pieces_are_bounded(monkeypatch, words):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    encoder = bpe._Encoder(*words[0].tables())
    many = " ".join(f"word{i}" for i in range(50))
    assert np.frombuffer(encoder.text(many), np.int32).tolist() == words[1].encode(many, add_special_tokens=False).ids
    assert len(encoder.known) <= 3 and len(encoder.known_parts) <= 3


def test_decoding_bounds_its_blocks(spark, monkeypatch, words):
    vocabulary, library = words
    monkeypatch.setattr(bpe, "IDS_AT_ONCE", 4)
    rows = [(1, [320, 10, 49407]), (2, None), (3, []), (4, [5] * 11), (5, [7])]
    got = bpe.decode_ids(spark.createDataFrame(rows, "doc_id long, ids array<int>").coalesce(1), vocabulary).collect()
    assert {r.doc_id: r.decoded for r in got} == {i: library.decode(ids or [], skip_special_tokens=False) for i, ids in rows}
    assert bpe.decode_ids(spark.createDataFrame([], "ids array<int>"), vocabulary).collect() == []


def test_empty_table_of_texts(spark, words):
    assert bpe.encode_texts(spark.createDataFrame([], "doc_id long, text string"), words[0]).collect() == []
