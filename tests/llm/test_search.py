"""Operators 11 to 13 against brute force, with nulls, ties, repeats, empty tables and clashing columns."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from jobsheet.llm import reversed_search, topk_search, whitening

VECTORS = "vec_id long, embedding array<float>, score long, x string, uid long, n int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 7, "x", 1, 2) for i, v in rows], VECTORS).repartition(3)


def some_vectors(n, d, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, d))
    x = centres[rng.integers(0, 6, n)] + 0.4 * rng.standard_normal((n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(k, [float(c) for c in v]) for k, v in enumerate(x.astype(np.float32))]


def fine(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def brute_top(rows, k):
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if i is not None and fine(v)]
    out = []
    for a, (i, v) in enumerate(kept):
        if i % 50 == 0:
            found = sorted((-sum(p * q for p, q in zip(v, u)), j) for b, (j, u) in enumerate(kept) if b != a)
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(found[:k], 1)]
    return sorted(out)


AWKWARD = [(0, None), (None, [1.0] * 40), (50, [0.5, None] * 20), (100, [float("nan")] * 40), (150, [float("inf")] + [0.0] * 39),
           (5000, [0.0] * 40), (5001, []), (5050, [0.25, 0.5])]


@pytest.mark.parametrize("limits", [{}, {"group_bytes": 20_000, "cells": 3}])
def test_top_k(spark, limits):
    rows = some_vectors(700, 40)
    rows += AWKWARD + [rows[100], rows[100], (9000, rows[100][1]), (8000, rows[100][1]), (3, rows[50][1])]
    got = topk_search.top_k(vectors(spark, rows), **limits)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 5)


def test_top_k_large_components_and_few_rows(spark):
    rows = [(0, [3e6, -2e6]), (1, [1e7, 5e6]), (50, [0.1, 0.2])]
    assert sorted(map(tuple, topk_search.top_k(vectors(spark, rows)).collect())) == brute_top(rows, 5)
    assert topk_search.top_k(vectors(spark, [(0, [1.0])])).collect() == []
    assert topk_search.top_k(vectors(spark, [])).collect() == []


def test_survivors_are_compacted_without_loss():
    rng = np.random.default_rng(1)
    x = np.floor(rng.standard_normal((64, 3000)) * 50 / (1 + np.arange(64))[:, None]).astype(np.int64)
    q = np.floor(rng.standard_normal((20, 64)) * 50).astype(np.int64)
    heaps = topk_search.Heaps(20, 6)
    for at in range(0, 3000, 500):
        topk_search.search_tile(topk_search.Tile(np.arange(at, at + 500), x[:, at:at + 500]), q, heaps)
    for row, s in enumerate(q @ x):
        best = sorted(zip((-s).tolist(), range(3000)))[:6]
        assert [(-a, b) for a, b in zip(heaps.score[row].tolist(), heaps.id[row].tolist())] == best


def test_whitening(spark):
    d = 12
    rows = some_vectors(600, d)
    rows += [rows[5], rows[5], (None, rows[7][1]), (900, None), (901, [None] + [0.0] * (d - 1)), (902, [float("nan")] * d), (903, [1.0]), (904, [])]
    df = vectors(spark, rows)
    model = whitening.fit(df, k=5)
    out = whitening.whitened_components(df, model).collect()
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if fine(v) and len(v) == d]
    listed = np.array(sorted({tuple(v) for _, v in kept}), np.int64)
    n, s = len(listed), listed.sum(0)
    y = (listed * n - s) / n
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1], u[:, ::-1]
    assert len(out) == 5 * len(kept) and {r.n for r in out} == {n}
    assert Counter(r.vec_id for r in out if r.component == 1) == Counter(i for i, _ in kept)
    sign = np.sign((u[:, :5] * model.vectors).sum(0))
    want = {(i, c + 1): (np.array(v) * n - s) / n @ u[:, c] * sign[c] / math.sqrt(e[c]) for i, v in kept for c in range(5)}
    dev = {i: sum((n * a - int(b)) ** 2 for a, b in zip(v, s)) for i, v in kept}
    for r in out:
        assert r.deviation == dev[r.vec_id]
        assert abs(r.whitened - want[r.vec_id, r.component]) < 1e-9
        assert abs(r.explained - e[r.component - 1] / e.sum()) < 1e-12
        assert r.identity_error < 1e-10
    full = whitening.whiten(df, model)
    assert {"score", "x", "uid", "n", "deviation", "whitened"} <= set(full.columns) and full.first().x == "x"


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3, [(1, []), (2, [])]])
def test_whitening_without_variance(spark, rows):
    df = vectors(spark, rows)
    assert whitening.whitened_components(df, whitening.fit(df)).collect() == []


def test_whitening_keeps_components_with_variance_only(spark):
    df = vectors(spark, [(k, [float(k), 2.0 * k, 5.0, float(k % 2)]) for k in range(20)])
    model = whitening.fit(df)
    assert len(model.values) == 2 and model.identity_error < 1e-9


def test_jacobi_davidson_locks_close_and_equal_eigenvalues():
    rng = np.random.default_rng(0)
    q = np.linalg.qr(rng.standard_normal((120, 120)))[0]
    e = np.concatenate([[9, 5, 5, 5, 4.0001, 4], np.linspace(3.9, 0, 114)])
    a = (q * e) @ q.T
    calls = []

    def product(v):
        calls.append(v.shape[1])
        return a @ v
    values, u = whitening.jacobi_davidson(product, 120, 8)
    assert np.abs(values - e[:8]).max() < 1e-12 and np.abs(u.T @ u - np.eye(8)).max() < 1e-12
    assert np.abs(a @ u - u * values).max() < 2e-13 and max(calls) < 30


def test_exact_integers_beyond_64_bits():
    x = np.array([[2**61, 5], [-(2**61), 6]], np.int64)
    y = whitening.centred(x, 2, whitening._sums(x))
    assert y.tolist() == [[2**62, -1], [-(2**62), 1]] and whitening._deviation(y) == [None, None]


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_rank(docs, items, k):
    def terms(t):
        return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, words = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    asked: dict = {}
    for i, t in items:
        asked.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, times in asked.items():
        found = []
        for i, c in counted:
            m = 75 + 25 * sum(c.values()) * n_docs // words
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 12 * m))
                        for w, q in times.items() if c[w])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def lexical_rows():
    rng = random.Random(2)
    vocab = [f"w{k}" for k in range(80)] + ["Ünï", "日本語", "x2Y", "ÀB"]
    docs = [(k, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))) for k in range(300)]
    docs += [(400, None), (401, ""), (402, "-- !? \n"), (7, docs[7][1]), (8, docs[9][1]), (None, docs[9][1]), (403, "w1 " * 20_000), (404, "W1_w2`w3")]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 12)))) for k in range(30)]
    items += [(3, "w5 w5 w6"), (50, None), (51, ""), (52, "unseen"), (None, "w1 W1 Ünï"), (53, "w1 w2 w3 w3")]
    return docs, items


@pytest.mark.parametrize("limits", [{}, {"block_postings": 60}])
def test_reversed_search(spark, limits):
    docs, items = lexical_rows()
    d = spark.createDataFrame([(i, t, 1, "a", 2) for i, t in docs], "doc_id long, text string, item_id int, term string, score int").repartition(5)
    b = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id int").repartition(2)
    got = reversed_search.rank_documents(d, b, k=6, **limits)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_rank(docs, items, 6)


def test_reversed_search_of_empty_tables(spark):
    docs, items = lexical_rows()
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert reversed_search.rank_documents(d.limit(0), b).collect() == []
    assert reversed_search.rank_documents(d, b.limit(0)).collect() == []
    assert reversed_search.rank_documents(d.where("doc_id = 400"), b).collect() == []


def test_scores_beyond_exact_doubles():
    index = reversed_search.Index([(b"a", 0, 10**9), (b"b", 0, 3)])
    table = reversed_search.scores(index, np.array([10_000, 7]), np.array([0, 0]), np.array([0, 1]), np.array([5, 1]), np.array([100]), 1)
    assert table.tolist() == [[10**9 * 10_000 * (5 * 10**9 // 6200) + 3 * 7 * (10**9 // 2200)]]
