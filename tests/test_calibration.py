"""Calibration and cross-validation against single-node versions."""

import numpy as np
import pytest

from jobsheet.operators import calibration as C


def rows(n=1500, seed=1):
    rng = np.random.default_rng(seed)
    p = np.round(rng.random(n), 2)  # many ties
    return p, (rng.random(n) < p ** 2).astype(int)


def pav(p, y):
    """The isotonic fit at each distinct score."""
    x = np.unique(p)
    blocks = [[y[p == v].sum(), (p == v).sum(), 1] for v in x]
    out = []
    for b in blocks:
        out.append(list(b))
        while len(out) > 1 and out[-2][0] / out[-2][1] >= out[-1][0] / out[-1][1]:
            b = out.pop()
            out[-1] = [u + v for u, v in zip(out[-1], b)]
    return x, np.concatenate([[t / w] * k for t, w, k in out])


def test_isotonic_equals_the_single_node_fit(spark):
    data = {g: rows(seed=s) for g, s in (("a", 1), ("b", 2))}
    df = spark.createDataFrame([(g, float(x), int(v)) for g, (p, y) in data.items() for x, v in zip(p, y)] + [("a", None, 1)], "target string, p double, y int").repartition(5)
    steps = C.isotonic(df)
    found = C.apply_isotonic(df.where("p IS NOT NULL").select("target", "p").distinct(), steps).collect()
    for g, (p, y) in data.items():
        x, want = pav(p, y)
        got = {r.p: r.calibrated for r in found if r.target == g}
        assert np.allclose([got[v] for v in x], want) and (np.diff([got[v] for v in x]) >= -1e-12).all()
    ends = C.apply_isotonic(spark.createDataFrame([("a", -1.0), ("a", 2.0)], "target string, p double"), steps).orderBy("p").collect()
    x, want = pav(*data["a"])
    assert [r.calibrated for r in ends] == pytest.approx([want[0], want[-1]])


def test_platt_is_the_most_likely_curve(spark):
    p, y = rows()
    df = spark.createDataFrame([("a", float(x), int(v)) for x, v in zip(p, y)] + [("one", 0.3, 1), ("one", 0.6, 1)], "target string, p double, y int")
    fit = C.platt(df)
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    a, b = fit["a"]
    q = 1 / (1 + np.exp(-(a * p + b)))
    assert abs(((q - t) * p).sum()) < 1e-6 and abs((q - t).sum()) < 1e-6 and a > 0
    assert np.isfinite(fit["one"]).all()


def test_ridge_folds_equal_refitting(spark):
    rng = np.random.default_rng(6)
    n, d = 300, 8
    X = rng.normal(size=(n, d)) * (rng.random((n, d)) < 0.6)
    y = np.maximum(X @ rng.normal(size=d) + 1 + 0.2 * rng.normal(size=n), 0)
    fold = rng.integers(0, 4, n)
    df = spark.createDataFrame([([0.0, float(v)], [int(j) for j in np.flatnonzero(x)], [float(c) for c in x[np.flatnonzero(x)]], int(f)) for x, v, f in zip(X, y, fold)],
                               "labels array<double>, idx array<int>, val array<double>, fold int").repartition(3)
    got = C.ridge_cross_validation(df, 1, "fold", d, [0.1, 10.0], 4, n)
    for alpha, rmse, _ in got:
        sse = 0.0
        for k in range(4):
            fit, out = (y > 0) & (fold != k), (y > 0) & (fold == k)
            Xc, yc = X[fit] - X[fit].mean(0), y[fit] - y[fit].mean()
            w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(d), Xc.T @ yc)
            sse += ((y[out] - (y[fit].mean() + (X[out] - X[fit].mean(0)) @ w)) ** 2).sum()
        assert rmse == pytest.approx(np.sqrt(sse / (y > 0).sum()), rel=1e-9)
