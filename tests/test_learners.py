"""Learners against closed forms, exhaustive searches and themselves on one block."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobsheet.operators import boosting as B
from jobsheet.operators import learners as LR
from jobsheet.operators import matrix as M
from jobsheet.operators.linear import fit_linear

SCHEMA = "order_id long, split string, labels array<double>, idx array<int>, val array<double>"


def data(n=700, d=12, seed=3):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, d)) * (rng.random((n, d)) < 0.7)
    X[:, 9] = X[:, 4]  # equal columns
    X[:, :3] = np.round(X[:, :3], 1)
    z = 2 * X[:, 0] - X[:, 1] + X[:, 4] * X[:, 5] + rng.normal(scale=0.3, size=n)
    return X, np.stack([np.maximum(z, 0), np.abs(X[:, 2]) + 0.1 * rng.random(n)], 1)


def frame(spark, X, Y, split="train"):
    rows = [(k, split, [float(v) for v in y], [int(j) for j in np.flatnonzero(x)], [float(v) for v in x[np.flatnonzero(x)]]) for k, (x, y) in enumerate(zip(X, Y))]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def blocks(spark):
    X, Y = data()
    return M.row_blocks(frame(spark, X, Y), 2, len(X)).repartition(3).persist()


def occurs(k, w=2.0):
    return lambda labels: ((labels[:, k] > 0).astype(float), np.where(labels[:, k] > 0, w, 1.0))


def hours(k):
    return lambda labels: (labels[:, k], (labels[:, k] > 0).astype(float))


def columns(*parts):
    def weigh(labels):
        both = [p(labels) for p in parts]
        return np.stack([y for y, _ in both], 1), np.stack([w for _, w in both], 1)
    return weigh


@pytest.mark.parametrize("together", [0, 10**9])
def test_ridge_matches_closed_form(blocks, together):
    X, Y = data()
    found = fit_linear(blocks, "squared", X.shape[1], np.array([10.0, 3.0]), columns(hours(0), hours(1)), together=together, tol=1e-9)
    for k, alpha in ((0, 10.0), (1, 3.0)):
        used = Y[:, k] > 0
        Xc, yc = X[used] - X[used].mean(0), Y[used, k] - Y[used, k].mean()
        w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(X.shape[1]), Xc.T @ yc)  # the intercept isn't penalised
        assert np.allclose(found[k].weights, w, atol=1e-6)
        assert found[k].intercept == pytest.approx(Y[used, k].mean() - X[used].mean(0) @ w, abs=1e-6)


@pytest.mark.parametrize("together", [0, 10**9])
def test_logistic_matches_penalised_optimum(blocks, together):
    X, Y = data()
    d = X.shape[1]
    found = fit_linear(blocks, "logistic", d, np.array([1.0, 0.5]), columns(occurs(0), occurs(0, 5.0)), together=together)
    for model, pos, pen in ((found[0], 2.0, 1.0), (found[1], 5.0, 0.5)):  # Newton iterations
        y = (Y[:, 0] > 0).astype(float)
        wts, Z, beta = np.where(y > 0, pos, 1.0), np.hstack([X, np.ones((len(X), 1))]), np.zeros(d + 1)
        for _ in range(50):
            p = 1 / (1 + np.exp(-Z @ beta))
            g = Z.T @ (wts * (p - y)) + np.r_[pen * beta[:d], 0]
            beta -= np.linalg.solve((Z * (wts * p * (1 - p))[:, None]).T @ Z + np.diag([pen] * d + [0]), g)
        assert np.allclose(model.weights, beta[:d], atol=1e-4) and model.intercept == pytest.approx(beta[d], abs=1e-4)


def test_linear_without_rows_or_variance(spark):
    X = np.ones((30, 2))
    b = M.row_blocks(frame(spark, X, np.zeros((30, 1))), 1, 30)
    for together in (0, 10**9):
        m = fit_linear(b, "squared", 2, np.array([1.0]), columns(hours(0)), together=together)[0]
        assert m.intercept == 0 and not m.weights.any()


SPECS = [B.Spec("binary", occurs(0), 20), B.Spec("l2", hours(1), 10), B.Spec("l1", hours(1), 10)]


def test_trees_apart_equal_trees_together(blocks):
    X, _ = data()
    full = np.arange(X.shape[1])
    one, many = (B.fit_trees(blocks, len(X), X.shape[1], SPECS, settings=B.Settings(rounds=12, leaves=7, batch=3), together=t) for t in (10**9, 0))
    for a, b in zip(one, many):
        assert np.allclose(a.predict(X, full), b.predict(X, full), atol=1e-4)
        assert len(a.roots) == len(b.roots) == 12 and 12 * 2 <= (a.feature < 0).sum() <= 12 * 7


def test_first_split_is_the_best_of_all(blocks):
    X, Y = data()
    y = (Y[:, 0] > 0).astype(float)
    w = np.where(y > 0, 2.0, 1.0)
    m = B.fit_trees(blocks, len(X), X.shape[1], SPECS[:1], most_bins=lambda f: 10_000, settings=B.Settings(rounds=1, leaves=2))[0]
    p = (w * y).sum() / w.sum()
    assert m.base == pytest.approx(np.log(p / (1 - p)))
    g, h = w * (p - y), w * p * (1 - p)
    best = (-1, 0, 0)
    for f in range(X.shape[1]):
        u = np.unique(X[:, f])
        for cut in (u[:-1] + u[1:]) / 2:
            left = X[:, f] <= cut
            hl, hr = h[left].sum(), h[~left].sum()
            if min(np.rint(hl * len(y) / h.sum()), np.rint(hr * len(y) / h.sum())) >= 20:
                best = max(best, (g[left].sum() ** 2 / hl + g[~left].sum() ** 2 / hr - g.sum() ** 2 / h.sum(), -f, cut))
    gain, f, cut = best
    assert (m.feature[0], m.cut[0]) == (-f, pytest.approx(cut)) and m.gain[0] == pytest.approx(gain, rel=1e-4)
    left = X[:, -f] <= cut
    assert m.value[m.left[0]] == pytest.approx(-0.05 * g[left].sum() / h[left].sum(), rel=1e-4)


def test_absolute_loss_uses_medians(blocks):
    X, Y = data()
    m = B.fit_trees(blocks, len(X), X.shape[1], SPECS[2:], settings=B.Settings(rounds=1, leaves=4))[0]
    used = Y[:, 1] > 0
    assert m.base == pytest.approx(np.median(Y[used, 1]))
    leaf = m.raw(X, np.arange(X.shape[1])) - m.base
    for v in np.unique(leaf[used]):
        assert v == pytest.approx(0.05 * np.median(Y[used & (leaf == v), 1] - m.base), abs=1e-9)


def test_equal_and_unsplittable_features_are_left_out(blocks):
    X, _ = data()
    cuts = B.find_cuts(blocks, len(X), lambda f: 63)
    kept = B.choose_features(blocks, cuts, X.shape[1], 20)
    assert 4 in kept and 9 not in kept
    assert B.choose_features(blocks, cuts, X.shape[1], len(X)) == []


def test_cuts():
    assert B.cuts_of(np.array([1.0, 2.0, 4.0]), 0, 10).tolist() == [1.5, 3.0]
    assert B.cuts_of(np.array([-1.0, 2.0]), 5, 10).tolist() == [-0.5, 1.0]
    many = B.cuts_of(np.arange(1.0, 1001.0), 500, 16)
    assert 10 <= len(many) <= 15 and many[0] == 0.5


def test_weighted_median():
    for v in ([3.0], [1.0, 2.0], [5.0, 1.0, 3.0], [4.0, 1.0, 1.0, 9.0]):
        assert B.weighted_median(np.array(v), np.ones(len(v))) == np.median(v)


def test_fallbacks(spark):
    X, Y = data(40, 3 + 9)
    Y[:, 0] = 0.0
    Y[0, 0], Y[1, 0] = 4.0, 8.0
    Y[:, 1] = 0.0
    ts = LR.TrainingSet(frame(spark, X, Y), ["a", "b"], [str(k) for k in range(12)], 0)
    models = LR.fit_regressors(ts, [(t, k) for t in "ab" for k in ("ridge", "lgbm", "mean_fallback", "median_fallback")])
    assert {m.value for (t, _), m in models.items() if t == "a"} == {6.0} and {m.value for (t, _), m in models.items() if t == "b"} == {0.0}
    ts.close()


def test_ridge_auto_and_selection():
    models = {("t", "ridge"): 1, ("t", "ridge_wins"): 2}
    assert LR.ridge_auto("t", models, {("t", "ridge"): 2.0, ("t", "ridge_wins"): 2.0})[1] == "plain"
    assert LR.ridge_auto("t", models, {("t", "ridge"): None, ("t", "ridge_wins"): None})[1] == "plain"
    assert LR.ridge_auto("t", models, {("t", "ridge"): 2.0, ("t", "ridge_wins"): 1.9})[1] == "winsorised"
    assert LR.select_best_regressor({"ridge": 1.0, "lgbm": 1.0}) == "ridge" and LR.select_best_regressor({"ridge": None, "lgbm": 3.0}) == "lgbm"


def test_scores_thresholds_and_errors_are_those_of_the_models(spark):
    """Thresholds and MAE recomputed with numpy from the models' own scores."""
    X, Y = data()
    df = frame(spark, X, Y).withColumn("split", F.when(F.col("order_id") % 3 == 0, "val").otherwise("train"))
    ts = LR.TrainingSet(df, ["a", "b"], [str(k) for k in range(X.shape[1])], 0)
    val = np.arange(len(X)) % 3 == 0
    cfg = LR.LearnerConfig(gbt=B.Settings(rounds=10, leaves=5))
    full = np.arange(X.shape[1])
    for kind in ("lr", "lgbm"):
        clf = LR.fit_classifiers(ts, kind, cfg)
        for r in LR.tuned_thresholds(ts, clf).collect():
            k = ts.targets.index(r.target)
            p, y = clf[k].predict(X[val], full), Y[val, k] > 0
            f1 = [(2 * (y & (p >= t)).sum() / max(1, (y.sum() + (p >= t).sum())), -i) for i, t in enumerate(np.linspace(0.05, 0.95, 91))]
            best = max(f1)
            assert r.f1 == pytest.approx(best[0]) and r.threshold == pytest.approx(np.linspace(0.05, 0.95, 91)[-best[1]])
    reg = LR.fit_regressors(ts, [("a", "ridge"), ("b", "lgbm")], cfg)
    for (t, kind), mae in LR.val_maes(ts, reg).items():
        k = ts.targets.index(t)
        pos = val & (Y[:, k] > 0)
        assert mae == pytest.approx(np.abs(np.maximum(0, reg[t, kind].predict(X[pos], full)) - Y[pos, k]).mean())
    ts.close()


def test_model_queries_do_the_whole_job():
    from jobsheet.plans import q_models as Q
    assert (Q.LCFG.gbt.rounds, Q.LCFG.gbt.leaves, Q.LCFG.gbt.step, Q.LCFG.lr_max_iter) == (300, 31, 0.05, 1000)
    assert list(Q.VARIANTS) == ["baseline", "A_only", "B_only", "C_only", "A+C", "A+B+C"]
    assert set(Q.CFG.best_regressor) == set(Q.CFG.targets)


def test_linear_models_need_few_passes(blocks, monkeypatch):
    """The true curvature, not a memory of gradients, turns the steps."""
    from jobsheet.operators import linear as LI
    X, _ = data()
    passes, solve = [], LI._solve

    def counted(sums, *rest):
        def one(*a):
            passes.append(1)
            return sums(*a)
        return solve(one, *rest)
    monkeypatch.setattr(LI, "_solve", counted)
    fit_linear(blocks, "squared", X.shape[1], np.array([10.0, 3.0]), columns(hours(0), hours(1)), together=0, tol=1e-9)
    assert len(passes) <= 4
    passes.clear()
    fit_linear(blocks, "logistic", X.shape[1], np.array([1.0, 0.5]), columns(occurs(0), occurs(0, 5.0)), together=0)
    assert len(passes) <= 30


def test_partitions_do_not_grow_with_small_blocks(spark):
    """each partition sends one set of sums, so there are about as many as cores, of many blocks."""
    n = 40 * M.BLOCK_ROWS
    df = spark.range(n).selectExpr("array(cast(id % 3 as int)) idx", "array(1.0D) val", "array(1.0D) labels")
    got = M.row_blocks(df, 1, n)
    assert got.getNumPartitions() <= max(spark.sparkContext.defaultParallelism, 2)
    assert got.map(lambda b: b.n).sum() == n


def test_a_model_of_few_rows_is_grown_in_one_task(blocks, monkeypatch):
    """a model's own rows decide, not those of all models."""
    X, _ = data()
    monkeypatch.setattr(B, "_Apart", None)
    weigh = hours(0)
    few = B.Spec("l2", lambda labels: (weigh(labels)[0], weigh(labels)[1] * (np.arange(len(labels)) < 50)), 5)
    bins = blocks.map(lambda b: len(b.value)).sum()
    assert B.fit_trees(blocks, len(X), X.shape[1], [few], settings=B.Settings(rounds=3, leaves=4), together=bins // 2)
