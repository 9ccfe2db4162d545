"""What the learners hold, write and pass over: vectors are made when read, sums are of the smaller child, scores are read once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobsheet.operators import boosting as B
from jobsheet.operators import calibration as C
from jobsheet.operators import learners as LR
from jobsheet.operators import linear
from jobsheet.operators import matrix as M
from jobsheet.operators import text as D

DOCS = ["Lackieren KOTFLÜGEL a+e", "hagel dellen  hagel", "", None, "x", "größe straße a+e c++ +b", "aaaa aaaa aaaa", "a b a b a b"]


def docs(spark):
    return spark.createDataFrame(list(enumerate(DOCS)), "id int, text string").repartition(2)


@pytest.mark.parametrize("grams,terms", [(lambda c: D.word_grams(c, 2), lambda c: D.word_ngrams(D.word_tokens(c), 2)),
                                         (lambda c: D.word_grams(c, 3), lambda c: D.word_ngrams(D.word_tokens(c), 3)), (D.char_grams, D.char_wb_ngrams)])
def test_terms_made_from_distinct_units_equal_those_of_columns(spark, grams, terms):
    d, c = docs(spark), F.col("text")
    assert sorted(map(tuple, D.gram_terms(d, grams(c)).collect())) == sorted(map(tuple, D.corpus_terms(d, terms(c)).collect()))
    fitted = D.fit_vocab(d, "id", grams(c), 1, 40)
    assert sorted(map(tuple, fitted.collect())) == sorted(map(tuple, D.fit_vocab(d, "id", terms(c), 1, 40).collect()))
    own, old = (sorted(map(tuple, D.transform_frozen(d, "id", t(c), fitted).collect())) for t in (grams, terms))
    assert own == old and len(own) > 20


def test_counting_and_sorting_give_the_same_cells():
    rng = np.random.default_rng(2)
    row, at = rng.integers(0, 30, 400), rng.integers(0, 50, 400)
    few, many = D.cells(row, at, 30, 50), D.cells(row, at * 10**6, 30, 50 * 10**6)
    assert (few[0] == many[0]).all() and (few[1] * 10**6 == many[1]).all() and (few[2] == many[2]).all() and few[2].sum() == 400


def training(spark):
    rows = [(k, "train" if k % 3 else "val", [float(k % 2), float(k % 5)], DOCS[k % len(DOCS)] or "", [float(k % 7), 0.0, 1.5]) for k in range(60)]
    d = spark.createDataFrame(rows, "order_id long, split string, labels array<double>, text string, num array<double>").repartition(3)
    v = [D.Vocabulary.of(D.fit_vocab(d, "order_id", g, 1, 30)) for g in (D.word_grams(F.col("text")), D.char_grams(F.col("text")))]
    texts, num = list(zip((D.word_grams(F.col("text")), D.char_grams(F.col("text"))), v)), [F.get("num", F.lit(j)) for j in range(3)]
    n = sum(len(x.terms) for x in v)
    return LR.TextTrainingSet(d, texts, num, ["a", "b"], [str(k) for k in range(n + 3)], n)


def dense(b, d):
    return np.concatenate([b.labels, b.dense(d)], 1)


def test_packed_blocks_are_the_vectors(spark):
    ts = training(spark)
    d = len(ts.features)
    own = np.concatenate([dense(b, d) for b in ts.blocks().collect()])
    old = np.concatenate([dense(b, d) for b in M.row_blocks(ts.split("train"), 2, 40).collect()])
    assert own.shape == old.shape == (40, d + 2)
    assert (own[np.lexsort(own.T)] == old[np.lexsort(old.T)]).all()
    with_id = np.concatenate([b.labels for b in ts.blocks_with(F.col("order_id")).collect()])
    assert sorted(with_id[:, 2]) == [k for k in range(60) if k % 3] and (with_id[:, 0] == with_id[:, 2] % 2).all()
    ts.close()


def test_folds_of_several_labels_equal_one_at_a_time(spark):
    ts = training(spark)
    d, fold = len(ts.features), F.pmod("order_id", F.lit(4))
    both = C.ridge_cross_validations(ts.blocks_with(fold), [0, 1], d, [1.0, 10.0], 4)
    for k in (0, 1):
        assert np.allclose(both[k], C.ridge_cross_validation(ts.split("train").withColumn("fold", fold), k, "fold", d, [1.0, 10.0], 4, 40))


def test_calibrated_scores_do_not_carry_the_steps(spark):
    s = spark.createDataFrame([("a", k / 50, int(k * k % 7 < k / 9)) for k in range(50)] + [("a", None, 0), ("b", 0.5, 1)], "target string, p double, y int")
    steps = C.isotonic(s.where("target = 'a'"))
    out = C.apply_isotonic(s, steps)
    assert "array" not in out._jdf.queryExecution().optimizedPlan().toString().lower().replace("mapinarrow", "")
    assert {r.calibrated for r in out.where("p IS NULL OR target = 'b'").collect()} == {None}
    lo, hi, v = np.array([0.1, 0.5]), np.array([0.2, 0.6]), np.array([1.0, 3.0])
    assert C._between(np.array([0.0, 0.1, 0.15, 0.35, 0.5, 0.9, np.nan]), lo, hi, v) == pytest.approx([1, 1, 1, 2, 3, 3, 3])


def grown(leaves, rounds=6, n=3000):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(n, 6)), 2) * (rng.random((n, 6)) < 0.6)
    trees, feature, cut, left, right, value, roots = [], [], [], [], [], [], []
    for _ in range(rounds):
        root = len(feature)
        roots.append(root)
        own = [root]
        feature.append(-1), cut.append(0.0), left.append(-1), right.append(-1), value.append(rng.normal())
        while len(own) < leaves:
            k = own.pop(rng.integers(len(own)))
            feature[k], cut[k], left[k], right[k] = int(rng.integers(6)), float(np.round(rng.normal(), 2)), len(feature), len(feature) + 1
            for _ in range(2):
                own.append(len(feature))
                feature.append(-1), cut.append(0.0), left.append(-1), right.append(-1), value.append(rng.normal())
    a = [np.array(c) for c in (feature, cut, left, right, value, [0.0] * len(feature), roots)]
    return x, M.Trees(0.3, a[0], a[1], a[2], a[3], a[4], a[5], a[6])


@pytest.mark.parametrize("leaves", [1, 7, 32, 33, 64, 65])
def test_masked_trees_equal_walked_trees(leaves):
    x, m = grown(leaves)
    x[0, :] = np.nan
    assert (m._masks() is None) == (leaves > 64)
    assert np.allclose(m.raw(x, np.arange(6)), m._walked(x, np.arange(6)))


def test_models_share_one_dense_block():
    x, trees = grown(9, n=50)
    models = [M.Linear(np.array([0.0, 2.0, 0, 0, -1.0, 0]), 0.5, True), trees, M.Constant(4.0)]
    first, index = np.concatenate([[0], np.cumsum((x != 0).sum(1))]), np.nonzero(x)[1]
    got = M.predictions(models, first, index, x[x != 0])
    assert np.allclose(got, np.stack([m.predict(x[:, m.used()], m.used()) for m in models], 1))


def test_only_the_smaller_child_is_added_up(spark, monkeypatch):
    rng = np.random.default_rng(1)
    n, d = 500, 5
    x = rng.normal(size=(n, d))
    blocks = [M.Rows(np.arange(0, n * d + 1, d), np.tile(np.arange(d, dtype=np.int32), n), x.ravel(), (x[:, :1] > 0.4) + 0.0)]
    rdd = spark.sparkContext.parallelize(blocks, 1)
    spec = B.Spec("l2", lambda y: (y[:, 0], np.ones(len(y))), 5)
    bins = B.Bins(B.find_cuts(rdd, n, lambda f: 20)).lay_out(range(d))
    part = B._of_model(B._bin_block(blocks[0], bins, [spec], np.zeros(1)), 0, int(bins.start[-1]))
    monkeypatch.setattr(B, "ADDED", 64)
    engine = B._Together([part], bins, spec, B.Settings(rounds=1, leaves=8))
    seen, sums = [], engine._sums
    engine._sums = lambda rows: seen.append(len(rows)) or sums(rows)
    B._rounds(engine, [spec], bins, B.Settings(rounds=1, leaves=8), np.zeros(1))
    assert seen[0] == n and sum(seen[1:]) <= n * 1.5 and max(seen[1:]) <= n // 2
    for k, hist in engine.hist.items():  # also where it was what is left of the parent's
        rows = engine.rows.get(k)
        if rows is not None:
            assert np.allclose(hist, sums(rows))


def test_estimated_curvature_leaves_the_optimum_alone(spark, monkeypatch):
    rng = np.random.default_rng(4)
    n, d = 6000, 6
    x = rng.normal(size=(n, d)) * (rng.random((n, d)) < 0.5)
    y = (x[:, 0] - x[:, 1] + rng.normal(size=n) > 0.3) + 0.0
    first = np.concatenate([[0], np.cumsum((x != 0).sum(1))])
    blocks = [M.Rows(first[lo:lo + 101] - first[lo], np.nonzero(x[lo:lo + 100])[1].astype(np.int32), x[lo:lo + 100][x[lo:lo + 100] != 0], y[lo:lo + 100, None]) for lo in range(0, n, 100)]
    rdd = spark.sparkContext.parallelize(blocks, 4)

    def fit():
        return linear.fit_linear(rdd, "logistic", d, np.array([1.0]), lambda v: (v, np.ones_like(v)), together=0)[0]
    whole = fit()
    monkeypatch.setattr(linear, "CURVE_ROWS", 800)
    few = fit()
    assert np.allclose(whole.weights, few.weights, atol=1e-5) and whole.intercept == pytest.approx(few.intercept, abs=1e-5)
