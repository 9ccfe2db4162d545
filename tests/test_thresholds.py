"""Threshold sweeps vs a brute-force restatement of the tie rules."""

import random

import numpy as np
import pytest

from jobsheet.operators import thresholds as TH


def brute_f1(y, p):
    best_f1, best_t = -1.0, 0.5
    for thr in np.linspace(0.05, 0.95, 91):
        yp = [int(v >= thr) for v in p]
        tp = sum(a and b for a, b in zip(y, yp)); fp = sum((not a) and b for a, b in zip(y, yp))
        fn = sum(a and not b for a, b in zip(y, yp))
        f1 = 2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0
        if f1 > best_f1:
            best_f1, best_t = f1, thr
    return best_t, best_f1


def brute_rf(y, p, floor=0.9):
    best_pr, best_t, ok = -1, 0.01, False
    for thr in np.linspace(0.01, 0.99, 99):
        yp = [int(v >= thr) for v in p]
        tp = sum(a and b for a, b in zip(y, yp)); fp = sum((not a) and b for a, b in zip(y, yp))
        fn = sum(a and not b for a, b in zip(y, yp))
        rec = tp / (tp + fn) if tp + fn else 0.0
        pr = tp / (tp + fp) if tp + fp else 0.0
        if rec >= floor and pr > best_pr:
            best_pr, best_t, ok = pr, thr, True
    return best_t, ok


def brute_ap(y, p):
    pos = sum(y)
    if not pos:
        return 0.0
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        sel = [a for a, b in zip(y, p) if b >= t]
        tp = sum(sel)
        r, pr = tp / pos, tp / len(sel)
        ap += (r - prev_r) * pr
        prev_r = r
    return ap


def cases():
    rnd = random.Random(7)
    out = []
    for g in range(12):
        n = rnd.randint(1, 60)
        y = [int(rnd.random() < 0.3) for _ in range(n)]
        p = [round(rnd.random(), 2) if g % 3 else rnd.choice([0.05, 0.35, 0.5, 0.95, 0.0, 1.0]) for _ in range(n)]
        out.append((f"g{g}", y, p))
    out.append(("allzero", [0, 0, 0], [0.9, 0.2, 0.5]))       # all F1 = 0 -> 0.05
    out.append(("ties", [1, 1, 0, 0], [0.6, 0.6, 0.1, 0.1]))  # many tied thresholds -> lowest
    out.append(("floor", [1, 0, 0, 0], [0.0, 0.9, 0.9, 0.9]))  # recall floor unreachable above 0
    return out


@pytest.fixture(scope="module")
def scores(spark):
    rows = [(g, yy, pp) for g, y, p in cases() for yy, pp in zip(y, p)]
    return spark.createDataFrame(rows, "target string, y int, p double")


def test_best_f1_threshold(scores):
    got = {r["target"]: (r["threshold"], r["f1"]) for r in TH.best_f1_threshold(scores, ["target"]).collect()}
    for g, y, p in cases():
        t, f = brute_f1(y, p)
        assert got[g][0] == pytest.approx(t, abs=1e-12) and got[g][1] == pytest.approx(f), g


def test_recall_floor_threshold(scores):
    got = {r["target"]: r for r in TH.recall_floor_threshold(scores, ["target"]).collect()}
    for g, y, p in cases():
        t, ok = brute_rf(y, p)
        assert got[g]["threshold"] == pytest.approx(t, abs=1e-12), g
        assert (got[g]["status"] == "OK") == ok, g


def test_average_precision(scores):
    got = {r["target"]: r["average_precision"] for r in TH.average_precision(scores, ["target"]).collect()}
    for g, y, p in cases():
        assert got[g] == pytest.approx(brute_ap(y, p)), g


def test_grid_matches_linspace():
    import pyspark.sql.functions as F  # noqa: F401
    g = np.linspace(0.05, 0.95, 91)
    step = (0.95 - 0.05) / 90
    assert all((g[i] == (0.95 if i == 90 else i * step + 0.05)) for i in range(91))
