"""Calibrated probabilities (isotonic and Platt) and cross-validated ridge penalties.

* Isotonic regression pools adjacent violators in every range of scores by itself; the pools of all
  ranges, far fewer than the rows, are pooled once more in order.  Pooling pools gives what pooling all
  rows at once gives.
* Platt scaling fits a logistic curve on the score by Newton steps; a step is one aggregation of
  six sums for all groups.
* The ridge penalty is chosen with one pass: a Gram matrix per fold, a fold left out by subtraction, its
  error from its own matrix.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsheet.operators.linear import _full
from jobsheet.operators.matrix import Rows, row_blocks


# ------------------------------------------------------------------ isotonic
def pool(lo: np.ndarray, hi: np.ndarray, total: np.ndarray, weight: np.ndarray):
    """Pool-adjacent-violators over pools in ascending order: (lo, hi, sum, weight) with rising means."""
    out: list[list[float]] = []
    for a, b, t, w in zip(lo.tolist(), hi.tolist(), total.tolist(), weight.tolist()):
        out.append([a, b, t, w])
        while len(out) > 1 and out[-2][2] * out[-1][3] >= out[-1][2] * out[-2][3]:
            a2, b2, t2, w2 = out.pop()
            out[-1] = [out[-1][0], b2, out[-1][2] + t2, out[-1][3] + w2]
    return tuple(np.array(c) for c in zip(*out)) if out else tuple(np.zeros(0) for _ in range(4))


def isotonic(scores: DataFrame, group: str = "target", y: str = "y", p: str = "p") -> DataFrame:
    """(group, lo, hi, value): the steps of the isotonic fit of ``y`` on ``p``; ties of ``p`` are one point."""
    kind = scores.schema[group].dataType.simpleString()
    points = scores.groupBy(F.col(group).alias("g"), F.col(p).cast("double").alias("x")).agg(F.sum(F.col(y).cast("double")).alias("t"), F.count(F.lit(1)).cast("double").alias("w"))
    n = int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = points.where(F.col("x").isNotNull()).repartitionByRange(n, "g", "x").sortWithinPartitions("g", "x")

    def steps(batches):
        """Pools of each group of a sorted partition; the last group's go on in the next batch."""
        held: tuple | None = None
        for b in batches:
            g = b.column("g").to_pylist()
            x, t, w = (b.column(c).to_numpy() for c in ("x", "t", "w"))
            cut = [0, *[k for k in range(1, len(g)) if g[k] != g[k - 1]], len(g)]
            for lo, hi in zip(cut, cut[1:]):
                if lo == hi:
                    continue
                own = (x[lo:hi], x[lo:hi], t[lo:hi], w[lo:hi])
                if held is not None and held[0] == g[lo]:
                    own = tuple(np.concatenate(c) for c in zip(held[1], own))
                elif held is not None:
                    yield _rows(*held)
                held = (g[lo], pool(*own))
        if held is not None:
            yield _rows(*held)

    def _rows(g, pools):
        return pa.RecordBatch.from_arrays([pa.array([g] * len(pools[0])), *map(pa.array, pools)], names=["g", "lo", "hi", "t", "w"])
    local = ranges.mapInArrow(steps, f"g {kind}, lo double, hi double, t double, w double")

    def whole(pdf):
        pdf = pdf.sort_values("lo")
        lo, hi, t, w = pool(*(pdf[c].to_numpy() for c in ("lo", "hi", "t", "w")))
        import pandas as pd
        return pd.DataFrame({"g": pdf["g"].iloc[0], "lo": lo, "hi": hi, "value": t / w})
    steps_ = local.groupBy("g").applyInPandas(whole, f"g {kind}, lo double, hi double, value double")  # the pools of the ranges, not the rows
    return steps_.withColumnRenamed("g", group)


def apply_isotonic(scores: DataFrame, steps: DataFrame, group: str = "target", p: str = "p", out: str = "calibrated") -> DataFrame:
    """Each score's calibrated value: that of its step, between steps a straight line, beyond the ends the last value."""
    names = [c for c in scores.columns if c != out]
    found = steps.select(group, "lo", "hi", "value").toPandas()  # of 0 / 1 outcomes n^(2/3) steps at most, far fewer than the rows
    held = {g: tuple(s[c].to_numpy(float) for c in ("lo", "hi", "value")) for g, s in found.sort_values("lo").groupby(group)}
    shared = scores.sparkSession.sparkContext.broadcast(held)

    def run(batches):
        for b in batches:
            x, known = b.column("_x").to_numpy(zero_copy_only=False).astype(float), b.column("_x").is_valid().to_numpy(zero_copy_only=False)
            value, none = np.zeros(b.num_rows), np.ones(b.num_rows, bool)
            code = b.column(group).dictionary_encode()
            of = code.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            for k, g in enumerate(code.dictionary.to_pylist()):
                if g in shared.value:
                    here = np.flatnonzero((of == k) & known)
                    value[here], none[here] = _between(x[here], *shared.value[g]), False
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(value, mask=none)], names=[*names, out])
    schema = T.StructType([*scores.select(*names).schema.fields, T.StructField(out, T.DoubleType())])
    return scores.select(*names, F.col(p).cast("double").alias("_x")).mapInArrow(run, schema)


def _between(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The value of each x: that of the last step that begins at or before it, a straight line after that step's end."""
    at = np.searchsorted(lo, x, side="right") - 1  # NaN comes after all
    below, above = np.maximum(at, 0), np.minimum(at + 1, len(lo) - 1)
    flat = (at < 0) | (x <= hi[below]) | (at + 1 == len(lo))
    gap = np.where(flat, 1.0, lo[above] - hi[below])
    line = value[below] + (value[above] - value[below]) * (x - hi[below]) / gap
    return np.where(flat, value[below], line)


# ------------------------------------------------------------------ Platt
def platt(scores: DataFrame, group: str = "target", y: str = "y", p: str = "p", rounds: int = 50, tol: float = 1e-10) -> dict:
    """group -> (slope, offset) of 1 / (1 + exp(-(slope x + offset))), the most likely ones with the usual smoothed
    targets (n1 + 1) / (n1 + 2) and 1 / (n0 + 2)."""
    x, label = F.col(p).cast("double"), F.col(y)
    counts = {r["g"]: r for r in scores.groupBy(F.col(group).alias("g")).agg(F.count_if(label == 1).alias("n1"), F.count_if(label != 1).alias("n0")).collect()}
    fit = {g: (0.0, float(np.log((r["n1"] + 1) / (r["n0"] + 1)))) for g, r in counts.items()}
    open_ = set(fit)
    for _ in range(rounds):
        if not open_:
            break

        def of(values):
            first, *rest = sorted(open_, key=str)
            c = F.when(F.col(group) == F.lit(first), F.lit(float(values(first))))
            for g in rest:
                c = c.when(F.col(group) == F.lit(g), F.lit(float(values(g))))
            return c
        z = of(lambda g: fit[g][0]) * x + of(lambda g: fit[g][1])
        q = 1 / (1 + F.exp(-z))
        t = F.when(label == 1, of(lambda g: (counts[g]["n1"] + 1) / (counts[g]["n1"] + 2))).otherwise(of(lambda g: 1 / (counts[g]["n0"] + 2)))
        d, h = q - t, q * (1 - q)
        sums = scores.where(F.col(group).isin(*open_)).groupBy(F.col(group).alias("g")).agg(
            F.sum(d * x).alias("a"), F.sum(d).alias("b"), F.sum(h * x * x).alias("aa"), F.sum(h * x).alias("ab"), F.sum(h).alias("bb")).collect()
        for r in sums:
            det = (r["aa"] + 1e-12) * (r["bb"] + 1e-12) - r["ab"] ** 2
            da, db = (r["a"] * (r["bb"] + 1e-12) - r["b"] * r["ab"]) / det, (r["b"] * (r["aa"] + 1e-12) - r["a"] * r["ab"]) / det
            size = max(1.0, abs(da) / 10, abs(db) / 10)  # far from the optimum a step is shortened
            fit[r["g"]] = (fit[r["g"]][0] - da / size, fit[r["g"]][1] - db / size)
            if max(abs(da), abs(db)) < tol * (1 + abs(fit[r["g"]][0]) + abs(fit[r["g"]][1])):
                open_.discard(r["g"])
    return fit


# ------------------------------------------------------------------ ridge
def ridge_cross_validation(df: DataFrame, label: int, fold: str, features: int, alphas: Sequence[float], folds: int, n_rows: int) -> list[tuple[float, float, float]]:
    """(alpha, RMSE, MSE of the worst fold) of a ridge on the rows with label > 0, each fold predicted by the others.

    ``fold`` numbers each row's fold from 0."""
    rows = df.select("idx", "val", F.array(F.get("labels", F.lit(label)), F.col(fold).cast("double")).alias("labels"))
    return ridge_cross_validations(row_blocks(rows, 2, n_rows), [0], features, alphas, folds)[0]


#: Bytes of the Gram matrices in a task.
HELD = 256 << 20


def ridge_cross_validations(blocks: RDD, labels: Sequence[int], features: int, alphas: Sequence[float], folds: int) -> list[list[tuple[float, float, float]]]:
    """:func:`ridge_cross_validation` of several labels over blocks whose last label is the fold: a pass serves as many
    labels as have room for their folds x features^2 numbers, of which half are sent; the driver holds features^2."""
    each = max(1, HELD // (8 * folds * (features + 2) ** 2))
    few = blocks.coalesce(min(blocks.getNumPartitions(), blocks.ctx.defaultParallelism))  # one set of matrices a core, whatever the rows
    return [r for at in range(0, len(labels), each) for r in _cross_validated(few, list(labels)[at:at + each], features, alphas, folds)]


def _cross_validated(few: RDD, labels: list[int], features: int, alphas: Sequence[float], folds: int) -> list[list[tuple[float, float, float]]]:
    size = features + 2
    upper = np.triu_indices(size)

    def part(found):
        total = np.zeros((len(labels), folds, size, size))
        for b in found:
            z = _augmented(b, features)
            for j, label in enumerate(labels):
                z[:, -1] = y = b.labels[:, label]
                for k in range(folds):
                    own = z[(y > 0) & (b.labels[:, -1] == k)]
                    total[j, k] += own.T @ own
        for j in range(len(labels)):
            yield from (((j, k), total[j, k][upper]) for k in range(folds))
    grams = few.mapPartitions(part).reduceByKey(lambda a, b: a + b, len(labels) * folds).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return [_tested(grams.filter(lambda p, j=j: p[0][0] == j).map(lambda p: (p[0][1], p[1])), features, alphas) for j in range(len(labels))]
    finally:
        grams.unpersist()


def _tested(grams: RDD, features: int, alphas: Sequence[float]) -> list[tuple[float, float, float]]:
    """(alpha, RMSE, MSE of the worst fold) from the Gram matrix of each fold."""
    whole = _full(grams.values().treeReduce(lambda a, b: a + b))

    def tested(pair):
        """The fold's number, rows, and error of each penalty when it is left out."""
        k, gram = pair[0], _full(pair[1])
        left = whole - gram
        n = max(left[0, 0], 1.0)
        mean = left[0, 1:-1] / n
        cov = left[1:-1, 1:-1] - n * np.outer(mean, mean)
        xy = left[1:-1, -1] - mean * left[0, -1]
        out = []
        for alpha in alphas:
            own = cov + alpha * np.eye(features)
            scale = 1 / np.sqrt(np.maximum(np.diag(own), 1e-300))  # prices and shares: each feature to its own scale
            w = scale * np.linalg.solve(own * np.outer(scale, scale), scale * xy)
            v = np.concatenate([[left[0, -1] / n - mean @ w], w, [-1.0]])
            out.append(max(0.0, float(v @ gram @ v)))
        return k, float(gram[0, 0]), out
    found = sorted(grams.map(tested).collect())  # a few numbers for each fold
    errors = np.array([e for _, _, e in found]).T
    n = np.maximum([c for _, c, _ in found], 1.0)
    return [(float(a), float(np.sqrt(e.sum() / max(whole[0, 0], 1.0))), float((e / n).max())) for a, e in zip(alphas, errors)]


def _augmented(b: Rows, features: int) -> np.ndarray:
    return np.concatenate([np.ones((b.n, 1)), b.dense(features), b.labels[:, :1]], 1)
