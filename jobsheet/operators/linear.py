"""Penalised linear models for all targets at once (F2, G1): block L-BFGS over distributed row blocks.

One pass over the blocks gives loss and gradient of every open target, so an iteration is one
Spark job however many targets there are; a target that has converged drops
out.  Features are scaled by their spread inside the solver, with the penalty scaled
back, so the optimum is that of the unscaled problem:

    logistic   sum_i w_i log(1 + exp(-y_i z_i)) + ||b||^2 / (2 C)
    squared    sum_i w_i (y_i - z_i)^2 / 2      + alpha ||b||^2 / 2

The intercept is not penalised.  A weight of 0 leaves a row out of a target.

L-BFGS starts from the inverse of the true curvature (one weighted Gram matrix per target, summed in the
executors, renewed every ``RENEW`` passes; of the logistic loss from ``CURVE_ROWS`` rows at most): the squared loss
is solved by its first step, the logistic loss in a few.  Beyond ``CURVED`` features there is no such matrix and the passes are plain L-BFGS.

As with the trees, a training set of at most ``TOGETHER`` entries is one block and each
target is solved in a task of its own; the solver is the same code.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark import RDD

from jobsheet.operators.matrix import Linear, Rows

MEMORY = 20
TOGETHER = 4_000_000
#: A block with more than one entry in so many is multiplied as a dense matrix.
DENSE = 10
#: Most features with a Gram matrix (128 MB), passes until it is renewed, and bytes of such matrices in a task.
CURVED = 4096
RENEW = 8
HELD = 256 << 20
#: Rows that the logistic curvature is estimated from where there are more.
CURVE_ROWS = 32_768


def _spread(blocks: RDD, d: int, weigh) -> tuple[np.ndarray, np.ndarray, int, int, np.ndarray]:
    """Mean, standard deviation, number of rows and of entries, each target's weight: one pass."""
    def part(rows):
        total, n, entries, weight = np.zeros((2, d)), 0, 0, 0.0
        for b in rows:
            total += [np.bincount(b.index, b.value, d), np.bincount(b.index, b.value * b.value, d)]
            n, entries, weight = n + b.n, entries + len(b.value), weight + weigh(b.labels)[1].sum(0)
        yield total, n, entries, weight
    total, n, entries, weight = blocks.mapPartitions(part).treeReduce(_added, depth=_depth(blocks))
    mean = total[0] / max(n, 1)
    return mean, np.sqrt(np.maximum(total[1] / max(n, 1) - mean * mean, 0)), n, entries, weight


def _depth(blocks: RDD) -> int:
    return 1 if blocks.getNumPartitions() <= 64 else 2


def _margin(b: Rows, w: np.ndarray) -> np.ndarray:
    """Rows x targets."""
    z = np.zeros((b.n, w.shape[1]))
    full = np.flatnonzero(np.diff(b.first))
    if len(full):
        z[full] = np.add.reduceat(b.value[:, None] * w[b.index], b.first[full], axis=0)
    return z


def _sums(kind: str, b: Rows, x: np.ndarray | None, y: np.ndarray, weight: np.ndarray, w: np.ndarray, intercept: np.ndarray):
    """Loss, gradient and intercept gradient of one block; ``x``: its dense form, where it has one."""
    z = (_margin(b, w) if x is None else x @ w) + intercept
    if kind == "logistic":
        loss = (weight * (np.logaddexp(0, z) - y * z)).sum(0)
        r = weight * (1 / (1 + np.exp(-np.clip(z, -700, 700))) - y)
    else:
        loss = (weight * (z - y) ** 2 / 2).sum(0)
        r = weight * (z - y)
    if x is not None:
        return loss, x.T @ r, r.sum(0)
    grad, entry = np.zeros(w.shape), b.row_of_entry()
    for j in range(w.shape[1]):
        grad[:, j] = np.bincount(b.index, b.value * r[entry, j], len(w))
    return loss, grad, r.sum(0)


def _dense(b: Rows, d: int) -> np.ndarray | None:
    return b.dense(d) if len(b.value) * DENSE > b.n * d else None  # two matrix products beat one gather per entry


def _added(a, b):
    return tuple(x + y for x, y in zip(a, b))


def _loss_and_gradient(kind: str, cols: np.ndarray, w: np.ndarray, intercept: np.ndarray, weigh: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]):
    d, k = w.shape

    def part(rows):
        total = np.zeros(k), np.zeros((d, k)), np.zeros(k)
        for b in rows:
            y, weight = weigh(b.labels)
            total = _added(total, _sums(kind, b, _dense(b, d), y[:, cols], weight[:, cols], w, intercept))
        yield total
    return part


def _curvature(kind: str, b: Rows, d: int, weight: np.ndarray, w: np.ndarray, intercept: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> list[np.ndarray]:
    """For each target the second derivatives of one block's loss, in scaled coordinates with centred features; the intercept is last."""
    x = b.dense(d)
    if kind == "logistic":
        p = 1 / (1 + np.exp(-np.clip(x @ w + intercept, -700, 700)))
        weight = weight * p * (1 - p)
    x = np.concatenate([(x - mean) / scale, np.ones((b.n, 1))], 1)
    out = []
    for j in range(weight.shape[1]):
        used = weight[:, j] > 0
        own = x[used] * np.sqrt(weight[used, j, None])
        out.append(own.T @ own)  # one operand: half of the products
    return out


def _inverse(curvature: np.ndarray, penalty: float, scale: np.ndarray) -> np.ndarray:
    """Inverse of the curvature with the penalty on the features."""
    own = curvature + np.diag(np.append(penalty / scale ** 2, 0.0))
    own[np.diag_indices(len(own))] += max(1e-12 * np.trace(own) / len(own), 1e-300)
    try:
        return np.linalg.inv(own)
    except np.linalg.LinAlgError:
        return np.linalg.pinv(own, hermitian=True)


def _full(curvature: np.ndarray) -> np.ndarray:
    """The upper half that was sent, as a whole matrix."""
    d = int(np.sqrt(2 * len(curvature)))
    out = np.zeros((d, d))
    out[np.triu_indices(d)] = curvature
    return out + np.triu(out, 1).T


def _turner_of_all(blocks: RDD, kind: str, weigh, mean: np.ndarray, scale: np.ndarray, penalty: np.ndarray, n: int):
    """``turner(w, b, cols)`` over distributed blocks: what is shuffled is cores x targets x features^2 / 2, whatever the rows.

    The logistic curvature only turns the steps, the optimum is that of the gradient over all rows; beyond ``CURVE_ROWS``
    rows it is estimated from so many of them, for each pass over them has features^2 products a row and target."""
    d = len(mean)
    share = min(1.0, CURVE_ROWS / max(n, 1)) if kind == "logistic" else 1.0

    def turner(w, intercept, cols):
        return _turned(w, intercept, cols, share) or _turned(w, intercept, cols, 1.0)

    def _turned(w, intercept, cols, share):
        used = blocks.sample(False, share, 7) if share < 1 else blocks
        few = used.coalesce(min(blocks.getNumPartitions(), blocks.ctx.defaultParallelism))

        def inverse(own, found):
            curvature, rows = _full(found[0]) * (n / found[1]), found[1]
            if rows < n:  # a feature that these rows lack: as if it were spread among them
                at = np.diag_indices(len(curvature))
                curvature[at] = np.maximum(curvature[at], curvature[-1, -1] / 20)
            return _inverse(curvature, penalty[own], scale)
        out, width = [], max(1, HELD // (8 * (d + 1) ** 2))
        for lo in range(0, len(cols), width):
            own, w_, b_ = cols[lo:lo + width], w[:, lo:lo + width], intercept[lo:lo + width]

            def part(rows, own=own, w_=w_, b_=b_):
                total, seen = None, 0
                for b in rows:
                    now = _curvature(kind, b, d, weigh(b.labels)[1][:, own], w_, b_, mean, scale)
                    total, seen = now if total is None else [x + y for x, y in zip(total, now)], seen + b.n
                for j, x in enumerate(total or []):
                    yield j, (x[np.triu_indices(len(x))], seen)
            turned = few.mapPartitions(part).reduceByKey(_added, len(own)).map(lambda p, own=own: (p[0], inverse(own[p[0]], p[1])))
            out += [h for _, h in sorted(turned.collect(), key=lambda p: p[0])]  # features^2 for each target
        return out
    return turner if d <= CURVED else None


class _Memory:
    """The L-BFGS direction of one target, from an inverse of its curvature where there is one."""

    def __init__(self, inverse: np.ndarray | None = None):
        self.s, self.y, self.inverse = [], [], inverse

    def push(self, s, y):
        if s @ y > 1e-12 * np.linalg.norm(s) * np.linalg.norm(y):
            self.s, self.y = [*self.s, s][-MEMORY:], [*self.y, y][-MEMORY:]

    def direction(self, g):
        q, alphas = g.copy(), []
        for s, y in zip(reversed(self.s), reversed(self.y)):
            a = (s @ q) / (s @ y)
            alphas.append(a)
            q -= a * y
        if self.inverse is not None:
            q = self.inverse @ q
        elif self.s:
            q *= (self.s[-1] @ self.y[-1]) / (self.y[-1] @ self.y[-1])
        for (s, y), a in zip(zip(self.s, self.y), reversed(alphas)):
            q += s * (a - (y @ q) / (s @ y))
        return -q


def _solve(sums, weight: np.ndarray, mean: np.ndarray, scale: np.ndarray, penalty: np.ndarray, max_iter: int, tol: float, turner=None, constant: bool = False):
    """Weights (features x targets) and intercepts; ``sums(w, b, cols)`` adds up loss and gradients of those targets,
    ``turner(w, b, cols)`` gives the inverse of their curvature (``constant``: the same everywhere)."""
    d, k = len(mean), len(penalty)

    def evaluate(u, cols):
        """Losses and gradients at ``u`` (features + 1 x targets), in scaled coordinates with centred features."""
        w = u[:-1] / scale[:, None]
        loss, grad, grad0 = sums(w, u[-1] - mean @ w, cols)
        pen = penalty[cols]
        return loss + pen * (w * w).sum(0) / 2, np.vstack([(grad - mean[:, None] * grad0 + pen * w) / scale[:, None], grad0])

    def downhill(t):
        return -grad[:, t] / max(np.linalg.norm(grad[:, t]), 1e-300), 1.0, 0

    def turn(cols):
        """Steps along the gradient turned by the curvature at ``u``."""
        w = u[:-1, cols] / scale[:, None]
        for t, h in zip(cols, turner(w, u[-1, cols] - mean @ w, cols)):
            memories[t] = _Memory(h)
            step[t] = memories[t].direction(grad[:, t]), 1.0, 0
            if grad[:, t] @ step[t][0] >= 0:
                memories[t] = _Memory()
                step[t] = downhill(t)

    u = np.zeros((d + 1, k))
    cols = np.flatnonzero(weight > 0)
    loss, grad = np.zeros(k), np.zeros((d + 1, k))
    if len(cols):
        loss[cols], grad[:, cols] = evaluate(u[:, cols], cols)
    memories = [_Memory() for _ in range(k)]
    step = {t: downhill(t) for t in cols}
    for pass_ in range(max_iter):
        cols = np.array([t for t in cols if np.abs(grad[:, t]).max() > tol * weight[t]], int)
        if not len(cols):
            break
        if turner is not None and (pass_ == 0 or not constant and pass_ % RENEW == 0):
            turn(cols)
        trial = np.stack([u[:, t] + step[t][1] * step[t][0] for t in cols], 1)
        new_loss, new_grad = evaluate(trial, cols)
        going = []
        for j, t in enumerate(cols):
            direction, size, tries = step[t]
            if new_loss[j] <= loss[t] + 1e-4 * size * (grad[:, t] @ direction) + 1e-12 * abs(loss[t]):
                memories[t].push(trial[:, j] - u[:, t], new_grad[:, j] - grad[:, t])
                u[:, t], loss[t], grad[:, t] = trial[:, j], new_loss[j], new_grad[:, j]
                step[t] = memories[t].direction(grad[:, t]), 1.0, 0
                if grad[:, t] @ step[t][0] >= 0:
                    memories[t] = _Memory()
                    step[t] = downhill(t)
            elif tries < 30:
                step[t] = direction, size / 2 if tries else size / 4, tries + 1
            elif memories[t].s:  # the curvature is stale: start again downhill
                memories[t] = _Memory()
                step[t] = downhill(t)
            else:
                continue  # no descent left at this precision
            going.append(t)
        cols = np.array(going, int)
    w = u[:-1] / scale[:, None]
    return w, u[-1] - mean @ w


def fit_linear(blocks: RDD, kind: str, features: int, penalty: np.ndarray, weigh, max_iter: int = 1000, tol: float = 1e-7,
               together: int = TOGETHER) -> list[Linear]:
    """One model per column of ``weigh(labels) -> (y, weight)``; ``penalty`` is 1 / C or alpha for each.

    Stops where the scaled gradient is below ``tol`` of the weight of the rows, or after ``max_iter`` passes."""
    k, depth = len(penalty), _depth(blocks)
    mean, sd, n, entries, weight = _spread(blocks, features, weigh)
    scale = np.where(sd > 0, sd, 1.0)
    if entries > together:
        def sums(w, intercept, cols):
            return blocks.mapPartitions(_loss_and_gradient(kind, cols, w, intercept, weigh)).treeReduce(_added, depth=depth)
        w, b = _solve(sums, weight, mean, scale, penalty, max_iter, tol, _turner_of_all(blocks, kind, weigh, mean, scale, penalty, n), kind != "logistic")
        return [Linear(w[:, t].copy(), float(b[t]), kind == "logistic") for t in range(k)]

    def alone(pair):
        t, parts = pair
        held = [(p, _dense(p, features), *(a[:, [t]] for a in weigh(p.labels))) for p in parts]

        def sums(w, intercept, cols):
            total = None
            for p, x, y, at in held:
                now = _sums(kind, p, x, y, at, w, intercept)
                total = now if total is None else _added(total, now)
            return total

        def turner(w, intercept, cols):
            total = 0.0
            for p, _, _, at in held:
                total = total + _curvature(kind, p, features, at, w, intercept, mean, scale)[0]
            return [_inverse(total, penalty[t], scale)]
        w, b = _solve(sums, weight[[t]], mean, scale, penalty[[t]], max_iter, tol, turner if features <= CURVED else None, kind != "logistic")
        return t, Linear(w[:, 0].copy(), float(b[0]), kind == "logistic")
    dealt = blocks.flatMap(lambda b: [(t, b) for t in range(k)]).groupByKey(k, lambda t: t)
    return [m for _, m in sorted(dealt.map(alone).collect(), key=lambda p: p[0])]  # one small model per target
