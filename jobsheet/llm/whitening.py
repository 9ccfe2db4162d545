"""Embedding whitening by a distributed block Jacobi-Davidson eigensolver (operator 12).

Entries become integers x = floor(``scale`` * c) + ``shift``.  The fit list, each distinct
x once, is written to the shared folder and held in executors as row blocks.  The
covariance V is never formed: all the solver asks for is V times a thin block of
columns, one Spark job over the row blocks, each row centred exactly (n * x - S in
integers) before it is multiplied.

The solver keeps a search space, takes Ritz pairs from it, locks leading pairs whose
residual has reached double precision, and extends the space by the solutions
of the projected correction equations (I - QQ')(V - eI)(I - QQ') t = -r.  Those are solved by MINRES for
all open pairs in lock step, so that a step costs one job for all of them.  Beyond
``3 * (k + GUARD)`` columns the space restarts from its leading Ritz vectors.

Defined results: a row whose id is null stays (the id is null there too); a row whose vector is
null, holds a null or non-finite entry, an entry of 2**52 / scale or more, or is shorter
than the longest vector, is dropped; repeated rows are fitted once and returned each;
components without variance (fewer distinct vectors or dimensions than k, constant
dimensions) aren't returned; with no usable row or a single distinct one the result is empty; a
deviation beyond 64 bits is null; other columns pass through ``whiten``, and
input columns named deviation or whitened are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsheet.llm.common import keep
from jobsheet.llm.topk_search import _matrix, x_of

BLOCK_ROWS = 4096
GUARD = 4
MINRES_STEPS = 8
#: Residual of a locked pair, as a part of the largest eigenvalue.
PRECISION = 1e-14
_LONG = 2**62


# ------------------------------------------------------------------ the solver
def orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Unit columns spanning ``new`` outside the bases ``against``; dependent columns go."""
    out: list[np.ndarray] = []
    for t in new.T:
        size = np.linalg.norm(t)
        if not size > 0:
            continue
        t = t / size
        for _ in range(3):
            for base in against:
                t = t - base @ (base.T @ t)
            for o in out:
                t = t - o * (o @ t)
            size = np.linalg.norm(t)
            if size < 1e-8:
                break
            t = t / size
        else:
            out.append(t)
    return np.stack(out, 1) if out else np.zeros((len(new), 0))


def correction(product, q: np.ndarray, e: np.ndarray, r: np.ndarray, steps: int, tol: float) -> np.ndarray:
    """MINRES on (I - QQ')(V - eI)(I - QQ') t = -r, a column each, in lock step."""
    def project(z):
        return z - q @ (q.T @ z)

    v = project(project(-r))
    size = start = np.linalg.norm(v, axis=0)
    v = v / np.where(size > 0, size, 1)
    zero, one = np.zeros_like(size), np.ones_like(size)
    t, v_old, w, w_old = (np.zeros_like(v) for _ in range(4))
    c, c_old, s, s_old, beta, eta, live = one, one, zero, zero, zero, size, size > 0
    for _ in range(steps):
        if not live.any():
            break
        z = np.zeros_like(v)
        z[:, live] = product(v[:, live])
        z = project(z - v * e)
        alpha = (v * z).sum(0)
        z = project(z - alpha * v - beta * v_old)
        after = np.linalg.norm(z, axis=0)
        delta = c * alpha - c_old * s * beta
        rho1, rho2, rho3 = np.hypot(delta, after), s * alpha + c_old * c * beta, s_old * beta
        ok = live & (rho1 > 0)
        rho1 = np.where(ok, rho1, 1)
        c, c_old, s, s_old = np.where(ok, delta / rho1, 1), c, np.where(ok, after / rho1, 0), s
        w, w_old = (v - rho3 * w_old - rho2 * w) / rho1, w
        t = np.where(ok, t + c * eta * w, t)
        eta = np.where(ok, -s * eta, eta)
        v, v_old, beta = z / np.where(after > 0, after, 1), v, after
        live = ok & (after > PRECISION * np.abs(e)) & (np.abs(eta) > tol * start)
    return t


def jacobi_davidson(product, d: int, k: int, steps: int = MINRES_STEPS, rounds: int = 500, seed: int = 7):
    """The ``k`` largest eigenpairs (values falling, unit columns) of the symmetric operator ``product``."""
    want = min(k, d)
    lead = min(want + GUARD, d)
    rng = np.random.default_rng(seed)
    locked, values = np.zeros((d, 0)), np.zeros(0)
    space = orthonormal(rng.standard_normal((d, lead)))
    image = product(space)
    for _ in range(rounds):
        h = space.T @ image
        e, y = np.linalg.eigh((h + h.T) / 2)
        e, y = e[::-1], y[:, ::-1]
        scale = max(e[:1].max(initial=0), values.max(initial=0))
        whole = space.shape[1] + locked.shape[1] == d  # nothing is left outside: the Ritz pairs are exact
        space, image = space @ y, image @ y
        r = image - space * e
        r -= locked @ (locked.T @ r)
        open_ = np.linalg.norm(r, axis=0) > PRECISION * scale
        done = len(e) if whole else int(np.argmax(open_)) if open_.any() else len(e)
        done = min(done, want - len(values))
        locked, values = np.concatenate([locked, space[:, :done]], 1), np.concatenate([values, e[:done]])
        space, image, r, e, open_ = space[:, done:], image[:, done:], r[:, done:], e[done:], open_[done:]
        if len(values) == want:
            if whole or not len(e) or e[0] <= values.min() * (1 + 1e-12):
                order = np.argsort(-values, kind="stable")
                return values[order], locked[:, order]
            least = int(np.argmin(values))  # a larger pair came late: this one is open again
            back = locked[:, [least]]
            space, image = np.concatenate([space, back], 1), np.concatenate([image, product(back)], 1)
            locked, values = np.delete(locked, least, 1), np.delete(values, least)
            continue
        top = np.flatnonzero(open_[:want - len(values)])
        q = np.concatenate([locked, space[:, :lead - len(values)]], 1)
        new = correction(product, q, e[top], r[:, top], steps, 0.01)
        if space.shape[1] + len(top) > 3 * lead - len(values):
            space, image = space[:, :lead - len(values)], image[:, :lead - len(values)]
        new = orthonormal(new, locked, space)
        if not new.shape[1]:
            new = orthonormal(rng.standard_normal((d, 1)), locked, space)
        if new.shape[1]:
            space, image = np.concatenate([space, new], 1), np.concatenate([image, product(new)], 1)
    raise ArithmeticError(f"{want - len(values)} eigenpairs short of double precision after {rounds} rounds")


# ------------------------------------------------------------------ the distributed operator
def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S in exact integers (Python's, where 64 bits don't hold them)."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most < _LONG:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _deviation(y: np.ndarray) -> list[int | None]:
    most = max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0))))
    if most * most * y.shape[1] < _LONG:
        return (y.astype(np.int64) ** 2).sum(1).tolist()
    return [v if v < 2**63 else None for v in (y.astype(object) ** 2).sum(1)]


def _sums(x: np.ndarray) -> list[int]:
    if int(np.abs(x).max(initial=0)) * len(x) < _LONG:
        return [int(v) for v in x.sum(0)]
    return [int(v) for v in x.astype(object).sum(0)]


def _blocks(batches):
    for b in batches:
        for at in range(0, b.num_rows, BLOCK_ROWS):
            part = b.slice(at, BLOCK_ROWS)
            yield pa.RecordBatch.from_arrays([pa.array([part.num_rows], pa.int32()), pa.array([_matrix(part.column("x")).tobytes()], pa.binary())],
                                             names=["n", "x"])


def _add(a, b):
    return [u + v for u, v in zip(a, b, strict=True)] if isinstance(a, list) else a + b


class FitList:
    """Row blocks of the fit list in the executors; a lost one is read again from the written table."""

    def __init__(self, x: DataFrame, dims: int):
        self.dims = dims
        packed = x.mapInArrow(_blocks, "n int, x binary").rdd
        self.blocks = packed.map(lambda r: np.frombuffer(r.x, np.int64).reshape(r.n, dims)).persist()
        self.n, self.sums = self._sum(lambda b: [len(b), *_sums(b)], [0] * (dims + 1)), None
        self.n, self.sums = self.n[0], self.n[1:]

    def _sum(self, f, zero):
        def part(blocks):
            total = None
            for b in blocks:
                total = f(b) if total is None else _add(total, f(b))
            return [] if total is None else [total]
        partial = self.blocks.mapPartitions(part)
        found = partial.collect() if self.blocks.getNumPartitions() <= 64 else [partial.treeAggregate(zero, _add, _add, depth=2)]
        total = zero
        for f_ in found:
            total = _add(total, f_)
        return total

    def product(self, columns: np.ndarray) -> np.ndarray:
        """V times the columns: one pass over the rows."""
        n, sums, columns = self.n, self.sums, np.ascontiguousarray(columns)

        def f(x):
            y = centred(x, n, sums).astype(np.float64) / n
            return y.T @ (y @ columns)
        return self._sum(f, np.zeros((self.dims, columns.shape[1]))) / n

    def trace(self) -> float:
        n, sums = self.n, self.sums
        return float(self._sum(lambda x: ((centred(x, n, sums).astype(np.float64) / n) ** 2).sum(), 0.0)) / n

    def moments(self, vectors: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Covariance of the whitened fit list, from its own means and products."""
        n, sums, k = self.n, self.sums, len(values)

        def f(x):
            w = centred(x, n, sums).astype(np.float64) / n @ vectors / np.sqrt(values)
            return np.concatenate([w.T @ w, w.sum(0)[None]])
        m = self._sum(f, np.zeros((k + 1, k))) / n
        return m[:k] - np.outer(m[k], m[k])

    def close(self) -> None:
        self.blocks.unpersist()


@dataclass
class Whitening:
    """What ``fit`` found: n and sums of the fit list, eigenpairs by falling value, trace and identity error."""
    scale: float
    shift: int
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def _integers(df: DataFrame, vec_col: str, scale: float, shift: int) -> DataFrame:
    """The usable rows with their integers in ``__x`` (null where the vector is shorter than others: see ``_usable``)."""
    v = F.col(vec_col).cast("array<double>")
    limit = 2.0**52 / scale
    fine = F.coalesce(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(limit))), F.lit(False))
    x = F.transform(v, lambda c: F.floor(c * F.lit(float(scale))) + F.lit(shift).cast("long"))
    return df.where(v.isNotNull() & fine).withColumn("__x", x)


def fit(df: DataFrame, k: int = 16, scale: float = 64, shift: int = 1_000_000, vec_col: str = "embedding") -> Whitening:
    """Fit on the distinct integer vectors of ``df``."""
    rows = _integers(df.select(vec_col), vec_col, scale, shift)
    dims = rows.select(F.max(F.size("__x"))).first()[0] or 0
    none = Whitening(scale, shift, 0, [0] * dims, np.zeros(0), np.zeros((dims, 0)), 0.0, 0.0)
    if not dims:
        return none
    listed = keep(rows.where(F.size("__x") == dims).select(F.col("__x").alias("x")).distinct(), "whitening-fit-list")
    fitted = FitList(listed, dims)
    try:
        trace = fitted.trace()
        if fitted.n < 2 or not trace > 0:
            return Whitening(scale, shift, fitted.n, fitted.sums, np.zeros(0), np.zeros((dims, 0)), trace, 0.0)
        values, vectors = jacobi_davidson(fitted.product, dims, k)
        real = values > values[0] * dims * 1e-13
        values, vectors = values[real], vectors[:, real]
        error = float(np.abs(fitted.moments(vectors, values) - np.eye(len(values))).max())
        return Whitening(scale, shift, fitted.n, fitted.sums, values, vectors, trace, error)
    finally:
        fitted.close()


def whiten(df: DataFrame, model: Whitening, vec_col: str = "embedding") -> DataFrame:
    """The usable rows of ``df`` with ``deviation`` and ``whitened`` (an array, a value for each component)."""
    n, sums, dims = model.n, model.sums, len(model.sums)
    columns = model.vectors / np.sqrt(model.values)
    rows = _integers(df.drop("deviation", "whitened"), vec_col, model.scale, model.shift)
    rows = rows.where((F.size("__x") == dims) & F.lit(bool(n and dims)))
    names = [c for c in rows.columns if c != "__x"]

    def project(batches):
        for b in batches:
            if not b.num_rows:
                continue
            y = centred(_matrix(b.column("__x")), n, sums)
            w = y.astype(np.float64) / n @ columns
            offsets = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), pa.array(_deviation(y), pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(w.ravel()))],
                names=[*names, "deviation", "whitened"])
    schema = rows.drop("__x").withColumn("deviation", F.lit(0).cast("long")).withColumn("whitened", F.array(F.lit(0.0))).schema
    return rows.mapInArrow(project, schema)


def whitened_components(df: DataFrame, model: Whitening, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """A row for each usable row and component, with the component's share of the variance."""
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.values]).cast("array<double>")
    rows = whiten(df.select(F.col(id_col), F.col(vec_col)), model, vec_col)
    return rows.select(id_col, "deviation", F.posexplode("whitened").alias("at", "value")).select(
        id_col, (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", F.col("value").alias("whitened"),
        F.get(shares, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))
