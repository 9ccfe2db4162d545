"""Row blocks of the training matrix: sparse rows packed for learners that pass over all of them again and again.

A learner sees the matrix as an RDD of numpy blocks.  The blocks come from the
Arrow batches of a written table, so a lost executor costs a re-read of its part;
iterative learners are the one place where RDDs are used, because each pass is imperative
work on a block and Catalyst has nothing to plan in it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows in a block; a partition has at least one block, so small tables use few tasks.
BLOCK_ROWS = 2048
#: Rows in a partition: each sends one set of sums a pass, so partitions are as few as keep all cores busy.
PARTITION_ROWS = 32 * BLOCK_ROWS
#: Rows of a partition where there are fewer blocks than cores.
SMALL_ROWS = 512


@dataclass
class Rows:
    """Sparse rows (CSR) with one column of labels per target."""
    first: np.ndarray   # row -> first entry, n + 1 values
    index: np.ndarray   # feature of each entry
    value: np.ndarray
    labels: np.ndarray  # n x targets

    @property
    def n(self) -> int:
        return len(self.first) - 1

    def row_of_entry(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), np.diff(self.first))

    def dense(self, features: int) -> np.ndarray:
        out = np.zeros((self.n, features))
        out[self.row_of_entry(), self.index] = self.value
        return out


def flat_lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and values of an Arrow list column (nulls are empty)."""
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.flatten().to_numpy(zero_copy_only=False)


def rows_of(batch: pa.RecordBatch, targets: int) -> Rows:
    first, index = flat_lists(batch.column("idx"))
    value = flat_lists(batch.column("val"))[1]
    labels = flat_lists(batch.column("labels"))[1].reshape(batch.num_rows, targets)
    return Rows(first.astype(np.int64), index.astype(np.int32), value.astype(np.float64), labels.astype(np.float64))


def _pack(batches):
    for b in batches:
        for at in range(0, b.num_rows, BLOCK_ROWS):
            part = b.slice(at, BLOCK_ROWS)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema) as out:
                out.write_batch(part)
            yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block"])


def partitions_of(n_rows: int, cores: int) -> int:
    parts = max(1, -(-n_rows // PARTITION_ROWS), min(cores, n_rows // SMALL_ROWS))
    return -(-parts // cores) * cores if parts > cores else parts


def row_blocks(df: DataFrame, targets: int, n_rows: int) -> RDD:
    """``df`` (idx array<int>, val array<double>, labels array<double>) as an RDD of :class:`Rows`."""
    parts = partitions_of(n_rows, df.sparkSession.sparkContext.defaultParallelism)
    packed = df.select("idx", "val", "labels").repartition(parts).mapInArrow(_pack, "block binary").rdd

    def unpack(row):
        with pa.ipc.open_stream(row.block) as s:
            return rows_of(s.read_next_batch(), targets)
    return packed.map(unpack)


def dense(first: np.ndarray, index: np.ndarray, value: np.ndarray, used: np.ndarray) -> np.ndarray:
    """The columns ``used`` (sorted feature numbers) of sparse rows as a dense matrix, column after column."""
    out = np.zeros((len(used), len(first) - 1))
    if not len(used) or not len(index):
        return out.T
    place = np.full(max(int(used[-1]), int(index.max())) + 1, -1)
    place[used] = np.arange(len(used))
    at = place[index]
    hit = at >= 0
    out[at[hit], np.repeat(np.arange(len(first) - 1), np.diff(first))[hit]] = value[hit]
    return out.T


# ------------------------------------------------------------------ fitted models
@dataclass
class Linear:
    """x w + b, through the logistic function for ``logistic``."""
    weights: np.ndarray
    intercept: float
    logistic: bool = False

    def used(self) -> np.ndarray:
        return np.flatnonzero(self.weights)

    def predict(self, x: np.ndarray, used: np.ndarray) -> np.ndarray:
        z = x @ self.weights[used] + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -700, 700))) if self.logistic else z


@dataclass
class Constant:
    value: float

    def used(self) -> np.ndarray:
        return np.zeros(0, np.int64)

    def predict(self, x: np.ndarray, used: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


@dataclass
class Trees:
    """Boosted trees in flat arrays: a node goes left where its feature's value is at most ``cut``; leaves have feature -1."""
    base: float
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    roots: np.ndarray
    logistic: bool = False

    def used(self) -> np.ndarray:
        return np.unique(self.feature[self.feature >= 0])

    def _masks(self):
        """For a pass over all nodes: (condition, (tree, leaves that stay where it fails)...) and the values of the leaves,
        numbered from the left; None beyond 64 leaves."""
        if "_quick" not in self.__dict__:
            nodes: dict[tuple[int, float], list[tuple[int, int]]] = {}
            leaves: list[list[float]] = []
            for t, root in enumerate(self.roots.tolist()):
                first, values, stack, inner = {}, [], [root], []
                while stack:
                    k = stack.pop()
                    first[k] = len(values)
                    if self.feature[k] < 0:
                        values.append(float(self.value[k]))
                    else:
                        inner.append(k)
                        stack += [int(self.right[k]), int(self.left[k])]
                for k in inner:  # a row that goes right loses the leaves on the left
                    lost = (1 << first[int(self.right[k])]) - (1 << first[k])
                    nodes.setdefault((int(self.feature[k]), float(self.cut[k])), []).append((t, ~lost & (1 << 64) - 1))
                leaves.append(values)
            most = max(map(len, leaves), default=0)
            held = np.zeros((len(leaves), max(most, 1)))
            for t, values in enumerate(leaves):
                held[t, :len(values)] = values
            kind = np.uint32 if most <= 32 else np.uint64
            least = (1 << 32) - 1 if most <= 32 else (1 << 64) - 1
            self._quick = None if most > 64 else ([(f, c, [(t, kind(stay & least)) for t, stay in own]) for (f, c), own in sorted(nodes.items())], held, kind)
        return self._quick

    def raw(self, x: np.ndarray, used: np.ndarray) -> np.ndarray:
        quick = self._masks()
        if quick is None:
            return self._walked(x, used)
        conditions, values, kind = quick
        out = np.full(len(x), self.base)
        if not len(values):
            return out
        at = np.searchsorted(used, [f for f, _, _ in conditions])
        for lo in range(0, len(x), 4096):
            columns = np.ascontiguousarray(x[lo:lo + 4096].T)
            left = np.full((len(values), columns.shape[1]), ~kind(0))  # for each tree the leaves that a row can still reach
            for place, (_, cut, own) in zip(at.tolist(), conditions):
                stays = -(columns[place] <= cut).astype(kind)  # all bits where it holds
                for t, stay in own:
                    left[t] &= stays | stay
            leaf = np.bitwise_count((left & -left) - kind(1))
            out[lo:lo + 4096] += np.take_along_axis(values, leaf.astype(np.intp), 1).sum(0)
        return out

    def _walked(self, x: np.ndarray, used: np.ndarray) -> np.ndarray:
        at = np.where(self.feature >= 0, np.searchsorted(used, np.maximum(self.feature, 0)), 0)
        out = np.full(len(x), self.base)
        for lo in range(0, len(x), 1024):  # rows x trees at a time
            rows = x[lo:lo + 1024] if x.shape[1] else np.zeros((len(x[lo:lo + 1024]), 1))
            node = np.broadcast_to(self.roots, (len(rows), len(self.roots))).copy()
            r = np.arange(len(rows))[:, None]
            while (self.feature[node] >= 0).any():
                down = np.where(rows[r, at[node]] <= self.cut[node], self.left[node], self.right[node])
                node = np.where(self.feature[node] >= 0, down, node)
            out[lo:lo + 1024] += self.value[node].sum(1)
        return out

    def predict(self, x: np.ndarray, used: np.ndarray) -> np.ndarray:
        z = self.raw(x, used)
        return 1 / (1 + np.exp(-np.clip(z, -700, 700))) if self.logistic else z

    def importance(self, features: int) -> np.ndarray:
        """Number of splits on each feature."""
        return np.bincount(self.feature[self.feature >= 0], minlength=features)


def predictions(models: Sequence, first: np.ndarray, index: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Rows x models."""
    out = np.empty((len(first) - 1, len(models)))
    used = np.unique(np.concatenate([np.zeros(0, np.int64), *[m.used() for m in models]]))
    for lo in range(0, len(out), 2048):
        f = first[lo:lo + 2049]
        i, v = index[f[0]:f[-1]], value[f[0]:f[-1]]
        x = dense(f - f[0], i, v, used)
        for k, m in enumerate(models):
            out[lo:lo + len(f) - 1, k] = m.predict(x, used)
    return out


def predict(df: DataFrame, models: Sequence, out: str = "scores") -> DataFrame:
    """``df`` with ``out``, an array with one value per model; row by row, nothing is shuffled."""
    shared = df.sparkSession.sparkContext.broadcast(list(models))  # bounded by features, rounds and leaves
    names = [c for c in df.columns if c != out]

    def run(batches):
        for b in batches:
            first, index = flat_lists(b.column("idx"))
            scores = predictions(shared.value, first, index, flat_lists(b.column("val"))[1])
            offsets = np.arange(len(scores) + 1, dtype=np.int32) * scores.shape[1]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.ListArray.from_arrays(pa.array(offsets), pa.array(scores.ravel()))],
                                             names=[*names, out])
    schema = df.select(*names).withColumn(out, F.array(F.lit(0.0))).schema
    return df.select(*names).mapInArrow(run, schema)
