"""Histogram gradient boosting for many models at once (F1, G2, G3) as Spark jobs.

Setup, once: features are cut into bins (cuts from at most ``BIN_ROWS`` rows), every
value is replaced by its bin, features that can never be split (too few rows on one side) are
left out, and of features with equal bins in every row the first stands for all.

A round grows one tree for every model.  One job per tree level serves all models: each
task adds up the gradients and curvatures of its rows by (model, leaf, bin), the sums are dealt
by feature range, and each reducer finds the best cut of every leaf within its
range; a few numbers per leaf reach the driver.  The job that starts a round first applies the last
round's trees to the rows' scores.  Trees grow best-first to ``leaves`` leaves, up to ``batch``
splits per model and job.

What is shuffled per job is tasks x leaves x bins, whatever the number of rows.  Scores live
with the row blocks in executors and are checkpointed every ``CHECKPOINT`` rounds.

A model whose own rows have at most ``TOGETHER`` entries is one block: there is nothing to exchange, so
its rounds run in a task of their own, all such models side by side; only the smaller child of a
split is added up there, the larger is what is left of its parent.  Both ways
share the code that grows a tree; only where sums are added up differs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import RDD, StorageLevel

from jobsheet.operators.matrix import Rows, Trees

BIN_ROWS = 200_000
CHECKPOINT = 25
#: Entries (after binning) up to which a model's rows are one block: 6 bytes each, some 480 MB in a task.
TOGETHER = 80_000_000
#: Entries that are added up at a time there.
ADDED = 1 << 17
#: Values of one leaf that a task sends for a median; beyond, evenly spaced ones (rank error 1 / 1024 per task).
MEDIAN_POINTS = 512
REDUCERS = 4
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Spec:
    """One model: ``labels -> (y, weight)`` by row (weight 0 leaves the row out), loss and least rows in a leaf."""
    objective: str  # binary, l2 or l1
    weigh: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]
    min_rows: int = 20


@dataclass
class Settings:
    rounds: int = 300
    step: float = 0.05
    leaves: int = 31
    batch: int = 16
    min_curvature: float = 1e-3


@dataclass
class Bins:
    """Cuts per feature, features kept (the first of equal ones), and the layout of all their bins side by side."""
    cuts: dict[int, np.ndarray]
    kept: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    start: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # first bin of each kept feature; then the number of bins
    zero: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))   # bin of the value 0

    def lay_out(self, kept) -> Bins:
        kept = np.array(sorted(kept), np.int64)
        sizes = np.array([len(self.cuts[f]) + 1 for f in kept], np.int64)
        start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        zero = start[:-1] + np.array([np.searchsorted(self.cuts[f], 0.0) for f in kept], np.int64)
        return Bins({int(f): self.cuts[f] for f in kept}, kept, start, zero)


# ------------------------------------------------------------------ cuts
def cuts_of(values: np.ndarray, zeros: int, most: int) -> np.ndarray:
    """At most ``most`` - 1 cuts: between all distinct values where they fit, else at even steps of the
    non-zero values' ranks; 0 has a bin of its own."""
    u, n = np.unique(values, return_counts=True)
    if zeros and not (u == 0).any():
        at = int(np.searchsorted(u, 0.0))
        u, n = np.insert(u, at, 0.0), np.insert(n, at, zeros)
    if len(u) > most:
        zero = u == 0
        rank = np.cumsum(np.where(zero, 0, n)) - np.where(zero, 0, n)
        group = rank * (most - 2) // max(1, int(n[~zero].sum()))
        key = np.where(zero, -1, group)
        last = np.flatnonzero((key[1:] != key[:-1]))
        return (u[last] + u[last + 1]) / 2
    return (u[:-1] + u[1:]) / 2


def _order(x: np.ndarray) -> np.ndarray:
    """Stable order; numbers of 16 bits are sorted by counting."""
    return np.argsort(x.astype(np.uint16) if len(x) and 0 <= x.min() and x.max() < 1 << 16 else x, kind="stable")


def _by_range(b: Rows, width: int):
    order = _order(b.index)
    index, value = b.index[order], b.value[order]
    for c in np.unique(index // width).tolist():
        lo, hi = np.searchsorted(index, [c * width, (c + 1) * width])
        yield c, (index[lo:hi], value[lo:hi])


def find_cuts(blocks: RDD, n_rows: int, most: Callable[[int], int], sample_rows: int = BIN_ROWS, width: int = 64) -> dict[int, np.ndarray]:
    share = min(1.0, sample_rows / max(n_rows, 1))
    used = blocks.sample(False, share, 42) if share < 1 else blocks  # whole blocks
    seen = used.map(lambda b: b.n).sum()

    def cut(part):
        _, found = part
        found = list(found)
        index, value = np.concatenate([i for i, _ in found]), np.concatenate([v for _, v in found])
        order = np.argsort(index, kind="stable")
        index, value = index[order], value[order]
        for f in np.unique(index).tolist():
            lo, hi = np.searchsorted(index, [f, f + 1])
            yield f, cuts_of(value[lo:hi], seen - (hi - lo), most(f))
    cuts = used.flatMap(lambda b: _by_range(b, width)).groupByKey(blocks.getNumPartitions()).flatMap(cut).collect()  # bounded by features x bins
    return {int(f): c for f, c in cuts if len(c)}


def gradients(objective: str, y: np.ndarray, w: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if objective == "binary":
        p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
        return w * (p - y), w * p * (1 - p)
    return w * (np.sign(z - y) if objective == "l1" else z - y), w


# ------------------------------------------------------------------ binned blocks
@dataclass
class Binned:
    """Entries sorted by bin, and for each model y, weight and score of each row."""
    row: np.ndarray
    bin: np.ndarray
    y: np.ndarray
    weight: np.ndarray
    score: np.ndarray

    def gradients(self, specs: Sequence[Spec], m: int) -> tuple[np.ndarray, np.ndarray]:
        return gradients(specs[m].objective, self.y[:, m], self.weight[:, m], self.score[:, m])

    def column(self, bins: Bins, f: int) -> np.ndarray:
        """The bin of every row in kept feature ``f``."""
        lo, hi = np.searchsorted(self.bin, [bins.start[f], bins.start[f + 1]])
        out = np.full(len(self.y), bins.zero[f])
        out[self.row[lo:hi]] = self.bin[lo:hi]
        return out

    def leaves(self, bins: Bins, tree: Tree) -> np.ndarray:
        node = np.zeros(len(self.y), np.int64)
        for k, f in enumerate(tree.feature):  # a child comes after its parent
            if f >= 0:
                here = node == k
                node[here] = np.where(self.column(bins, f)[here] <= tree.bin[k], tree.left[k], tree.right[k])
        return node


@dataclass
class Tree:
    """A tree over bins while it grows; -1: a leaf."""
    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    gain: list[float] = field(default_factory=lambda: [0.0])
    sums: list[tuple[float, float]] = field(default_factory=lambda: [(0.0, 0.0)])
    value: list[float] = field(default_factory=lambda: [0.0])
    best: dict[int, tuple] = field(default_factory=dict)  # leaf -> its best split, where known

    def n_leaves(self) -> int:
        return (len(self.feature) + 1) // 2

    def split(self, k: int) -> tuple[int, int]:
        gain, f, at, gl, hl = self.best.pop(k)
        g, h = self.sums[k]
        kids = len(self.feature), len(self.feature) + 1
        self.feature[k], self.bin[k], self.left[k], self.right[k], self.gain[k] = f, at, *kids, gain
        for sums in ((gl, hl), (g - gl, h - hl)):
            self.feature.append(-1)
            self.bin.append(0)
            self.left.append(-1)
            self.right.append(-1)
            self.gain.append(0.0)
            self.sums.append(sums)
            self.value.append(0.0)
        return kids


def _column_sums(blocks: RDD, cuts: dict[int, np.ndarray], features: int) -> tuple[np.ndarray, np.ndarray]:
    """For each feature the rows outside the bin of 0, and a hash of all its bins (two words)."""
    def part(k, found):
        count, marks = np.zeros(features, np.int64), np.zeros((2, features), np.uint64)
        at = 0
        for b in found:
            local = _local_bins(b, cuts)
            keep = local != 0
            uid = (np.uint64(k) << np.uint64(40)) + (b.row_of_entry()[keep] + at).astype(np.uint64)
            x = (uid * np.uint64(1024) + (local[keep] + 512).astype(np.uint64)) * _MIX
            x ^= x >> np.uint64(31)
            index = b.index[keep]
            count += np.bincount(index, minlength=features)
            for j, salt in enumerate((0xBF58476D1CE4E5B9, 0x94D049BB133111EB)):
                z = x * np.uint64(salt)
                np.add.at(marks[j], index, z ^ (z >> np.uint64(29)))
            at += b.n
        yield count, marks
    return blocks.mapPartitionsWithIndex(part).treeReduce(lambda a, b: (a[0] + b[0], a[1] + b[1]), depth=2 if blocks.getNumPartitions() > 64 else 1)


def _local_bins(b: Rows, cuts: dict[int, np.ndarray]) -> np.ndarray:
    """Each entry's bin, counted from the bin of 0; 0 for features without cuts."""
    order = _order(b.index)
    index, value = b.index[order], b.value[order]
    out = np.zeros(len(index), np.int64)
    f, first = np.unique(index, return_index=True)
    for k, lo, hi in zip(f.tolist(), first.tolist(), [*first[1:].tolist(), len(index)]):
        if k in cuts:
            out[lo:hi] = np.searchsorted(cuts[k], value[lo:hi]) - np.searchsorted(cuts[k], 0.0)
    back = np.empty_like(out)
    back[order] = out
    return back


def choose_features(blocks: RDD, cuts: dict[int, np.ndarray], features: int, least: int) -> list[int]:
    """Features that can be split, the first of those with equal bins in every row."""
    count, marks = _column_sums(blocks, cuts, features)
    seen, kept = set(), []
    for f in sorted(cuts):
        key = (int(marks[0, f]), int(marks[1, f]))
        if count[f] >= max(1, least) and key not in seen:  # one side of a cut has none of the other rows
            seen.add(key)
            kept.append(f)
    return kept


def _bin_block(b: Rows, bins: Bins, specs: Sequence[Spec], base: np.ndarray) -> Binned:
    place = np.searchsorted(bins.kept, b.index)
    place = np.minimum(place, max(len(bins.kept) - 1, 0))
    keep = bins.kept[place] == b.index if len(bins.kept) else np.zeros(len(b.index), bool)
    local = _local_bins(b, bins.cuts)[keep]
    at = bins.zero[place[keep]] + local
    order = _order(at)
    both = [s.weigh(b.labels) for s in specs]
    y, w = np.stack([p[0] for p in both], 1), np.stack([p[1] for p in both], 1)
    kind = np.uint16 if b.n < 1 << 16 else np.int32
    return Binned(b.row_of_entry()[keep][order].astype(kind), at[order].astype(np.int32), y, w, np.tile(base, (b.n, 1)))


# ------------------------------------------------------------------ one level of all trees
def _histograms(bins: Bins, specs: Sequence[Spec], trees: list[Tree], open_: list[list[int]], ranges: np.ndarray):
    """Task side: sums by (model, open leaf, bin), dealt by range of bins, with the leaves' totals."""
    nb = int(bins.start[-1])
    base = np.cumsum([0] + [len(o) for o in open_])

    def part(found):
        hist, totals = np.zeros((base[-1], 2, nb), np.float32), np.zeros((base[-1], 3))
        for b in found:
            for m, leaves in enumerate(open_):
                if not leaves:
                    continue
                slot_of = np.full(len(trees[m].feature), -1)
                slot_of[leaves] = np.arange(len(leaves))
                slot = np.where(b.weight[:, m] > 0, slot_of[b.leaves(bins, trees[m])], -1)
                g, h = b.gradients(specs, m)
                used = slot >= 0
                k = len(leaves)
                totals[base[m]:base[m + 1]] += np.stack([np.bincount(slot[used], x[used], k) for x in (g, h, np.ones_like(g))], 1)
                if used.all():
                    row, at = b.row, b.bin
                else:
                    mask = used[b.row]
                    row, at = b.row[mask], b.bin[mask]
                key = (slot * nb)[row] + at
                for j, x in enumerate((g, h)):
                    hist[base[m]:base[m + 1], j] += np.bincount(key, x[row], k * nb).reshape(k, nb)
        for r in range(len(ranges) - 1):
            yield r, (hist[:, :, bins.start[ranges[r]]:bins.start[ranges[r + 1]]].copy(), totals)
    return part


def _add(a, b):
    return a[0] + b[0], a[1] + b[1]


def best_cuts(hist: np.ndarray, totals: np.ndarray, start: np.ndarray, zero: np.ndarray, least: np.ndarray, min_curvature: float):
    """For each leaf the best (gain, feature, bin, left sums) within these features; bins and features count from the range's first.

    ``hist`` lacks the rows whose value is 0: they are what is left of the leaf's totals."""
    hist = hist.astype(np.float64)
    sums = np.add.reduceat(hist, start[:-1], axis=2)
    hist[:, :, zero] += totals[:, :2, None] - sums
    owner = np.repeat(np.arange(len(start) - 1), np.diff(start))
    left = np.cumsum(hist, 2) - totals[:, :2, None] * owner
    g, h, n = (totals[:, j, None] for j in range(3))
    gl, hl = left[:, 0], left[:, 1]
    gr, hr = g - gl, h - hl
    rows = np.where(h > 0, n / np.where(h > 0, h, 1), 0)  # rows per unit of curvature
    ok = (hl >= min_curvature) & (hr >= min_curvature) & (np.rint(hl * rows) >= least[:, None]) & (np.rint(hr * rows) >= least[:, None])
    ok[:, start[1:] - 1] = False  # nothing is right of a feature's last bin
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(ok, gl * gl / hl + gr * gr / hr - g * g / h, -1.0)
    at = gain.argmax(1)
    s = np.arange(len(at))
    return [(float(gain[k, a]), int(owner[a]), int(a), float(gl[k, a]), float(hl[k, a])) for k, a in zip(s, at)]


def _medians(bins: Bins, specs, trees: list[Tree], which: list[int]):
    def part(found):
        for b in found:
            for m in which:
                leaf = b.leaves(bins, trees[m])
                rest = b.y[:, m] - b.score[:, m]
                used = b.weight[:, m] > 0
                for k in np.unique(leaf[used]).tolist():
                    yield (m, k), _points(rest[used & (leaf == k)])
    return part


def _points(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most ``MEDIAN_POINTS`` of a leaf's values, with their weights."""
    v, n = np.sort(v), len(v)
    if n > MEDIAN_POINTS:
        v = v[((np.arange(MEDIAN_POINTS) + 0.5) * n / MEDIAN_POINTS).astype(int)]
    return v, np.full(len(v), n / len(v))


def weighted_median(v: np.ndarray, w: np.ndarray) -> float:
    order = np.argsort(v, kind="stable")
    v, cum = v[order], np.cumsum(w[order])
    half = cum[-1] / 2
    lo = int(np.searchsorted(cum, half * (1 - 1e-12)))
    hi = int(np.searchsorted(cum, half * (1 + 1e-12), side="right"))
    return float((v[lo] + v[min(hi, len(v) - 1)]) / 2)


def _joined(a, b):
    return np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])


# ------------------------------------------------------------------ rounds
class _Engine:
    """Where the rows are: adds up histograms, finds medians, moves scores."""

    def level(self, trees, open_, need):  # -> ([(best splits, totals) for each range of bins])
        raise NotImplementedError

    def medians(self, trees, which) -> dict:
        raise NotImplementedError

    def move(self, trees, live, round_) -> None:
        raise NotImplementedError


def _reduced(bins: Bins, ranges: np.ndarray, min_curvature: float, need: np.ndarray):
    def reduce_(found):
        for r, (hist, totals) in found:
            lo, hi = ranges[r], ranges[r + 1]
            first = bins.start[lo]
            best = best_cuts(hist, totals, bins.start[lo:hi + 1] - first, bins.zero[lo:hi] - first, need, min_curvature)
            yield [(g, f + int(lo), a + int(first), gl, hl) for g, f, a, gl, hl in best], totals
    return reduce_


def _moved(b: Binned, bins: Bins, trees: list[Tree], live: list[int]) -> np.ndarray:
    score = b.score.copy()
    for m in live:
        score[:, m] += np.array(trees[m].value)[b.leaves(bins, trees[m])]
    return score


class _Together(_Engine):
    """All rows of one model in this task: their bins row by row, and the rows of each bin."""

    def __init__(self, parts: Sequence[tuple], bins: Bins, spec: Spec, s: Settings):
        self.bins, self.objective, self.s = bins, spec.objective, s
        self.ranges = np.array([0, len(bins.kept)])
        self.size, self.by_row, self.y, self.weight, self.score = (np.concatenate(c) for c in zip(*parts))
        self.first = np.cumsum(self.size, dtype=np.int64) - self.size
        self.unit = spec.objective != "binary" and bool((self.weight == 1).all())  # curvatures are counts
        self.all_rows = np.arange(len(self.size), dtype=np.int32)
        self.rows, self.hist, self.counts = {0: self.all_rows}, {}, None
        self._by_bin()

    def _by_bin(self):
        """The rows of every bin, bin after bin."""
        nb, ends = int(self.bins.start[-1]), np.cumsum(self.size, dtype=np.int64)
        self.at_bin = np.zeros(nb + 1, np.int64)
        for lo in range(0, len(self.by_row), ADDED):
            self.at_bin[1:] += np.bincount(self.by_row[lo:lo + ADDED], minlength=nb)
        self.at_bin = np.cumsum(self.at_bin)
        self.of_bin, free = np.empty(len(self.by_row), np.int32), self.at_bin[:-1].copy()
        for lo in range(0, len(self.by_row), ADDED):
            own = self.by_row[lo:lo + ADDED]
            order = np.argsort(own, kind="stable")
            n = np.bincount(own, minlength=nb)
            row = np.searchsorted(ends, np.arange(lo, lo + len(own)), side="right")
            self.of_bin[np.arange(len(own)) + np.repeat(free - (np.cumsum(n) - n), n)] = row[order]
            free += n

    def _sums(self, rows: np.ndarray) -> np.ndarray:
        """Gradients and curvatures of these rows by bin."""
        nb, whole = int(self.bins.start[-1]), len(rows) == len(self.size)
        out = np.zeros((2, nb))
        counted = self.unit and whole and self.counts is not None  # those of all rows are the same in every round
        cut = np.searchsorted(np.cumsum(self.size[rows], dtype=np.int64), np.arange(ADDED, self.size[rows].sum(dtype=np.int64) + ADDED, ADDED), side="left") + 1
        for lo, hi in zip([0, *cut[:-1].tolist()], cut.tolist()):
            own = rows[lo:hi]
            if not len(own):
                continue
            size = self.size[own].astype(np.int64)
            if whole:
                at = self.by_row[self.first[own[0]]:self.first[own[-1]] + size[-1]].astype(np.intp)
            else:
                at = self.by_row[np.arange(size.sum()) + np.repeat(self.first[own] - (np.cumsum(size) - size), size)].astype(np.intp)
            out[0] += np.bincount(at, np.repeat(self.g[own], size), nb)
            if self.unit and not counted:
                out[1] += np.bincount(at, minlength=nb)
            elif not self.unit:
                out[1] += np.bincount(at, np.repeat(self.h[own], size), nb)
        if self.unit and whole:
            self.counts = out[1].copy() if self.counts is None else self.counts
            out[1] = self.counts
        return out

    def _kids(self, tree: Tree, k: int) -> list[tuple[int, np.ndarray]]:
        """The children of a split leaf and their rows."""
        rows, f, at = self.rows.pop(k), tree.feature[k], tree.bin[k]
        lo, hi = int(self.bins.start[f]), int(self.bins.start[f + 1])
        zero_left = self.bins.zero[f] <= at
        here = (at + 1, hi) if zero_left else (lo, at + 1)  # the bins on the side without 0
        mark = np.zeros(len(self.size), bool)
        mark[self.of_bin[self.at_bin[here[0]]:self.at_bin[here[1]]]] = True
        mark = mark[rows]
        left = ~mark if zero_left else mark
        return [(tree.left[k], rows[left]), (tree.right[k], rows[~left])]

    def level(self, trees, open_, need):
        tree, leaves = trees[0], open_[0]
        if leaves == [0]:
            self.g, self.h = gradients(self.objective, self.y, self.weight, self.score)
            self.rows = {0: self.all_rows}
            self.hist = {0: self._sums(self.all_rows)}
        for k in [k for k in self.rows if tree.feature[k] >= 0]:
            hist = self.hist.pop(k)
            (small, few), (large, many) = sorted(self._kids(tree, k), key=lambda x: len(x[1]))
            self.rows[small], self.rows[large] = few, many
            self.hist[small] = self._sums(few)
            self.hist[large] = hist - self.hist[small]
        totals = np.array([[x[r].sum() for x in (self.g, self.h)] + [len(r)] for r in (self.rows[k] for k in leaves)], float)
        found = 0, (np.stack([self.hist[k] for k in leaves]).astype(np.float32), totals)  # as sums that are sent are
        return list(_reduced(self.bins, self.ranges, self.s.min_curvature, need)([found]))

    def _leaves(self, tree: Tree) -> dict[int, np.ndarray]:
        if len(tree.feature) == 1:
            return {0: self.all_rows}
        for k in [k for k in self.rows if tree.feature[k] >= 0]:  # the last splits
            self.rows.update(self._kids(tree, k))
        return self.rows

    def medians(self, trees, which):
        return {(m, k): weighted_median(*_points(self.y[rows] - self.score[rows])) for m in which for k, rows in self._leaves(trees[m]).items() if len(rows)}

    def move(self, trees, live, round_):
        for m in live:
            for k, rows in self._leaves(trees[m]).items():
                self.score[rows] += trees[m].value[k]


class _Apart(_Engine):
    """Rows in blocks over the executors."""

    def __init__(self, data: RDD, bins: Bins, specs: list[Spec], s: Settings):
        self.data, self.bins, self.specs, self.s = data.persist(StorageLevel.MEMORY_AND_DISK), bins, specs, s
        marks = np.searchsorted(bins.start, bins.start[-1] * np.arange(REDUCERS + 1) / REDUCERS)
        self.ranges = np.unique(np.concatenate([[0], np.minimum(marks, len(bins.kept)), [len(bins.kept)]]))
        self._old: RDD | None = None

    def level(self, trees, open_, need):
        sums = self.data.mapPartitions(_histograms(self.bins, self.specs, trees, open_, self.ranges)).reduceByKey(_add, len(self.ranges) - 1)
        return sums.mapPartitions(_reduced(self.bins, self.ranges, self.s.min_curvature, need)).collect()  # a few numbers for each leaf and range

    def medians(self, trees, which):
        found = self.data.mapPartitions(_medians(self.bins, self.specs, trees, which)).reduceByKey(_joined, REDUCERS)
        return dict(found.mapValues(lambda p: weighted_median(*p)).collect())

    def move(self, trees, live, round_):
        """The rows with new scores; the generation before the last is given up."""
        bins = self.bins
        new = self.data.map(lambda b: Binned(b.row, b.bin, b.y, b.weight, _moved(b, bins, trees, live))).persist(StorageLevel.MEMORY_AND_DISK)
        if (round_ + 1) % CHECKPOINT == 0:
            new.checkpoint()
            new.count()
        if self._old is not None:
            self._old.unpersist()
        self._old, self.data = self.data, new

    def close(self):
        for d in (self._old, self.data):
            if d is not None:
                d.unpersist()


def _grow(engine: _Engine, specs: Sequence[Spec], s: Settings, trees: list[Tree], done: np.ndarray) -> None:
    open_ = [[] if d else [0] for d in done]
    least = np.array([x.min_rows for x in specs])
    while any(open_):
        found = engine.level(trees, open_, np.repeat(least, [len(o) for o in open_]))
        totals = found[0][1]
        slot = 0
        for m, leaves in enumerate(open_):
            for k in leaves:
                trees[m].sums[k] = (float(totals[slot, 0]), float(totals[slot, 1]))
                best = max((b[slot] for b, _ in found), key=lambda x: (x[0], -x[2]))
                if best[0] > 1e-12:
                    trees[m].best[k] = best
                slot += 1
        open_ = []
        for t in trees:
            room = s.leaves - t.n_leaves()
            top = sorted(t.best, key=lambda k: (-t.best[k][0], k))[:min(room, s.batch)]
            kids = [c for k in top for c in t.split(k)]
            open_.append(kids if t.n_leaves() < s.leaves else [])


def _rounds(engine: _Engine, specs: Sequence[Spec], bins: Bins, s: Settings, base: np.ndarray) -> list[Trees]:
    """All rounds; scores start at ``base``, for absolute loss moved on to the median."""
    l1 = [m for m, x in enumerate(specs) if x.objective == "l1"]
    base = base.copy()
    if l1:
        stumps = [Tree() for _ in specs]
        for (m, _), v in engine.medians(stumps, l1).items():
            stumps[m].value[0] = v
            base[m] += v
        engine.move(stumps, l1, 0)
    grown: list[list[Tree]] = [[] for _ in specs]
    done = np.array([not len(bins.kept)] * len(specs))
    for round_ in range(s.rounds):
        if done.all():
            break
        trees = [Tree() for _ in specs]
        _grow(engine, specs, s, trees, done)
        which = [m for m in l1 if len(trees[m].feature) > 1]
        medians = engine.medians(trees, which) if which else {}
        for m, t in enumerate(trees):
            if len(t.feature) == 1:  # nothing to split: no later round would find more
                done[m] = True
                continue
            for k, f in enumerate(t.feature):
                if f < 0:
                    g, h = t.sums[k]
                    t.value[k] = s.step * (medians.get((m, k), 0.0) if m in l1 else -g / h if h > 0 else 0.0)
            t.best = {}
            grown[m].append(t)
        engine.move(trees, [m for m in range(len(specs)) if not done[m]], round_)
    return [_flat(bins, specs[m].objective == "binary", float(base[m]), grown[m]) for m in range(len(specs))]


def _flat(bins: Bins, logistic: bool, base: float, grown: list[Tree]) -> Trees:
    feature, cut, left, right, value, gain, roots = [], [], [], [], [], [], []
    for t in grown:
        at = len(feature)
        roots.append(at)
        for k, f in enumerate(t.feature):
            real = int(bins.kept[f]) if f >= 0 else -1
            feature.append(real)
            cut.append(float(bins.cuts[real][t.bin[k] - bins.start[f]]) if f >= 0 else 0.0)
            left.append(t.left[k] + at)
            right.append(t.right[k] + at)
            value.append(t.value[k])
            gain.append(t.gain[k])
    return Trees(base, np.array(feature, np.int64), np.array(cut, float), np.array(left, np.int64), np.array(right, np.int64),
                 np.array(value, float), np.array(gain, float), np.array(roots, np.int64), logistic)


def _start(blocks: RDD, specs: Sequence[Spec]) -> np.ndarray:
    """Log odds, or mean; 0 for absolute loss (its median is found on the binned rows)."""
    def part(found):
        total = np.zeros((len(specs), 2))
        for b in found:
            for m, s in enumerate(specs):
                y, w = s.weigh(b.labels)
                total[m] += [(w * y).sum(), w.sum()]
        yield total
    total = blocks.mapPartitions(part).sum()
    base = np.zeros(len(specs))
    for m, s in enumerate(specs):
        mean = total[m, 0] / total[m, 1] if total[m, 1] else 0.0
        if s.objective == "binary":
            base[m] = np.log(mean / (1 - mean)) if 0 < mean < 1 else 0.0
        elif s.objective == "l2":
            base[m] = mean
    return base


def _of_model(b: Binned, m: int, bins: int) -> tuple:
    """The rows that model ``m`` learns from: entries of each, bins row by row, y, weight, score."""
    used = b.weight[:, m] > 0
    order = _order(b.row)
    order = order[used[b.row[order]]]
    size = np.bincount(b.row, minlength=len(used))[used].astype(np.int32)
    return size, b.bin[order].astype(np.uint16 if bins <= 1 << 16 else np.int32), b.y[used, m], b.weight[used, m], b.score[used, m]


def fit_trees(blocks: RDD, n_rows: int, features: int, specs: Sequence[Spec], most_bins: Callable[[int], int] = lambda f: 63,
              settings: Settings | None = None, together: int = TOGETHER) -> list[Trees]:
    """One boosted model for every spec, all in lock step (or side by side, see above)."""
    s, specs = settings or Settings(), list(specs)
    cuts = find_cuts(blocks, n_rows, most_bins)
    bins = Bins(cuts).lay_out(choose_features(blocks, cuts, features, min(x.min_rows for x in specs)))
    base = _start(blocks, specs)
    data = blocks.map(lambda b: _bin_block(b, bins, specs, base))
    entries = data.map(lambda b: np.array([np.count_nonzero((b.weight[:, m] > 0)[b.row]) for m in range(len(specs))])).sum()
    small, large = ([m for m in range(len(specs)) if (entries[m] <= together) == fits] for fits in (True, False))
    found: dict[int, Trees] = {}
    if large:
        own = [specs[m] for m in large]
        engine = _Apart(blocks.map(lambda b: _bin_block(b, bins, own, base[large])), bins, own, s)
        try:
            found |= dict(zip(large, _rounds(engine, own, bins, s, base[large])))
        finally:
            engine.close()

    def alone(pair):
        m, parts = pair
        return m, _rounds(_Together(list(parts), bins, specs[m], s), [specs[m]], bins, s, base[[m]])[0]
    if small:
        dealt = data.flatMap(lambda b: [(m, _of_model(b, m, int(bins.start[-1]))) for m in small])
        found |= dict(dealt.groupByKey(len(small), small.index).map(alone).collect())  # one small model per spec
    return [found.get(m) or _flat(bins, specs[m].objective == "binary", float(base[m]), []) for m in range(len(specs))]
