"""Stage 1 classifiers and stage 2 regressors (F1-F2, G1-G10, E5 within them).

All targets, and all learners asked for, are fitted together over one training set: a job
serves every open model at once (:mod:`~jobsheet.operators.boosting`, one
job per tree level; :mod:`~jobsheet.operators.linear`, one per iteration).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsheet.operators import thresholds as TH
from jobsheet.operators.boosting import Settings, Spec, fit_trees
from jobsheet.operators.linear import fit_linear
from jobsheet.operators.matrix import Constant, partitions_of, predict, row_blocks
from jobsheet.operators.text import Grams, Vocabulary, packed, vectorise


@dataclass
class LearnerConfig:
    gbt: Settings = field(default_factory=Settings)  # 300 rounds of 31 leaves, step 0.05
    gbt_min_rows: int = 20
    numeric_bins: int = 63
    text_bins: int = 8
    lr_max_iter: int = 1000
    lr_c: float = 1.0
    ridge_alpha: float = 10.0
    ridge_max_iter: int = 2000
    winsor_q: float = 0.95
    min_pos_for_model: int = 5


#: Learner names of stage 2: (family, objective, winsorised).
REGRESSORS = {
    "ridge": ("linear", "l2", False), "ridge_wins": ("linear", "l2", True),
    "lgbm": ("trees", "l2", False), "lgbm_l1": ("trees", "l1", False),
    "lgbm_wins": ("trees", "l2", True), "lgbm_l1_wins": ("trees", "l1", True),
    "mean_fallback": ("constant", "mean", False), "median_fallback": ("constant", "median", False),
}


class TrainingSet:
    """A written matrix (order_id, split, labels, idx, val) and what is counted on its training split once."""

    def __init__(self, matrix: DataFrame, targets: Sequence[str], features: Sequence[str], n_text: int):
        self.matrix, self.targets, self.features, self.n_text = matrix, tuple(targets), list(features), n_text
        self._blocks: RDD | None = None
        self._stats: list | None = None

    def split(self, name: str) -> DataFrame:
        return self.matrix.where(F.col("split") == name)

    def labels(self, name: str) -> DataFrame:
        return self.split(name).select("labels")

    def stats(self) -> list:
        """Per target: rows, positives, their mean, median and winsor cap (training split)."""
        if self._stats is None:
            cols = []
            for k, _ in enumerate(self.targets):
                y = F.when(F.get("labels", F.lit(k)) > 0, F.get("labels", F.lit(k)))
                cols.append(F.struct(F.count(F.lit(1)).alias("n"), F.count(y).alias("n_pos"), F.avg(y).alias("mean"),
                                     F.percentile(y, F.lit(0.5)).alias("median"), F.percentile(y, F.lit(0.95)).alias("cap")).alias(f"s{k}"))
            self._stats = list(self.labels("train").select(*cols).first())
        return self._stats

    def blocks(self) -> RDD:
        """The training rows as blocks in executors, until :meth:`close`."""
        if self._blocks is None:
            self._blocks = row_blocks(self.split("train"), len(self.targets), self.rows()).persist(StorageLevel.MEMORY_AND_DISK)
        return self._blocks

    def rows(self) -> int:
        """Training rows."""
        return self.stats()[0]["n"] if self.targets else 0

    def blocks_with(self, column: Column) -> RDD:
        """The training rows as blocks for one pass, with a number of each row as one more label."""
        d = self.split("train").withColumn("labels", F.concat("labels", F.array(column.cast("double"))))
        return row_blocks(d, len(self.targets) + 1, self.rows())

    def close(self) -> None:
        if self._blocks is not None:
            self._blocks.unpersist()
            self._blocks = None

    def most_bins(self, cfg: LearnerConfig):
        n_text, text, numeric = self.n_text, cfg.text_bins, cfg.numeric_bins
        return lambda f: text if f < n_text else numeric


class TextTrainingSet(TrainingSet):
    """A training set whose vectors are made when its rows (order_id, split, labels and what ``texts`` and ``numeric``
    read) are read: an order's text is a fraction of its vector, so the vectors are neither written nor shuffled."""

    def __init__(self, rows: DataFrame, texts: Sequence[tuple[Grams, Vocabulary]], numeric: Sequence[Column], targets: Sequence[str], features: Sequence[str], n_text: int):
        super().__init__(rows, targets, features, n_text)
        self._texts, self._numeric, self._held = list(texts), list(numeric), None

    def split(self, name: str) -> DataFrame:
        return vectorise(super().split(name), ["order_id", "split", "labels"], self._texts, self._numeric)

    def labels(self, name: str) -> DataFrame:
        return super().split(name).select("labels")

    def _packed(self, extra: Column | None = None):
        rows = super().split("train")
        if extra is not None:
            rows = rows.withColumn("labels", F.concat("labels", F.array(extra.cast("double"))))
        parts = partitions_of(self.rows(), rows.sparkSession.sparkContext.defaultParallelism)
        if rows.rdd.getNumPartitions() < parts:
            rows = rows.repartition(parts)
        blocks, unpack = packed(rows, self._texts, self._numeric, len(self.targets) + (extra is not None))
        return blocks.rdd.map(lambda r: bytes(r.block)).coalesce(parts), unpack

    def blocks(self) -> RDD:
        """The training rows, held as packed blocks and unpacked for each pass."""
        if self._blocks is None:
            held, unpack = self._packed()
            self._held = held.persist(StorageLevel.MEMORY_AND_DISK)
            self._blocks = self._held.map(unpack)
        return self._blocks

    def blocks_with(self, column: Column) -> RDD:
        blocks, unpack = self._packed(column)
        return blocks.map(unpack)

    def close(self) -> None:
        if self._held is not None:
            self._held.unpersist()
            self._held = self._blocks = None


def class_weight(n: int, n_pos: int) -> float:
    """E2 for one target: weight of its positives."""
    return max(1.0, (n - n_pos) / (n_pos + 1e-9))


def _occurrence(k: int, w_pos: float):
    def weigh(labels):
        y = (labels[:, k] > 0).astype(float)
        return y, np.where(y > 0, w_pos, 1.0)
    return weigh


def _hours(k: int, cap: float | None):
    def weigh(labels):
        y = labels[:, k]
        return (np.minimum(y, cap) if cap is not None else y), (y > 0).astype(float)
    return weigh


def _side_by_side(parts):
    def weigh(labels):
        both = [p(labels) for p in parts]
        return np.stack([y for y, _ in both], 1), np.stack([w for _, w in both], 1)
    return weigh


def fit_classifiers(ts: TrainingSet, kind: str, cfg: LearnerConfig | None = None) -> list:
    """F1 (``lgbm``) / F2 (``lr``): one occurrence model per target, positives weighted."""
    cfg = cfg or LearnerConfig()
    parts = [_occurrence(k, class_weight(s["n"], s["n_pos"])) for k, s in enumerate(ts.stats())]
    if kind == "lr":
        return fit_linear(ts.blocks(), "logistic", len(ts.features), np.full(len(parts), 1 / cfg.lr_c), _side_by_side(parts), cfg.lr_max_iter)
    if kind == "lgbm":
        return fit_trees(ts.blocks(), ts.stats()[0]["n"], len(ts.features), [Spec("binary", p, cfg.gbt_min_rows) for p in parts], ts.most_bins(cfg), cfg.gbt)
    raise ValueError(kind)


def fit_regressors(ts: TrainingSet, wanted: Sequence[tuple[str, str]], cfg: LearnerConfig | None = None) -> dict[tuple[str, str], object]:
    """Models of ``wanted`` (target, learner) pairs on the target's positives, all in one pass per step.

    Below ``min_pos_for_model`` positives a learner is replaced by the mean (0 without any)."""
    cfg = cfg or LearnerConfig()
    out: dict[tuple[str, str], object] = {}
    trees, lines = [], []
    for t, kind in wanted:
        k = ts.targets.index(t)
        s = ts.stats()[k]
        family, objective, wins = REGRESSORS[kind]
        if family == "constant" or s["n_pos"] < cfg.min_pos_for_model:
            out[t, kind] = Constant(float(s["median" if objective == "median" else "mean"] or 0.0))
        else:
            weigh = _hours(k, float(s["cap"]) if wins else None)
            if family == "trees":
                trees.append(((t, kind), Spec(objective, weigh, max(5, s["n_pos"] // 10))))
            else:
                lines.append(((t, kind), weigh))
    if trees:
        found = fit_trees(ts.blocks(), ts.stats()[0]["n"], len(ts.features), [x for _, x in trees], ts.most_bins(cfg), cfg.gbt)
        out |= {key: m for (key, _), m in zip(trees, found)}
    if lines:
        found = fit_linear(ts.blocks(), "squared", len(ts.features), np.full(len(lines), cfg.ridge_alpha), _side_by_side([x for _, x in lines]), cfg.ridge_max_iter)
        out |= {key: m for (key, _), m in zip(lines, found)}
    return out


# ------------------------------------------------------------------ validation
def occurrence_scores(ts: TrainingSet, models: Sequence, split: str = "val") -> DataFrame:
    """(order_id, target, y, hours, p) of a split."""
    scored = predict(ts.split(split).select("order_id", "labels", "idx", "val"), models, "scores")
    rows = F.transform(F.sequence(F.lit(0), F.lit(len(ts.targets) - 1)), lambda i: F.struct(
        F.get(F.array(*[F.lit(t) for t in ts.targets]), i).alias("target"), F.get("labels", i).alias("hours"), F.get("scores", i).alias("p")))
    return scored.select("order_id", F.inline(rows)).select("order_id", "target", (F.col("hours") > 0).cast("int").alias("y"), "hours", "p")


def tuned_thresholds(ts: TrainingSet, models: Sequence, scores: DataFrame | None = None) -> DataFrame:
    """F4 on the validation split; ``scores``: its occurrence scores, where they are written already."""
    return TH.best_f1_threshold(occurrence_scores(ts, models) if scores is None else scores, ["target"])


def val_maes(ts: TrainingSet, models: dict[tuple[str, str], object], split: str = "val") -> dict[tuple[str, str], float | None]:
    """MAE of max(0, prediction) on a split's positives, for every (target, learner), in one job; None without positives."""
    keys = list(models)
    if not keys:
        return {}
    scored = predict(ts.split(split).select("labels", "idx", "val"), [models[k] for k in keys], "scores")
    aggs = []
    for j, (t, _) in enumerate(keys):
        y = F.get("labels", F.lit(ts.targets.index(t)))
        aggs.append(F.avg(F.when(y > 0, F.abs(F.greatest(F.lit(0.0), F.get("scores", F.lit(j))) - y))).alias(f"m{j}"))
    row = scored.select(*aggs).first()
    return dict(zip(keys, row))


def ridge_auto(target: str, models: dict, maes: dict) -> tuple[object, str, float | None]:
    """The winsorised ridge where its validation MAE is smaller; plain wins ties and missing values."""
    plain, wins = (target, "ridge"), (target, "ridge_wins")
    if maes[plain] is not None and maes[wins] is not None and maes[wins] < maes[plain]:
        return models[wins], "winsorised", maes[wins]
    return models[plain], "plain", maes[plain]


def dispatch(ts: TrainingSet, best: dict[str, str], cfg: LearnerConfig | None = None) -> tuple[dict[str, object], dict[str, str], dict[str, float | None]]:
    """Each target's configured learner, fitted together; (model, choice, validation MAE) by target."""
    wanted = []
    for t in ts.targets:
        kind = best.get(t, "lgbm")
        wanted += [(t, "ridge"), (t, "ridge_wins")] if kind == "ridge_auto" else [(t, kind)]
    models = fit_regressors(ts, wanted, cfg)
    maes = val_maes(ts, models)
    chosen, choice, mae = {}, {}, {}
    for t in ts.targets:
        kind = best.get(t, "lgbm")
        if kind == "ridge_auto":
            chosen[t], how, mae[t] = ridge_auto(t, models, maes)
            choice[t] = "ridge" if how == "plain" else "ridge_wins"
        else:
            chosen[t], choice[t], mae[t] = models[t, kind], kind, maes[t, kind]
        if isinstance(chosen[t], Constant):
            choice[t] = "fallback"
    return chosen, choice, mae


def select_best_regressor(results: dict[str, float | None]) -> str:
    """Smallest validation MAE; ties and missing values keep the first listed."""
    found = [(m, k, name) for k, (name, m) in enumerate(results.items()) if m is not None]
    return min(found)[2] if found else next(iter(results))
