"""Decision thresholds.

A threshold sweep over a fixed grid is ONE aggregation of the scores:
every score is mapped to the highest grid point it reaches, counted per
(group, grid point) with partial aggregation, and reverse cumulative sums
over that <= 100-row-per-group table give TP/FP at every threshold.  No
score is compared with every threshold (no cross join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsheet.functions.stats import f1, precision, recall

F1_GRID = (0.05, 0.95, 91)
RECALL_GRID = (0.01, 0.99, 99)


def grid_value(i: Column, start: float, stop: float, num: int) -> Column:
    """Grid point i of an evenly spaced grid; i*step + start, last = stop."""
    step = (stop - start) / (num - 1)
    return F.when(i == num - 1, F.lit(stop)).otherwise(i.cast("double") * F.lit(step) + F.lit(start))


def grid_bucket(p: Column, start: float, stop: float, num: int) -> Column:
    """max i with grid[i] <= p (-1 below the grid), comparing with the actual
    grid doubles so that p == grid[i] lands in bucket i."""
    step = (stop - start) / (num - 1)
    c = F.floor((p - F.lit(start)) / F.lit(step))
    c = (F.when(grid_value(c + 1, start, stop, num) <= p, c + 1)
         .when(grid_value(c, start, stop, num) > p, c - 1).otherwise(c))
    return F.when(c < -1, F.lit(-1)).when(c > num - 1, F.lit(num - 1)).otherwise(c).cast("int")


def sweep(scores: DataFrame, group: Sequence[str], grid=F1_GRID, y: str = "y", p: str = "p") -> DataFrame:
    """Confusion counts and metrics at every grid threshold, per group."""
    start, stop, num = grid
    group = list(group)
    b = scores.select(*group, grid_bucket(F.col(p), start, stop, num).alias("i"), F.col(y).alias("_y"))
    counts = b.groupBy(*group, "i").agg(F.count_if(F.col("_y") == 1).alias("pos"),
                                        F.count_if(F.col("_y") != 1).alias("neg"))
    full = counts.select(*group).distinct().select(*group, F.explode(F.sequence(F.lit(-1), F.lit(num - 1))).alias("i"))
    d = full.join(counts, [*group, "i"], "left").fillna(0, ["pos", "neg"])
    wrev = Window.partitionBy(*group).orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)
    wall = Window.partitionBy(*group)
    d = d.withColumns({"tp": F.sum("pos").over(wrev), "fp": F.sum("neg").over(wrev),
                       "P": F.sum("pos").over(wall), "N": F.sum("neg").over(wall)})
    d = d.where(F.col("i") >= 0).withColumns({"fn": F.col("P") - F.col("tp"), "tn": F.col("N") - F.col("fp")})
    return d.select(*group, "i", grid_value(F.col("i"), start, stop, num).alias("threshold"),
                    "tp", "fp", "fn", "tn",
                    f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"),
                    precision(F.col("tp"), F.col("fp")).alias("precision"),
                    recall(F.col("tp"), F.col("fn")).alias("recall"))


def best_f1_threshold(scores: DataFrame, group: Sequence[str], y: str = "y", p: str = "p") -> DataFrame:
    """F1-optimal threshold on 0.05..0.95; ties -> lowest threshold."""
    s = sweep(scores, group, F1_GRID, y, p)
    best = F.max_by(F.struct("threshold", "f1", "precision", "recall"), F.struct(F.col("f1"), -F.col("i")))
    return s.groupBy(*group).agg(best.alias("b")).select(*group, "b.*")


def recall_floor_threshold(scores: DataFrame, group: Sequence[str], min_recall: float = 0.9,
                           y: str = "y", p: str = "p") -> DataFrame:
    """highest precision with recall >= floor on 0.01..0.99; ties -> lowest
    threshold; none feasible -> 0.01 with status MIN_RECALL_UNACHIEVABLE."""
    s = sweep(scores, group, RECALL_GRID, y, p)
    ok = F.col("recall") >= min_recall
    g = s.groupBy(*group).agg(
        F.max_by(F.when(ok, F.struct("threshold", "precision", "recall")),
                 F.when(ok, F.struct(F.col("precision"), -F.col("i")))).alias("b"),
        F.count_if(ok).alias("_n_ok"))
    return g.select(*group,
                    F.coalesce(F.col("b.threshold"), F.lit(RECALL_GRID[0])).alias("threshold"),
                    F.col("b.precision").alias("precision"), F.col("b.recall").alias("recall"),
                    F.when(F.col("_n_ok") > 0, "OK").otherwise("MIN_RECALL_UNACHIEVABLE").alias("status"))


def _pr_counts(scores: DataFrame, group: Sequence[str], y: str, p: str) -> DataFrame:
    """Counts per distinct score with exact descending running sums
    (distributed; a group with many distinct scores spans range chunks)."""
    from jobsheet.operators.prefix import prefix_sums
    c = scores.groupBy(*group, F.col(p).alias("threshold")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    return prefix_sums(c, group, "threshold", ["pos", "neg"], descending=True)


def pr_points(scores: DataFrame, group: Sequence[str], y: str = "y", p: str = "p") -> DataFrame:
    """precision / recall at every distinct score (descending cut)."""
    c = _pr_counts(scores, group, y, p)
    tp, fp, P = F.col("cum_pos"), F.col("cum_neg"), F.col("tot_pos")
    return c.select(*group, "threshold", (tp / (tp + fp)).alias("precision"),
                    F.when(P > 0, tp / P).otherwise(F.lit(0.0)).alias("recall"))


def average_precision(scores: DataFrame, group: Sequence[str], y: str = "y", p: str = "p") -> DataFrame:
    """F8: AP = sum_n (R_n - R_{n-1}) P_n over distinct scores, descending;
    R_n - R_{n-1} is the cut's own positives / P, so no ordered window is
    needed after the running sums.  0 when a group has no positives."""
    c = _pr_counts(scores, group, y, p)
    tp, fp, P = F.col("cum_pos"), F.col("cum_neg"), F.col("tot_pos")
    term = F.when(P > 0, F.col("pos") / P * (tp / (tp + fp))).otherwise(F.lit(0.0))
    return c.groupBy(*group).agg(F.sum(term).alias("average_precision"))


def soft_vote(*probs: Column) -> Column:
    """mean of the model probabilities."""
    return sum(probs) / float(len(probs))


def select_best_model(metrics: DataFrame, group: Sequence[str], model: str = "model",
                      metric: str = "f1", priority: Sequence[str] = (), carry: Sequence[str] = ()) -> DataFrame:
    """per group the model with the highest metric; ties go to the model
    listed first in ``priority``.  ``carry`` columns travel with the winner
    (no join back)."""
    pr = F.array_position(F.array(*[F.lit(m) for m in priority]), F.col(model))
    return metrics.groupBy(*group).agg(
        F.max_by(F.struct(F.col(model).alias("model"), F.col(metric).alias(metric), *[F.col(c) for c in carry]),
                 F.struct(F.col(metric), -pr)).alias("b")).select(*group, "b.*")


def apply_threshold(scores: DataFrame, thresholds: DataFrame, on: Sequence[str], p: str = "p") -> DataFrame:
    """active = p >= threshold of (model, target).  The threshold table
    has one row per (model, target) - bounded by configuration."""
    j = scores.join(F.broadcast(thresholds), list(on))
    return j.withColumn("active", F.col(p) >= F.col("threshold"))
