"""Evaluation operators (J1-J15) - grouped aggregations over long
``(order_id, target, y, active, hours, pred_hours)`` predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsheet.functions.stats import f1, precision, recall, rnd
from jobsheet.operators.prefix import exact_quantiles


def cascade_hours(active: Column, duration: Column) -> Column:
    """Inactive -> 0 hours, active -> max(0, predicted duration)."""
    return F.when(active, F.greatest(F.lit(0.0), duration)).otherwise(F.lit(0.0))


def confusion_counts(pred: DataFrame, group: Sequence[str], y: str = "y", active: str = "active") -> DataFrame:
    """Tp / fp / fn / tn per group."""
    yt, yp = F.col(y) == 1, F.col(active)
    return pred.groupBy(*group).agg(
        F.count_if(yt & yp).alias("tp"), F.count_if(~yt & yp).alias("fp"),
        F.count_if(yt & ~yp).alias("fn"), F.count_if(~yt & ~yp).alias("tn"))


def clf_metrics(pred: DataFrame, group: Sequence[str], y: str = "y", active: str = "active") -> DataFrame:
    """Accuracy, F1, recall, precision (zero division -> 0)."""
    c = confusion_counts(pred, group, y, active)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select(*group, "tp", "fp", "fn", "tn",
                    ((tp + tn) / (tp + fp + fn + tn)).alias("accuracy"),
                    f1(tp, fp, fn).alias("f1"), recall(tp, fn).alias("recall"),
                    precision(tp, fp).alias("precision"))


def regression_metrics(pred: DataFrame, group: Sequence[str], hours: str = "hours",
                       pred_hours: str = "pred_hours", min_n: int = 2) -> DataFrame:
    """J3 MAE over all rows; J4/J5 MAE, RMSE, MAE% on true positives (null
    when fewer than ``min_n``); J6 MAPE over y > 0."""
    y, yh = F.col(hours), F.col(pred_hours)
    e = F.abs(y - yh)
    pos = y > 0
    npos = F.count_if(pos)
    mae_pos = F.avg(F.when(pos, e))
    return pred.groupBy(*group).agg(
        F.avg(e).alias("mae_e2e"),
        npos.alias("n_pos"),
        F.when(npos >= min_n, mae_pos).alias("mae_pos"),
        F.when(npos >= min_n, F.sqrt(F.avg(F.when(pos, e * e)))).alias("rmse_pos"),
        F.when(npos >= min_n, mae_pos / (F.avg(F.when(pos, y)) + F.lit(1e-8)) * 100).alias("mae_pct_pos"),
        F.when(npos >= min_n, F.avg(F.when(pos, e / y)) * 100).alias("mape"))


def total_order_mae(pred: DataFrame, key: str = "order_id", group: Sequence[str] = (),
                    hours: str = "hours", pred_hours: str = "pred_hours") -> DataFrame:
    """MAE of the per-order totals and the medians of both totals."""
    t = pred.groupBy(*group, key).agg(F.sum(hours).alias("true_total"), F.sum(pred_hours).alias("pred_total"))
    mae = t.groupBy(*group).agg(F.avg(F.abs(F.col("true_total") - F.col("pred_total"))).alias("total_mae"))
    medians = [exact_quantiles(t, c, {f"median_{c}": 0.5}, group) for c in ("true_total", "pred_total")]
    if group:
        return mae.join(medians[0], list(group)).join(medians[1], list(group))
    return mae.select("total_mae", *[m.scalar().alias(m.columns[0]) for m in medians])


PER_TARGET_DIGITS = {"f1": 4, "recall": 4, "accuracy": 4, "precision": 4, "mae_e2e": 2}


def macro_and_fw(per_target: DataFrame, group: Sequence[str] = (), weight: str = "prevalence",
                 round_first: bool = True) -> DataFrame:
    """macro = plain mean over targets, fw = sum(w*m)/sum(w) with w the
    (unrounded) test prevalence; per-target metrics are rounded first when
    ``round_first`` (the original report's convention)."""
    aggs = []
    for m, d in PER_TARGET_DIGITS.items():
        v = rnd(F.col(m), d) if round_first else F.col(m)
        aggs += [F.avg(v).alias(f"macro_{m}"),
                 (F.sum(F.col(weight) * v) / F.sum(weight)).alias(f"fw_{m}")]
    return per_target.groupBy(*group).agg(*aggs)


def per_target_report(pred: DataFrame, group: Sequence[str], y: str = "y", active: str = "active") -> DataFrame:
    """J2 + J3 + prevalence per group (the rows of the evaluation report),
    all from ONE aggregation."""
    yt, yp = F.col(y) == 1, F.col(active)
    c = pred.groupBy(*group).agg(
        F.count_if(yt & yp).alias("tp"), F.count_if(~yt & yp).alias("fp"),
        F.count_if(yt & ~yp).alias("fn"), F.count_if(~yt & ~yp).alias("tn"),
        F.avg(F.abs(F.col("hours") - F.col("pred_hours"))).alias("mae_e2e"),
        F.avg(F.col(y).cast("double")).alias("prevalence"), F.sum(y).alias("n_pos"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select(*group, "tp", "fp", "fn", "tn", ((tp + tn) / (tp + fp + fn + tn)).alias("accuracy"),
                    f1(tp, fp, fn).alias("f1"), recall(tp, fn).alias("recall"),
                    precision(tp, fp).alias("precision"), "mae_e2e", "prevalence", "n_pos")


def metric_report_rows(per_target: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Per-target rows followed by MACRO and FREQ-WT rows (long form:
    row_label, metric, value)."""
    ms = list(PER_TARGET_DIGITS)
    rows = per_target.select(*group, F.col("target").alias("row_label"),
                             F.inline(F.array(*[F.struct(F.lit(m).alias("metric"),
                                                          rnd(F.col(m), PER_TARGET_DIGITS[m]).alias("value"))
                                                for m in ms])))
    agg = macro_and_fw(per_target, group)
    summ = agg.select(*group, F.inline(F.array(
        *[F.struct(F.lit("MACRO").alias("row_label"), F.lit(m).alias("metric"), F.col(f"macro_{m}").alias("value"))
          for m in ms],
        *[F.struct(F.lit("FREQ-WT").alias("row_label"), F.lit(m).alias("metric"), F.col(f"fw_{m}").alias("value"))
          for m in ms])))
    return rows.unionByName(summ)


def worst_errors(pred: DataFrame, k: int = 5, key: str = "order_id") -> DataFrame:
    """Top-k duration errors among true positives per target.

    ``row_number() <= k`` lets Spark insert a partial WindowGroupLimit
    before the shuffle, so each task forwards at most k rows per target.
    """
    tp = pred.where((F.col("y") == 1) & F.col("active")).withColumn(
        "abs_err", F.abs(F.col("hours") - F.col("pred_hours")))
    w = Window.partitionBy("target").orderBy(F.desc("abs_err"), F.asc(key))
    return tp.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "target", "rank", key, "hours", "pred_hours", "abs_err")


def delta_vs_baseline(model: DataFrame, baseline: DataFrame, on: Sequence[str] = ("target", "metric")) -> DataFrame:
    """Metric - baseline and % change, joined on (target, metric)."""
    j = model.withColumnRenamed("value", "value").join(
        baseline.withColumnRenamed("value", "baseline"), list(on))
    return j.withColumns({"delta": F.col("value") - F.col("baseline"),
                          "pct_change": F.when(F.col("baseline") != 0,
                                               (F.col("value") - F.col("baseline")) / F.abs(F.col("baseline")) * 100)})
