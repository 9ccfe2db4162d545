"""Split (E*), threshold (F*) and evaluation (J*) queries with SQL oracles.

Classifier and regressor outputs come from deterministic *pseudo-scores*
derived from the order features (the time share of the target's cost
centre blended with an arithmetic hash of the order id), so every
threshold and metric operator is checkable against plain SQL without
training a model.  The learners themselves are in ``q_models``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsheet.config import part_catalog
from jobsheet.functions.stats import rnd
from jobsheet.operators import labels as L
from jobsheet.operators import metrics as J
from jobsheet.operators import positions as P
from jobsheet.operators import split as E
from jobsheet.operators import thresholds as TH
from jobsheet.plans import sqlbase as S
from jobsheet.plans.q_profile import ROLL
from jobsheet.plans.registry import query, round_doubles
from jobsheet.sources import order_view as V
from jobsheet.sources.sinks import kept

CFG = part_catalog()
r, big, q = S.r, S.big, S.q
MODELS = ("lr", "gbt", "ens")
STEP91 = (0.95 - 0.05) / 90
STEP99 = (0.99 - 0.01) / 98


# ====================================================================== Spark frames
def splits_frame(spark, sf, wide: DataFrame | None = None) -> DataFrame:
    """The split assignment, materialised once per call (a table in the
    shared checkpoint folder): every later branch reads it instead of
    re-deriving it, and the lineage is cut.  So are the roll-ups, which the
    split reads three times; ``wide``: the wide targets, where they are kept already."""
    roll = L.target_rollups(V.targets_wide(spark, sf, CFG) if wide is None else wide, CFG.targets)
    roll = roll.withColumn("band", L.complexity_band(F.col("n_active")))
    return kept(E.stratified_split(kept(roll, "rollups") if wide is None else roll, "band"), "splits")


def _u(k) -> "F.Column":
    return ((F.col("order_id") % 10007) * 7919 + k * 104729) % 10007 / 10007.0


def scored_orders(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(score table, wide targets, split assignment), each kept as a table: the score table is
    :func:`scores_wide`, whose cells are made from one row per order after all joins and when it is read."""
    wide = kept(V.targets_wide(spark, sf, CFG), "targets")
    splits = splits_frame(spark, sf, wide)
    clean = P.clean_positions(V.positions(spark, sf), CFG)
    times = ["total_time", *[f"time_{t}" for t in CFG.targets]]  # all that the scores need of the features
    feats = V.order_keys(spark, sf).join(P.order_aggregates(clean, CFG).select("order_id", *times), "order_id", "left").fillna(0.0, times)
    d = wide.join(splits.select("order_id", "split"), "order_id").join(feats, "order_id")
    cols = []
    for i, t in enumerate(CFG.targets):
        time_t = F.col(f"time_{t}")
        share = F.when(F.col("total_time") > 0, time_t / F.col("total_time")).otherwise(F.lit(0.0))
        cols += [F.col(t).alias(f"hours_{t}"), (time_t / 10.0).alias(f"dur_{t}"),
                 rnd(0.6 * share + 0.4 * _u(F.lit(i)), 4).alias(f"p_lr_{t}"), rnd(0.4 * share + 0.6 * _u(F.lit(i + 17)), 4).alias(f"p_gbt_{t}")]
    rows = kept(d.select("order_id", "split", *cols), "scores")
    cells = [F.struct(F.lit(t).alias("target"), (F.col(f"hours_{t}") > 0).cast("int").alias("y"),
                      *[F.col(f"{c}_{t}").alias(c) for c in ("hours", "dur", "p_lr", "p_gbt")]) for t in CFG.targets]
    return rows.select("order_id", "split", F.inline(F.array(*cells))), wide, splits


def scores_wide(spark, sf) -> DataFrame:
    """(order_id, split, target, y, hours, dur, p_lr, p_gbt)."""
    return scored_orders(spark, sf)[0]


def scores_long(spark, sf, wide: DataFrame | None = None) -> DataFrame:
    w = scores_wide(spark, sf) if wide is None else wide
    arr = F.array(F.struct(F.lit("lr").alias("model"), F.col("p_lr").alias("p")),
                  F.struct(F.lit("gbt").alias("model"), F.col("p_gbt").alias("p")),
                  F.struct(F.lit("ens").alias("model"), TH.soft_vote(F.col("p_lr"), F.col("p_gbt")).alias("p")))
    return w.select("order_id", "split", "target", "y", "hours", "dur", F.inline(arr))


def best_thresholds(spark, sf, scores: DataFrame | None = None) -> DataFrame:
    """``scores``: the score table where it is already there (building it writes three tables)."""
    scores = scores_long(spark, sf) if scores is None else scores
    return TH.best_f1_threshold(scores.where(F.col("split") == "val"), ["model", "target"])


def chosen(spark, sf, scores: DataFrame | None = None) -> DataFrame:
    """F6 winner per target with its F1-optimal threshold."""
    bt = best_thresholds(spark, sf, scores)
    return TH.select_best_model(bt, ["target"], priority=MODELS, carry=("threshold",))


def test_predictions(spark, sf, scores: DataFrame | None = None) -> DataFrame:
    scores = scores_long(spark, sf) if scores is None else scores
    test = scores.where(F.col("split") == "test")
    ch = chosen(spark, sf, scores).select("model", "target", "threshold")
    p = TH.apply_threshold(test, ch, ["model", "target"])
    return p.withColumn("pred_hours", J.cascade_hours(F.col("active"), F.col("dur")))


# ====================================================================== SQL chain
def _case(col_fmt: str) -> str:
    return "CASE tl.target " + " ".join(f"WHEN {q(t)} THEN {col_fmt.format(t=t, i=i)}"
                                       for i, t in enumerate(CFG.targets)) + " END"


SPLIT = """
sp0 AS (SELECT order_id, n_active, total_hours,
               CASE WHEN n_active <= 3 THEN 'low' WHEN n_active <= 6 THEN 'medium'
                    WHEN n_active <= 9 THEN 'high' ELSE 'very_high' END AS band FROM roll),
sp1 AS (SELECT *, CASE WHEN (SELECT min(c) FROM (SELECT count(*) AS c FROM sp0 GROUP BY band)) < 2
                       THEN 'all' ELSE band END AS stratum FROM sp0),
sp2 AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5(CAST(order_id AS VARCHAR))) - 1 AS rk,
               count(*) OVER (PARTITION BY stratum) AS n FROM sp1),
split AS (SELECT order_id, n_active, total_hours, band,
                 CASE WHEN rk < 0.2::DOUBLE * n THEN 'test' WHEN rk < 0.4::DOUBLE * n THEN 'val'
                      ELSE 'train' END AS split FROM sp2)"""


def _u_sql(k: str) -> str:
    return f"(((order_id % 10007) * 7919 + ({k}) * 104729) % 10007 / 10007.0::DOUBLE)"


def scores_sql() -> str:
    return f"""
b0 AS (SELECT tl.order_id, s.split, tl.target, CAST(tl.hours > 0 AS INTEGER) AS y, tl.hours,
              {_case('f.time_{t}')} AS time_t, {_case('{i}')} AS tidx, f.total_time
       FROM tl JOIN split s ON tl.order_id = s.order_id JOIN feat f ON tl.order_id = f.order_id),
b1 AS (SELECT *, CASE WHEN total_time > 0 THEN time_t / total_time ELSE 0.0 END AS share FROM b0),
scw AS (SELECT order_id, split, target, y, hours, time_t / 10.0::DOUBLE AS dur,
               {S.r('0.6::DOUBLE * share + 0.4::DOUBLE * ' + _u_sql('tidx'), 4)} AS p_lr,
               {S.r('0.4::DOUBLE * share + 0.6::DOUBLE * ' + _u_sql('tidx + 17'), 4)} AS p_gbt FROM b1),
sc AS (SELECT order_id, split, target, y, hours, dur, 'lr' AS model, p_lr AS p FROM scw UNION ALL
       SELECT order_id, split, target, y, hours, dur, 'gbt', p_gbt FROM scw UNION ALL
       SELECT order_id, split, target, y, hours, dur, 'ens', (p_lr + p_gbt) / 2 FROM scw)"""


def grid_sql(name: str, start: float, stop: float, num: int) -> str:
    step = (stop - start) / (num - 1)
    return (f"\n{name} AS (SELECT i, CASE WHEN i = {num - 1} THEN {stop!r}::DOUBLE "
            f"ELSE i * {step!r}::DOUBLE + {start!r}::DOUBLE END AS thr FROM range(0, {num}) t(i))")


def sweep_sql(name: str, src: str, grid: str) -> str:
    """Naive oracle sweep: every score against every grid threshold."""
    return f"""
{name} AS (
  SELECT s.model, s.target, g.i, g.thr,
         count_if(s.p >= g.thr AND s.y = 1) AS tp, count_if(s.p >= g.thr AND s.y <> 1) AS fp,
         count_if(s.p < g.thr AND s.y = 1) AS fn
  FROM {src} s CROSS JOIN {grid} g GROUP BY s.model, s.target, g.i, g.thr),
{name}m AS (
  SELECT *, CASE WHEN 2*tp+fp+fn > 0 THEN 2.0*tp/(2*tp+fp+fn) ELSE 0.0 END AS f1,
         CASE WHEN tp+fp > 0 THEN tp/(tp+fp) ELSE 0.0 END AS precision,
         CASE WHEN tp+fn > 0 THEN tp/(tp+fn) ELSE 0.0 END AS recall FROM {name})"""


BEST = """
best AS (SELECT model, target, thr AS threshold, f1, precision, recall FROM (
  SELECT *, row_number() OVER (PARTITION BY model, target ORDER BY f1 DESC, i ASC) AS rn FROM swm) WHERE rn = 1),
chosen AS (SELECT target, model, f1, threshold FROM (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY f1 DESC,
         CASE model WHEN 'lr' THEN 1 WHEN 'gbt' THEN 2 ELSE 3 END) AS rn FROM best) WHERE rn = 1),
tp_pred AS (SELECT s.order_id, s.target, s.model, s.y, s.hours, s.p, c.threshold, s.p >= c.threshold AS active,
                   CASE WHEN s.p >= c.threshold THEN greatest(0.0, s.dur) ELSE 0.0 END AS pred_hours
            FROM sc s JOIN chosen c ON s.model = c.model AND s.target = c.target WHERE s.split = 'test')"""


def eval_with(*extra: str) -> str:
    return S.with_(S.POS_RAW, S.HDR, S.pos_clean(CFG), S.order_aggs(CFG), S.features(CFG),
                   S.targets_wide(CFG), S.targets_long(CFG), ROLL, SPLIT, *extra)


def full_eval_with(*extra: str) -> str:
    return eval_with(scores_sql(), "\nval AS (SELECT * FROM sc WHERE split = 'val')",
                     grid_sql("g91", 0.05, 0.95, 91), sweep_sql("sw", "val", "g91"), BEST, *extra)


# ====================================================================== E
@query("stratified_split", lambda: eval_with() + "\nSELECT order_id, band, split FROM split", "E")
def q_stratified_split(spark, sf):
    """Deterministic stratified 60/20/20 split by complexity band."""
    return splits_frame(spark, sf).select("order_id", "band", "split")


@query("split_distribution", lambda: eval_with() + """
SELECT split, n_active, count(*) AS n_orders FROM split GROUP BY split, n_active""", "E")
def q_split_distribution(spark, sf):
    """Split sizes by n_active."""
    return E.split_distribution(splits_frame(spark, sf))


@query("time_split", lambda: """
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'train'
            WHEN o_orderdate < TIMESTAMP '2001-01-01' THEN 'val' ELSE 'test' END AS split
FROM orders""", "E")
def q_time_split(spark, sf):
    """Train on the past, validate and test on later orders."""
    o = V.headers(spark, sf).select("order_id", "order_date")
    return E.time_split(o, "order_date", "2000-01-01", "2001-01-01").select("order_id", "split")


TRAIN_LONG = "\ntrl AS (SELECT order_id, target, y, hours FROM scw WHERE split = 'train')"


def _train_long(spark, sf):
    return scores_wide(spark, sf).where(F.col("split") == "train").select("order_id", "target", "y", "hours")


@query("class_weight", lambda: eval_with(scores_sql(), TRAIN_LONG) + f"""
SELECT target, {big('count_if(y = 1)')} AS n_pos, {big('count_if(y = 0)')} AS n_neg,
       {r('greatest(1.0, count_if(y = 0) / (count_if(y = 1) + 1e-9::DOUBLE))')} AS w_pos
FROM trl GROUP BY target""", "E")
def q_class_weight(spark, sf):
    """Positive-class weight per target on the training split."""
    return round_doubles(E.class_weights(_train_long(spark, sf)))


OVERSAMPLE_TO = 20_000  # above the positives of every target at sf0.01 and sf0.1, so that rows are added


@query("random_oversample", lambda: eval_with(scores_sql(), TRAIN_LONG) + f"""
, cnt AS (SELECT target, count(*) AS n_pos FROM trl WHERE y = 1 GROUP BY target),
small AS (SELECT * FROM cnt WHERE n_pos > 0 AND n_pos < {OVERSAMPLE_TO}),
ranked AS (SELECT t.order_id, t.target, t.hours, row_number() OVER (PARTITION BY t.target ORDER BY md5(CAST(t.order_id AS VARCHAR))) - 1 AS idx
           FROM trl t JOIN small s ON t.target = s.target WHERE t.y = 1),
draws AS (SELECT s.target, j, ('0x' || left(md5('42|' || s.target || '|' || j), 12))::BIGINT % s.n_pos AS idx
          FROM small s, range(0, {OVERSAMPLE_TO}) r(j) WHERE j < {OVERSAMPLE_TO} - s.n_pos),
added AS (SELECT rk.target, rk.order_id, count(*) AS copies FROM draws d JOIN ranked rk ON d.target = rk.target AND d.idx = rk.idx GROUP BY ALL)
SELECT t.target, t.order_id, t.y, CAST(1 + coalesce(a.copies, 0) AS BIGINT) AS n_rows
FROM trl t LEFT JOIN added a ON a.target = t.target AND a.order_id = t.order_id AND t.y = 1""", "E")
def q_random_oversample(spark, sf):
    """Positives topped up to an exact number per target (train only): how often each row is in the result."""
    o = E.random_oversample(_train_long(spark, sf), OVERSAMPLE_TO)
    return o.groupBy("target", "order_id", "y").agg(F.count(F.lit(1)).alias("n_rows"))


@query("positive_subset", lambda: eval_with(scores_sql(), TRAIN_LONG) + f"""
SELECT target, count(*) AS n_pos, {r('sum(hours)')} AS sum_hours FROM trl WHERE hours > 0 GROUP BY target""", "E")
def q_positive_subset(spark, sf):
    """The regression training rows (target > 0) per target."""
    return round_doubles(_train_long(spark, sf).where(F.col("hours") > 0).groupBy("target").agg(
        F.count(F.lit(1)).alias("n_pos"), F.sum("hours").alias("sum_hours")))


@query("winsorise_target", lambda: eval_with(scores_sql(), TRAIN_LONG) + f"""
, caps AS (SELECT target, quantile_cont(hours, 0.95) AS cap FROM trl WHERE hours > 0 GROUP BY target)
SELECT s.target, {r('c.cap')} AS cap, {big('count_if(s.hours > c.cap)')} AS n_clipped,
       {r('sum(least(greatest(s.hours, 0.0), coalesce(c.cap, s.hours)))')} AS sum_wins
FROM scw s LEFT JOIN caps c ON s.target = c.target GROUP BY s.target, c.cap""", "E")
def q_winsorise_target(spark, sf):
    """E5: cap = p95 of training positives; clip every row to [0, cap]."""
    w = scores_wide(spark, sf)
    d = E.winsorise(w, w.where(F.col("split") == "train"))
    return round_doubles(d.groupBy("target", "cap").agg(F.count_if(F.col("hours") > F.col("cap")).alias("n_clipped"),
                                                        F.sum("hours_wins").alias("sum_wins")))


@query("log1p_target", lambda: eval_with(scores_sql(), TRAIN_LONG) + f"""
SELECT target, {r('avg(ln(1 + hours))')} AS mean_log1p, {r('max(abs(exp(ln(1 + hours)) - 1 - hours))', 9)} AS max_roundtrip_err
FROM trl WHERE hours > 0 GROUP BY target""", "E")
def q_log1p_target(spark, sf):
    """Fit scale log1p(y), back-transform expm1 (round trip checked)."""
    t = _train_long(spark, sf).where(F.col("hours") > 0)
    return t.groupBy("target").agg(rnd(F.avg(F.log1p("hours")), 6).alias("mean_log1p"),
                                   rnd(F.max(F.abs(F.expm1(F.log1p("hours")) - F.col("hours"))), 9).alias("max_roundtrip_err"))


@query("skew_screen", lambda: S.with_(S.targets_wide(CFG), S.targets_long(CFG)) + f"""
SELECT target, count(*) AS n, {r('max(hours)')} AS max, {r('quantile_cont(hours, 0.95)')} AS p95,
       CASE WHEN count(*) >= 3 THEN {r('skewness(hours)')} END AS skew,
       max(hours) / quantile_cont(hours, 0.95) >= 3 AND skewness(hours) >= 3 AS winsorise
FROM tl WHERE hours > 0 GROUP BY target""", "E")
def q_skew_screen(spark, sf):
    """Which targets qualify for winsorising (max/p95 >= 3, skew >= 3)."""
    return round_doubles(E.skew_screen(V.targets_long(spark, sf, CFG)))


# ====================================================================== F
@query("soft_vote", lambda: eval_with(scores_sql()) + f"""
SELECT order_id, target, {r('(p_lr + p_gbt) / 2')} AS p_ens FROM scw""", "F")
def q_soft_vote(spark, sf):
    """ensemble probability = mean of the two model probabilities."""
    w = scores_wide(spark, sf)
    return round_doubles(w.select("order_id", "target", TH.soft_vote(F.col("p_lr"), F.col("p_gbt")).alias("p_ens")))


@query("threshold_sweep_f1", lambda: full_eval_with() + f"""
SELECT model, target, {r('threshold')} AS threshold, {r('f1')} AS f1, {r('precision')} AS precision,
       {r('recall')} AS recall FROM best""", "F")
def q_threshold_sweep_f1(spark, sf):
    """F1-optimal threshold per (model, target) on validation."""
    return round_doubles(best_thresholds(spark, sf))


def _rf_sql():
    return eval_with(scores_sql(), "\nval AS (SELECT * FROM sc WHERE split = 'val')",
                     grid_sql("g99", 0.01, 0.99, 99), sweep_sql("rf", "val", "g99")) + f"""
, feas AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model, target ORDER BY precision DESC, i ASC) AS rn
                          FROM rfm WHERE recall >= 0.9) WHERE rn = 1),
pairs AS (SELECT DISTINCT model, target FROM rfm)
SELECT p.model, p.target, {r('coalesce(f.thr, 0.01)')} AS threshold, {r('f.precision')} AS precision,
       {r('f.recall')} AS recall, CASE WHEN f.thr IS NULL THEN 'MIN_RECALL_UNACHIEVABLE' ELSE 'OK' END AS status
FROM pairs p LEFT JOIN feas f ON p.model = f.model AND p.target = f.target"""


@query("threshold_recall_floor", _rf_sql, "F")
def q_threshold_recall_floor(spark, sf):
    """most precise threshold with validation recall >= 0.90."""
    val = scores_long(spark, sf).where(F.col("split") == "val")
    return round_doubles(TH.recall_floor_threshold(val, ["model", "target"]))


PR = """
prc AS (SELECT model, target, p AS threshold, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM val GROUP BY model, target, p),
prw AS (SELECT model, target, threshold,
               sum(pos) OVER (PARTITION BY model, target ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS tp,
               sum(neg) OVER (PARTITION BY model, target ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS fp,
               sum(pos) OVER (PARTITION BY model, target) AS P FROM prc),
prp AS (SELECT model, target, threshold, tp / (tp + fp) AS precision,
               CASE WHEN P > 0 THEN tp / P ELSE 0.0 END AS recall FROM prw)"""


@query("average_precision", lambda: eval_with(scores_sql(), "\nval AS (SELECT * FROM sc WHERE split = 'val')", PR) + f"""
, apd AS (SELECT model, target, precision,
                 recall - coalesce(lag(recall) OVER (PARTITION BY model, target ORDER BY threshold DESC), 0.0) AS dr
          FROM prp)
SELECT model, target, {r('sum(dr * precision)')} AS average_precision FROM apd GROUP BY model, target""", "F")
def q_average_precision(spark, sf):
    """F8: step-wise average precision on validation scores."""
    val = scores_long(spark, sf).where(F.col("split") == "val")
    return round_doubles(TH.average_precision(val, ["model", "target"]))


@query("pr_curve", lambda: eval_with(scores_sql(), "\nval AS (SELECT * FROM sc WHERE split = 'val')", PR) + f"""
SELECT model, target, {r('threshold')} AS threshold, {r('precision')} AS precision, {r('recall')} AS recall FROM prp""", "F")
def q_pr_curve(spark, sf):
    """precision-recall points per model and target."""
    val = scores_long(spark, sf).where(F.col("split") == "val")
    return round_doubles(TH.pr_points(val, ["model", "target"]))


@query("select_best_classifier", lambda: full_eval_with() + f"""
SELECT target, model, {r('f1')} AS f1 FROM chosen""", "F")
def q_select_best_classifier(spark, sf):
    """best model per target by validation F1; ties -> lr, gbt, ens."""
    return round_doubles(TH.select_best_model(best_thresholds(spark, sf), ["target"], priority=MODELS))


@query("compare_models_table", lambda: full_eval_with() + f"""
SELECT b.target, {r("max(CASE WHEN b.model = 'lr' THEN b.f1 END)")} AS f1_lr,
       {r("max(CASE WHEN b.model = 'gbt' THEN b.f1 END)")} AS f1_gbt,
       {r("max(CASE WHEN b.model = 'ens' THEN b.f1 END)")} AS f1_ens, c.model AS winner
FROM best b JOIN chosen c ON b.target = c.target GROUP BY b.target, c.model""", "F")
def q_compare_models_table(spark, sf):
    """validation F1 of each model side by side and the winner."""
    bt = kept(best_thresholds(spark, sf), "thresholds")  # one row per model and target, read twice
    wide = bt.groupBy("target").pivot("model", list(MODELS)).agg(F.first("f1"))
    wide = wide.select("target", *[F.col(m).alias(f"f1_{m}") for m in MODELS])
    win = TH.select_best_model(bt, ["target"], priority=MODELS).select("target", F.col("model").alias("winner"))
    return round_doubles(wide.join(win, "target"))


@query("apply_threshold", lambda: full_eval_with() + f"""
SELECT order_id, target, model, p, {r('threshold')} AS threshold, active FROM tp_pred""", "F")
def q_apply_threshold(spark, sf):
    """active flag on test orders with the winning model's threshold."""
    return round_doubles(test_predictions(spark, sf).select("order_id", "target", "model", "p", "threshold", "active"))


# ====================================================================== J
@query("confusion_counts", lambda: full_eval_with() + """
SELECT target, CAST(count_if(y = 1 AND active) AS BIGINT) AS tp, CAST(count_if(y <> 1 AND active) AS BIGINT) AS fp,
       CAST(count_if(y = 1 AND NOT active) AS BIGINT) AS fn, CAST(count_if(y <> 1 AND NOT active) AS BIGINT) AS tn
FROM tp_pred GROUP BY target""", "J")
def q_confusion_counts(spark, sf):
    """Confusion counts per target on test."""
    return J.confusion_counts(test_predictions(spark, sf), ["target"])


CLF = """
clf AS (SELECT target, tp, fp, fn, tn, (tp + tn) / (tp + fp + fn + tn) AS accuracy,
               CASE WHEN 2*tp+fp+fn > 0 THEN 2.0*tp/(2*tp+fp+fn) ELSE 0.0 END AS f1,
               CASE WHEN tp+fn > 0 THEN tp/(tp+fn) ELSE 0.0 END AS recall,
               CASE WHEN tp+fp > 0 THEN tp/(tp+fp) ELSE 0.0 END AS precision
        FROM (SELECT target, count_if(y = 1 AND active) AS tp, count_if(y <> 1 AND active) AS fp,
                     count_if(y = 1 AND NOT active) AS fn, count_if(y <> 1 AND NOT active) AS tn
              FROM tp_pred GROUP BY target)),
ptr AS (SELECT c.*, m.mae_e2e, m.prevalence FROM clf c JOIN
        (SELECT target, avg(abs(hours - pred_hours)) AS mae_e2e, avg(y::DOUBLE) AS prevalence FROM tp_pred GROUP BY target) m
        ON c.target = m.target)"""


@query("clf_metrics", lambda: full_eval_with(CLF) + f"""
SELECT target, {big('tp')} AS tp, {big('fp')} AS fp, {big('fn')} AS fn, {big('tn')} AS tn,
       {r('accuracy')} AS accuracy, {r('f1')} AS f1, {r('recall')} AS recall, {r('precision')} AS precision FROM clf""", "J")
def q_clf_metrics(spark, sf):
    """Accuracy / F1 / recall / precision per target on test."""
    return round_doubles(J.clf_metrics(test_predictions(spark, sf), ["target"]))


@query("regression_metrics", lambda: full_eval_with() + f"""
SELECT target, {r('avg(abs(hours - pred_hours))')} AS mae_e2e, {big('count_if(hours > 0)')} AS n_pos,
       CASE WHEN count_if(hours > 0) >= 2 THEN {r('avg(CASE WHEN hours > 0 THEN abs(hours - pred_hours) END)')} END AS mae_pos,
       CASE WHEN count_if(hours > 0) >= 2 THEN {r('sqrt(avg(CASE WHEN hours > 0 THEN (hours - pred_hours) * (hours - pred_hours) END))')} END AS rmse_pos,
       CASE WHEN count_if(hours > 0) >= 2 THEN {r('avg(CASE WHEN hours > 0 THEN abs(hours - pred_hours) END) / (avg(CASE WHEN hours > 0 THEN hours END) + 1e-8::DOUBLE) * 100')} END AS mae_pct_pos,
       CASE WHEN count_if(hours > 0) >= 2 THEN {r('avg(CASE WHEN hours > 0 THEN abs(hours - pred_hours) / hours END) * 100')} END AS mape
FROM tp_pred GROUP BY target""", "J")
def q_regression_metrics(spark, sf):
    """J3 end-to-end MAE, J4 positive-row MAE, J5 RMSE / MAE%, J6 MAPE."""
    return round_doubles(J.regression_metrics(test_predictions(spark, sf), ["target"]))


@query("total_order_mae", lambda: full_eval_with() + f"""
, tot AS (SELECT order_id, sum(hours) AS true_total, sum(pred_hours) AS pred_total FROM tp_pred GROUP BY order_id)
SELECT {r('avg(abs(true_total - pred_total))')} AS total_mae, {r('median(true_total)')} AS median_true_total,
       {r('median(pred_total)')} AS median_pred_total FROM tot""", "J")
def q_total_order_mae(spark, sf):
    """Error of the summed hours per order."""
    return round_doubles(J.total_order_mae(test_predictions(spark, sf)))


def _mfw_sql(src: str, group: str = "", round_out: bool = True) -> str:
    g = f"{group}, " if group else ""
    out = r if round_out else (lambda x: x)
    parts = []
    for m, d in J.PER_TARGET_DIGITS.items():
        parts.append(f"{out(f'avg({S.r(m, d)})')} AS macro_{m}")
        parts.append(f"{out(f'sum(prevalence * {S.r(m, d)}) / sum(prevalence)')} AS fw_{m}")
    return f"SELECT {g}{', '.join(parts)} FROM {src}" + (f" GROUP BY {group}" if group else "")


@query("macro_fw_metrics", lambda: full_eval_with(CLF) + "\n" + _mfw_sql("ptr"), "J")
def q_macro_fw_metrics(spark, sf):
    """Macro and frequency-weighted averages (rounded per-target first)."""
    return round_doubles(J.macro_and_fw(J.per_target_report(test_predictions(spark, sf), ["target"])))


@query("worst_errors", lambda: full_eval_with() + f"""
SELECT target, rank, order_id, {r('hours')} AS hours, {r('pred_hours')} AS pred_hours, {r('abs_err')} AS abs_err FROM (
  SELECT *, abs(hours - pred_hours) AS abs_err,
         CAST(row_number() OVER (PARTITION BY target ORDER BY abs(hours - pred_hours) DESC, order_id) AS INTEGER) AS rank
  FROM tp_pred WHERE y = 1 AND active) WHERE rank <= 5""", "J")
def q_worst_errors(spark, sf):
    """Five largest duration errors among true positives per target."""
    return round_doubles(J.worst_errors(test_predictions(spark, sf)))


def _long_metrics_sql(src: str) -> str:
    return " UNION ALL ".join(f"SELECT target, '{m}' AS metric, {m} AS value FROM {src}" for m in ("f1", "mae_e2e"))


def _rule_test_sql() -> str:
    from jobsheet.plans.q_profile import _rule_pred, rule_num_sql
    return rule_num_sql() + f""",
rtest AS (SELECT rn.order_id, rn.target, CAST(tl.hours > 0 AS INTEGER) AS y, tl.hours,
                 {_rule_pred('10.0::DOUBLE')} AS pred_hours FROM rn
          JOIN tl ON rn.order_id = tl.order_id AND rn.target = tl.target
          JOIN split s ON s.order_id = rn.order_id WHERE s.split = 'test'),
rbase AS (SELECT target, CASE WHEN 2*tp+fp+fn > 0 THEN 2.0*tp/(2*tp+fp+fn) ELSE 0.0 END AS f1, mae_e2e FROM
          (SELECT target, count_if(y = 1 AND pred_hours > 0) AS tp, count_if(y <> 1 AND pred_hours > 0) AS fp,
                  count_if(y = 1 AND NOT pred_hours > 0) AS fn, avg(abs(hours - pred_hours)) AS mae_e2e
           FROM rtest GROUP BY target))"""


@query("delta_vs_baseline", lambda: full_eval_with(CLF, _rule_test_sql()) + f"""
, ml AS ({_long_metrics_sql('ptr')}), bl AS ({_long_metrics_sql('rbase')})
SELECT ml.target, ml.metric, {r('ml.value')} AS value, {r('bl.value')} AS baseline, {r('ml.value - bl.value')} AS delta,
       CASE WHEN bl.value <> 0 THEN {r('(ml.value - bl.value) / abs(bl.value) * 100')} END AS pct_change
FROM ml JOIN bl ON ml.target = bl.target AND ml.metric = bl.metric""", "J")
def q_delta_vs_baseline(spark, sf):
    """Model metrics against the rule baseline (factor 10) on test."""
    from jobsheet.operators import profile as K
    scores, wide, splits = scored_orders(spark, sf)
    pt = J.per_target_report(test_predictions(spark, sf, scores_long(spark, sf, scores)), ["target"])
    test = splits.where(F.col("split") == "test").select("order_id")
    # the join with the test orders, taken before their texts are built as well: no other order's rule hours are used
    rules = K.rule_rows(V.positions(spark, sf).join(test, "order_id", "left_semi"),
                        V.order_keys(spark, sf).join(test, "order_id", "left_semi"), CFG)
    rb = K.rule_cells(rules.join(test, "order_id"), wide, CFG)
    rb = rb.select("order_id", "target", (F.col("hours") > 0).cast("int").alias("y"), "hours",
                   K.rule_hours(rb, F.lit(10.0), len(CFG.rule_patterns)).alias("pred_hours"))
    rb = rb.withColumn("active", F.col("pred_hours") > 0)
    rbt = J.per_target_report(rb, ["target"])

    def lng(df):
        return df.select("target", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                                                       for m in ("f1", "mae_e2e")])))
    return round_doubles(J.delta_vs_baseline(lng(pt), lng(rbt)))


@query("metric_report_rows", lambda: full_eval_with(CLF) + f"""
, mfw AS ({_mfw_sql('ptr')})
{" UNION ALL ".join(f"SELECT target AS row_label, '{m}' AS metric, {S.r(m, d)} AS value FROM ptr"
                    for m, d in J.PER_TARGET_DIGITS.items())}
UNION ALL {" UNION ALL ".join(f"SELECT 'MACRO', '{m}', macro_{m} FROM mfw UNION ALL SELECT 'FREQ-WT', '{m}', fw_{m} FROM mfw"
                              for m in J.PER_TARGET_DIGITS)}""", "J")
def q_metric_report_rows(spark, sf):
    """Per-target rows plus MACRO and FREQ-WT rows."""
    return round_doubles(J.metric_report_rows(J.per_target_report(test_predictions(spark, sf), ["target"])))


@query("split_metrics_table", lambda: full_eval_with() + f"""
, vt AS (SELECT s.split, s.target, s.y, s.p >= c.threshold AS active, c.threshold
         FROM sc s JOIN chosen c ON s.model = c.model AND s.target = c.target WHERE s.split IN ('val', 'test')),
cc AS (SELECT split, target, threshold, count_if(y = 1 AND active) AS tp, count_if(y <> 1 AND active) AS fp,
              count_if(y = 1 AND NOT active) AS fn, count_if(y <> 1 AND NOT active) AS tn FROM vt GROUP BY ALL)
SELECT split, target, {r('threshold')} AS threshold,
       {r('CASE WHEN tp+fp > 0 THEN tp/(tp+fp) ELSE 0.0 END')} AS precision,
       {r('CASE WHEN tp+fn > 0 THEN tp/(tp+fn) ELSE 0.0 END')} AS recall,
       {r('(tp+tn)/(tp+fp+fn+tn)')} AS accuracy FROM cc""", "J")
def q_split_metrics_table(spark, sf):
    """Precision / recall / accuracy per target for val and test."""
    scores = scores_long(spark, sf)
    s = scores.where(F.col("split").isin("val", "test"))
    ch = chosen(spark, sf, scores).select("model", "target", "threshold")
    p = TH.apply_threshold(s, ch, ["model", "target"])
    m = J.clf_metrics(p, ["split", "target", "threshold"])
    return round_doubles(m.select("split", "target", "threshold", "precision", "recall", "accuracy"))


@query("dual_strategy_eval", lambda: eval_with(
        scores_sql(), "\nval AS (SELECT * FROM sc WHERE split = 'val' AND model = 'ens')",
        grid_sql("g91", 0.05, 0.95, 91), sweep_sql("sw", "val", "g91"),
        grid_sql("g99", 0.01, 0.99, 99), sweep_sql("rf", "val", "g99")) + """
, t1 AS (SELECT target, thr AS threshold FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY f1 DESC, i) AS rn FROM swm) WHERE rn = 1),
t2f AS (SELECT target, thr FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY precision DESC, i) AS rn FROM rfm WHERE recall >= 0.9) WHERE rn = 1),
t2 AS (SELECT p.target, coalesce(f.thr, 0.01) AS threshold FROM (SELECT DISTINCT target FROM rfm) p LEFT JOIN t2f f ON p.target = f.target),
th AS (SELECT 'f1_opt' AS strategy, * FROM t1 UNION ALL SELECT 'recall_floor', * FROM t2),
tp_pred AS (SELECT th.strategy, s.target, s.y, s.hours, s.p >= th.threshold AS active,
                   CASE WHEN s.p >= th.threshold THEN greatest(0.0, s.dur) ELSE 0.0 END AS pred_hours
            FROM sc s JOIN th ON s.target = th.target WHERE s.split = 'test' AND s.model = 'ens'),
ptr AS (SELECT strategy, target, (tp + tn) / (tp + fp + fn + tn) AS accuracy,
               CASE WHEN 2*tp+fp+fn > 0 THEN 2.0*tp/(2*tp+fp+fn) ELSE 0.0 END AS f1,
               CASE WHEN tp+fn > 0 THEN tp/(tp+fn) ELSE 0.0 END AS recall,
               CASE WHEN tp+fp > 0 THEN tp/(tp+fp) ELSE 0.0 END AS precision, mae_e2e, prevalence
        FROM (SELECT strategy, target, count_if(y = 1 AND active) AS tp, count_if(y <> 1 AND active) AS fp,
                     count_if(y = 1 AND NOT active) AS fn, count_if(y <> 1 AND NOT active) AS tn,
                     avg(abs(hours - pred_hours)) AS mae_e2e, avg(y::DOUBLE) AS prevalence
              FROM tp_pred GROUP BY strategy, target))
""" + _mfw_sql("ptr", "strategy"), "J")
def q_dual_strategy_eval(spark, sf):
    """The ensemble under F1-optimal and recall-floor thresholds."""
    sl = scores_long(spark, sf).where(F.col("model") == "ens")
    val = sl.where(F.col("split") == "val")
    t1 = TH.best_f1_threshold(val, ["target"]).select("target", "threshold").withColumn("strategy", F.lit("f1_opt"))
    t2 = TH.recall_floor_threshold(val, ["target"]).select("target", "threshold").withColumn(
        "strategy", F.lit("recall_floor"))
    th = t1.unionByName(t2)
    test = sl.where(F.col("split") == "test")
    p = TH.apply_threshold(test, th, ["target"])
    p = p.withColumn("pred_hours", J.cascade_hours(F.col("active"), F.col("dur")))
    return round_doubles(J.macro_and_fw(J.per_target_report(p, ["strategy", "target"]), ["strategy"]))
