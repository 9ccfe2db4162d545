"""Learner, bundle and scoring queries.

Model fits have no SQL form; those queries are checked by row count here
and by single-node versions, optima and invariants in ``tests/``.  Explanations, active
steps and the batch summaries run on the deterministic pseudo-score
predictions and carry SQL oracles.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobsheet.config import part_catalog
from jobsheet.operators import calibration as C
from jobsheet.operators import labels as L
from jobsheet.operators import learners as LR
from jobsheet.operators import metrics as J
from jobsheet.operators import positions as P
from jobsheet.operators import scoring as H
from jobsheet.operators import text as D
from jobsheet.operators.matrix import predict
from jobsheet.operators.prefix import exact_quantiles
from jobsheet.plans import sqlbase as S
from jobsheet.plans.q_eval import TRAIN_LONG, eval_with, full_eval_with, scores_sql, splits_frame, test_predictions
from jobsheet.plans.q_orders import features_frame
from jobsheet.plans.q_text import CHAR_MAX, CHAR_MIN_DF, WORD_MAX, WORD_MIN_DF, char_grams, word_grams
from jobsheet.plans.registry import query, round_doubles
from jobsheet.session import checkpoint_dir
from jobsheet.sources import order_view as V

CFG = part_catalog()
LCFG = LR.LearnerConfig()  # the original's rounds and iterations
r, big, q = S.r, S.big, S.q


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _written(df: DataFrame, name: str) -> DataFrame:
    path = _folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Workspace:
    """What the learner queries of one application share for one data folder: the written training
    rows, their frozen vocabularies and the models fitted so far.  Everything is written
    tables or small arrays on the driver, so no query can take away another's data."""

    _open: dict[tuple[str, str], Workspace] = {}

    @classmethod
    def of(cls, spark, sf) -> Workspace:
        key = (spark.sparkContext.applicationId, sf.rstrip("/"))
        if key not in cls._open:
            cls._open = {k: w for k, w in cls._open.items() if k[0] == key[0]}  # of this application
            cls._open[key] = cls(spark, sf)
        return cls._open[key]

    def __init__(self, spark, sf):
        self.spark, self.sf = spark, sf
        splits = splits_frame(spark, sf).select("order_id", "split")
        headers = V.headers(spark, sf)
        self.make_freq = _written(P.make_frequency(headers.join(splits.where(F.col("split") == "train"), "order_id", "left_semi")), "make-freq")
        feats = P.order_features(P.clean_positions(V.positions(spark, sf), CFG), headers, CFG, self.make_freq)
        wide = V.targets_wide(spark, sf, CFG)
        self.features = P.feature_columns(CFG)
        rows = feats.join(splits, "order_id").join(wide.select("order_id", F.array(*CFG.targets).alias("labels")), "order_id").select(
            "order_id", "split", "labels", L.with_placeholder(F.col("order_text"), CFG.empty_placeholder).alias("text"),
            F.array(*[F.col(c).cast("double") for c in self.features]).alias("num"))
        rows = _written(rows, "training-rows")
        train = rows.where(F.col("split") == "train")
        word = D.fit_vocab(train, "order_id", word_grams(), WORD_MIN_DF, WORD_MAX).withColumn("kind", F.lit("word"))
        char = D.fit_vocab(train, "order_id", char_grams(), CHAR_MIN_DF, CHAR_MAX).withColumn("kind", F.lit("char"))
        self.vocab = _written(word.unionByName(char), "vocabulary")
        self.word, self.char = (D.Vocabulary.of(self.vocab.where(F.col("kind") == k)) for k in ("word", "char"))
        n = len(self.features)
        names = [f"word:{t}" for t in self.word.terms.to_pylist()] + [f"char:{t}" for t in self.char.terms.to_pylist()] + self.features
        self.training = LR.TextTrainingSet(rows, [(word_grams(), self.word), (char_grams(), self.char)], [F.get("num", F.lit(j)) for j in range(n)],
                                           CFG.targets, names, len(names) - n)
        self._fitted: dict = {}

    def once(self, key, fit):
        if key not in self._fitted:
            self._fitted[key] = fit()
        return self._fitted[key]

    def classifiers(self, kind: str) -> list:
        return self.once(("clf", kind), lambda: LR.fit_classifiers(self.training, kind, LCFG))

    def val_scores(self, kind: str) -> DataFrame:
        """(target, y, p) of the validation split, written: thresholds and calibrations read them several times."""
        return self.once(("val", kind), lambda: _written(LR.occurrence_scores(self.training, self.classifiers(kind), "val").select("target", "y", "p"), "val-scores"))

    def thresholds(self, kind: str) -> DataFrame:
        return self.once(("thr", kind), lambda: _written(LR.tuned_thresholds(self.training, self.classifiers(kind), self.val_scores(kind)), "thresholds"))

    def regressors(self, *kinds: str) -> dict:
        """(target, learner) -> model, for all targets; what is missing is fitted together."""
        have = self.once("reg", dict)
        missing = [(t, k) for k in kinds for t in CFG.targets if (t, k) not in have]
        have |= LR.fit_regressors(self.training, missing, LCFG)
        return {(t, k): have[t, k] for t in CFG.targets for k in kinds}

    def close(self) -> None:
        self.training.close()
        self._open.pop((self.spark.sparkContext.applicationId, self.sf.rstrip("/")), None)

    def bundle(self, clf_kind: str = "lr") -> H.Bundle:
        """Classifiers of one kind with their tuned thresholds, regressors by the dispatch table."""
        def build():
            thr = {x["target"]: x["threshold"] for x in self.thresholds(clf_kind).collect()}  # one row per target
            reg, choice, _ = LR.dispatch(self.training, CFG.best_regressor, LCFG)
            return H.Bundle(CFG.targets, dict(zip(CFG.targets, self.classifiers(clf_kind))), {t: clf_kind for t in CFG.targets}, thr, reg, choice,
                            list(self.features), self.vocab, self.make_freq, {"clf": clf_kind})
        return self.once(("bundle", clf_kind), build)


def _fit_frame(spark, rows, schema):
    return round_doubles(spark.createDataFrame(rows, schema))


def _maes(w: Workspace, models: dict) -> DataFrame:
    rows = [(t, k, m) for (t, k), m in LR.val_maes(w.training, models).items()]
    return _fit_frame(w.spark, rows, "target string, model string, val_mae_pos double")


@query("fit_gbt_classifier", None, "F")
def q_fit_gbt_classifier(spark, sf):
    """boosted trees per target with class weights; F4 threshold on val."""
    return round_doubles(Workspace.of(spark, sf).thresholds("lgbm").withColumn("model", F.lit("lgbm")))


@query("fit_logistic", None, "F")
def q_fit_logistic(spark, sf):
    """weighted L2 logistic regression per target (C=1 equivalent)."""
    return round_doubles(Workspace.of(spark, sf).thresholds("lr").withColumn("model", F.lit("lr")))


@query("fit_ridge", None, "G")
def q_fit_ridge(spark, sf):
    """G1: ridge (alpha=10) on positives; validation-positive MAE."""
    w = Workspace.of(spark, sf)
    return _maes(w, w.regressors("ridge"))


@query("fit_gbt_regressor", None, "G")
def q_fit_gbt_regressor(spark, sf):
    """Boosted regression trees (squared loss) on positives."""
    w = Workspace.of(spark, sf)
    return _maes(w, w.regressors("lgbm"))


@query("fit_gbt_regressor_l1", None, "G")
def q_fit_gbt_regressor_l1(spark, sf):
    """Boosted regression trees with absolute loss."""
    w = Workspace.of(spark, sf)
    return _maes(w, w.regressors("lgbm_l1"))


@query("mean_fallback", lambda: eval_with(scores_sql(), TRAIN_LONG) + f"""
SELECT target, {r('avg(hours)')} AS mean_hours, {r('median(hours)')} AS median_hours FROM trl WHERE hours > 0 GROUP BY target""", "G")
def q_mean_fallback(spark, sf):
    """Constant mean / median of training positives per target."""
    rows = V.targets_long(spark, sf, CFG).join(splits_frame(spark, sf).where(F.col("split") == "train").select("order_id"), "order_id")
    return round_doubles(rows.where(F.col("hours") > 0).groupBy("target").agg(
        F.avg("hours").alias("mean_hours"), F.percentile("hours", F.lit(0.5)).alias("median_hours")))


@query("ridge_auto", None, "G")
def q_ridge_auto(spark, sf):
    """Plain vs winsorised ridge per target, smaller validation MAE wins."""
    w = Workspace.of(spark, sf)
    models = w.regressors("ridge", "ridge_wins")
    maes = LR.val_maes(w.training, models)
    rows = [(t, *LR.ridge_auto(t, models, maes)[1:]) for t in CFG.targets]
    return _fit_frame(spark, rows, "target string, choice string, val_mae_pos double")


@query("select_best_regressor", None, "G")
def q_select_best_regressor(spark, sf):
    """G10 (and the G5 dispatch table it produces): ridge vs trees per target."""
    w = Workspace.of(spark, sf)
    maes = LR.val_maes(w.training, w.regressors("ridge", "lgbm"))
    rows = []
    for t in CFG.targets:
        best = LR.select_best_regressor({k: maes[t, k] for k in ("ridge", "lgbm")})
        rows.append((t, best, maes[t, best]))
    return _fit_frame(spark, rows, "target string, model string, val_mae_pos double")


@query("train_dispatch", None, "G")
def q_train_dispatch(spark, sf):
    """Every target trained by the learner that the dispatch table names for it."""
    w = Workspace.of(spark, sf)
    b = w.bundle()
    maes = LR.val_maes(w.training, {(t, b.reg_kind[t]): b.reg[t] for t in CFG.targets})
    return _fit_frame(spark, [(t, CFG.best_regressor.get(t, "lgbm"), k, m) for (t, k), m in maes.items()],
                      "target string, configured string, trained string, val_mae_pos double")


#: Variant -> (absolute loss, median fallback, winsorised) for the experiment target; the other targets keep the baseline.
VARIANTS = {"baseline": (False, False, False), "A_only": (True, False, False), "B_only": (False, True, False),
            "C_only": (False, False, True), "A+C": (True, False, True), "A+B+C": (True, True, True)}


def _variant_learner(l1: bool, wins: bool) -> str:
    return "lgbm" + ("_l1" if l1 else "") + ("_wins" if wins else "")


@query("regression_variant_grid", None, "G")
def q_regression_variant_grid(spark, sf):
    """The six named variants for every target as experiment target, each evaluated end to end on test."""
    w = Workspace.of(spark, sf)
    kinds = sorted({_variant_learner(a, c) for a, _, c in VARIANTS.values()})
    models = w.regressors(*kinds, "mean_fallback", "median_fallback")
    few = [s["n_pos"] < LCFG.min_pos_for_model for s in w.training.stats()]
    thr = {x["target"]: x["threshold"] for x in w.thresholds("lr").collect()}  # one row per target
    keys = list(models)
    rows = predict(predict(w.training.split("test"), w.classifiers("lr"), "p"), [models[k] for k in keys], "d")

    def hours(t, kind):
        i = F.lit(CFG.targets.index(t))
        return F.when(F.get("p", i) >= F.lit(thr[t]), F.greatest(F.lit(0.0), F.get("d", F.lit(keys.index((t, kind)))))).otherwise(F.lit(0.0))

    aggs, order = [], []
    for e, target in enumerate(CFG.targets):  # the experiment target
        for name, (a, b, c) in VARIANTS.items():
            kind = ("median_fallback" if b else "mean_fallback") if few[e] else _variant_learner(a, c)
            errors = {t: F.abs(hours(t, kind if t == target else "mean_fallback" if few[k] else "lgbm") - F.get("labels", F.lit(k)))
                      for k, t in enumerate(CFG.targets)}
            total = F.abs(sum(hours(t, kind if t == target else "mean_fallback" if few[k] else "lgbm") - F.get("labels", F.lit(k))
                              for k, t in enumerate(CFG.targets)))
            order.append((target, name))
            aggs.append(F.struct(F.avg(errors[target]).alias("mae_e2e"), F.avg(sum(errors.values()) / len(CFG.targets)).alias("mean_mae"),
                                 F.avg(total).alias("total_order_mae")).alias(f"v{len(aggs)}"))
    found = rows.select(*aggs).first()  # one row
    grid = spark.createDataFrame([(t, v, k, *found[k]) for k, (t, v) in enumerate(order)],
                                 "target string, variant string, ord int, mae_e2e double, mean_mae double, total_order_mae double")
    rank = F.row_number().over(Window.partitionBy("target").orderBy(F.col("mae_e2e").asc_nulls_last(), "ord"))
    return round_doubles(grid.withColumn("best", rank == 1).drop("ord"))


@query("frozen_clf_retrain_reg", None, "G")
def q_frozen_clf_retrain_reg(spark, sf):
    """Keep the saved classifiers, retrain only the regressors, save a
    new version of the bundle; A9 round trip included."""
    w = Workspace.of(spark, sf)
    root = _folder(spark, "bundle-g7")
    H.save_bundle(w.bundle(), root)
    loaded = H.load_bundle(spark, root)
    models = w.regressors("lgbm_l1")
    loaded.reg, loaded.reg_kind = {t: models[t, "lgbm_l1"] for t in CFG.targets}, {t: "lgbm_l1" for t in CFG.targets}
    H.save_bundle(loaded, root)
    again = H.load_bundle(spark, root)
    return _maes(w, {(t, again.reg_kind[t]): again.reg[t] for t in CFG.targets}).withColumn("clf_kind", F.lit(again.clf_kind[CFG.targets[0]]))


@query("isotonic_calibration", None, "F")
def q_isotonic_calibration(spark, sf):
    """Test scores of the logistic classifiers, calibrated by an isotonic fit on validation: (target, decile, mean score,
    mean calibrated, share active)."""
    w = Workspace.of(spark, sf)
    steps = C.isotonic(w.val_scores("lr"))
    d = C.apply_isotonic(LR.occurrence_scores(w.training, w.classifiers("lr"), "test"), steps)
    return round_doubles(d.groupBy("target", F.least(F.floor(F.col("p") * 10), F.lit(9)).cast("int").alias("decile")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("p").alias("mean_p"), F.avg("calibrated").alias("mean_calibrated"), F.avg("y").alias("share_active")))


@query("platt_calibration", None, "F")
def q_platt_calibration(spark, sf):
    """Slope and offset of each target's logistic scores on validation."""
    w = Workspace.of(spark, sf)
    fit = C.platt(w.val_scores("lr"))
    return _fit_frame(spark, [(t, *fit[t]) for t in CFG.targets], "target string, slope double, offset double")


@query("ridge_cross_validation", None, "G")
def q_ridge_cross_validation(spark, sf):
    """Five-fold error of the ridge penalties 0.1 to 1,000 on each target's training positives, and the best one."""
    w = Workspace.of(spark, sf)
    blocks = w.training.blocks_with(F.pmod(F.xxhash64("order_id"), F.lit(5)))
    rows = []
    for t, found in zip(CFG.targets, C.ridge_cross_validations(blocks, range(len(CFG.targets)), len(w.training.features), (0.1, 1.0, 10.0, 100.0, 1000.0), 5)):
        best = min(found, key=lambda x: x[1])[0]
        rows += [(t, a, rmse, worst, a == best) for a, rmse, worst in found]
    return _fit_frame(spark, rows, "target string, alpha double, rmse double, worst_fold_mse double, best boolean")


def raw_orders(spark, sf) -> DataFrame:
    """Raw order documents (order_id, make, positions) of the order view, positions in their order."""
    item = F.struct(F.col("text"), F.col("total_price").cast("string").alias("totalPrice"), F.col("total_time").cast("string").alias("totalTime"),
                    F.col("cost_center").alias("genericCostCenter"))
    lists = V.positions(spark, sf).groupBy("order_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("line_no", "part_key", "supp_key", item.alias("p")))), lambda x: x["p"]).alias("positions"))
    empty = F.array().cast("array<struct<text:string,totalPrice:string,totalTime:string,genericCostCenter:string>>")
    return V.headers(spark, sf).select("order_id", "make").join(lists, "order_id", "left").withColumn("positions", F.coalesce("positions", empty))


def bundle_root(spark, sf) -> str:
    """Where the workspace's bundle is saved (once)."""
    w = Workspace.of(spark, sf)

    def save():
        root = _folder(spark, "bundle")
        H.save_bundle(w.bundle(), root)
        return root
    return w.once("bundle-root", save)


def saved_bundle(spark, sf) -> H.Bundle:
    return H.load_bundle(spark, bundle_root(spark, sf))


@query("score_orders", None, "H")
def q_score_orders(spark, sf):
    """H1: raw orders scored by a bundle that was saved and loaded again."""
    scored = H.score_raw(raw_orders(spark, sf), saved_bundle(spark, sf), CFG)
    return scored.select("order_id", "predictions", "active_targets", "total_predicted_hours")


@query("format_response", None, "H")
def q_format_response(spark, sf):
    """H4: response documents with explanations (struct + JSON) for all orders."""
    scored = H.score_raw(raw_orders(spark, sf), saved_bundle(spark, sf), CFG, explain=True)
    return H.format_response(scored, CFG.targets, CFG.target_labels)


@query("linear_top_terms", None, "J")
def q_linear_top_terms(spark, sf):
    """The five largest positive word coefficients per target."""
    w = Workspace.of(spark, sf)
    terms = w.word.terms.to_pylist()
    rows = []
    for t, m in zip(CFG.targets, w.classifiers("lr")):
        rows += [(t, i, float(c), terms[i]) for i, c in enumerate(m.weights[:len(terms)]) if c > 0]
    d = spark.createDataFrame(rows, "target string, idx int, coef double, term string")
    by = Window.partitionBy("target").orderBy(F.desc("coef"), "term")
    return round_doubles(d.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= 5))


@query("tree_importance", None, "J")
def q_tree_importance(spark, sf):
    """The 15 most important numeric features per target (number of splits in the trees)."""
    w = Workspace.of(spark, sf)
    n = len(w.training.features)
    rows = []
    for t, m in zip(CFG.targets, w.classifiers("lgbm")):
        rows += [(t, f, int(v)) for f, v in zip(w.features, m.importance(n)[n - len(w.features):])]
    d = spark.createDataFrame(rows, "target string, feature string, importance long")
    by = Window.partitionBy("target").orderBy(F.desc("importance"), "feature")
    return d.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= 15)


# ====================================================================== SQL-checked H2/H3/H5/H6
@query("active_steps", lambda: full_eval_with() + f"""
SELECT o.order_id, coalesce(list(a.target ORDER BY CASE a.target {" ".join(f"WHEN {q(t)} THEN {i}" for i, t in enumerate(CFG.targets))} END)
                            FILTER (WHERE a.active), []) AS active_targets,
       CAST(count_if(a.active) AS INTEGER) AS n_steps
FROM (SELECT DISTINCT order_id FROM tp_pred) o JOIN tp_pred a ON o.order_id = a.order_id
GROUP BY o.order_id""", "H")
def q_active_steps(spark, sf):
    """H2: active targets per test order in canonical target order."""
    tp = test_predictions(spark, sf)
    wide = tp.groupBy("order_id").pivot("target", list(CFG.targets)).agg(F.first("active"))
    m = F.create_map(*[x for t in CFG.targets for x in (F.lit(t), F.struct(F.col(t).alias("active")))])
    steps = H.active_steps(m, CFG.targets)
    return wide.select("order_id", steps.alias("active_targets"), F.size(steps).alias("n_steps"))


def _explain_sql():
    t = S.strip("coalesce(p.text, '')")
    conds = []
    for tg, kws in CFG.target_keywords.items():
        c = " OR ".join(S.search(f"lower({t})", CFG.keyword_flags[k]) for k in kws)
        conds.append(f"SELECT p.order_id, p.line_no, p.part_key, p.supp_key, left({t}, 80) AS snippet, "
                     f"{q(tg)} AS target FROM pos_raw p WHERE {t} <> '' AND ({c})")
    kwsel = []
    for tg, kws in CFG.target_keywords.items():
        items = ", ".join(f"CASE WHEN f.{k} = 1 THEN {q(k[3:])} END" for k in kws)
        kwsel.append(f"WHEN {q(tg)} THEN list_filter([{items}], lambda x: x IS NOT NULL)")
    return full_eval_with() + f"""
, m AS ({" UNION ALL ".join(conds)}),
act AS (SELECT order_id, target FROM tp_pred WHERE active),
ma AS (SELECT m.* FROM m JOIN act ON m.order_id = act.order_id AND m.target = act.target),
fst AS (SELECT order_id, target, snippet, min((line_no, part_key, supp_key)) AS pk FROM ma GROUP BY ALL),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id, target ORDER BY pk) AS rk FROM fst) WHERE rk <= 3),
sn AS (SELECT order_id, target, list(snippet ORDER BY pk) AS matching_positions FROM top GROUP BY order_id, target)
SELECT a.order_id, a.target,
       CASE a.target {" ".join(kwsel)} END AS triggered_keywords,
       coalesce(sn.matching_positions, []) AS matching_positions
FROM act a JOIN feat f ON a.order_id = f.order_id
LEFT JOIN sn ON a.order_id = sn.order_id AND a.target = sn.target"""


@query("explain_orders", _explain_sql, "H")
def q_explain_orders(spark, sf):
    """H3: triggered keywords and up to three matching position texts for
    every active (order, target)."""
    tp = test_predictions(spark, sf).where(F.col("active")).select("order_id", "target").checkpoint()
    orders = tp.select("order_id").distinct()
    pos = V.positions(spark, sf).join(orders, "order_id", "left_semi")
    return H.explain(pos, P.order_text_frame(P.clean_positions(pos, CFG), orders, CFG), tp, CFG)


@query("batch_summary", lambda: full_eval_with() + f"""
, po AS (SELECT order_id, sum(hours) AS true_total, sum(pred_hours) AS pred_total, count_if(active) AS n_steps
         FROM tp_pred GROUP BY order_id)
SELECT count(*) AS n_orders, {r('avg(abs(true_total - pred_total))')} AS mean_abs_err,
       {r('median(abs(true_total - pred_total))')} AS median_abs_err,
       {r('max(abs(true_total - pred_total))')} AS max_abs_err FROM po""", "H")
def q_batch_summary(spark, sf):
    """H5: mean / median / max absolute error of the order totals."""
    po = test_predictions(spark, sf).groupBy("order_id").agg(
        F.sum("hours").alias("true_total"), F.sum("pred_hours").alias("pred_total"))
    po = po.select(F.abs(F.col("true_total") - F.col("pred_total")).alias("e"))
    median = exact_quantiles(po, "e", {"median": 0.5}).scalar()
    return round_doubles(po.agg(F.count(F.lit(1)).alias("n_orders"), F.avg("e").alias("mean_abs_err"), F.max("e").alias("max_abs_err"))
                         .select("n_orders", "mean_abs_err", median.alias("median_abs_err"), "max_abs_err"))


@query("batch_summary_orders", lambda: full_eval_with() + f"""
, npos AS (SELECT order_id, count(*) AS n_items FROM pos_raw GROUP BY order_id),
po AS (SELECT order_id, sum(hours) AS true_total, sum(pred_hours) AS pred_total, count_if(active) AS n_steps
       FROM tp_pred GROUP BY order_id)
SELECT po.order_id, f.make, CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items, {big('po.n_steps')} AS n_steps,
       {r('po.pred_total')} AS pred_total, {r('po.true_total')} AS true_total,
       {r('abs(po.true_total - po.pred_total)')} AS abs_err
FROM po JOIN feat f ON po.order_id = f.order_id LEFT JOIN npos n ON po.order_id = n.order_id""", "H")
def q_batch_summary_orders(spark, sf):
    """H5: per test order make, items, steps, predicted / true totals."""
    po = test_predictions(spark, sf).groupBy("order_id").agg(
        F.sum("hours").alias("true_total"), F.sum("pred_hours").alias("pred_total"),
        F.count_if("active").alias("n_steps"))
    npos = V.positions(spark, sf).groupBy("order_id").agg(F.count(F.lit(1)).alias("n_items"))
    f = features_frame(spark, sf).select("order_id", "make")
    d = po.join(f, "order_id").join(npos, "order_id", "left").fillna(0, ["n_items"])
    return round_doubles(d.select("order_id", "make", "n_items", "n_steps", "pred_total", "true_total",
                                  F.abs(F.col("true_total") - F.col("pred_total")).alias("abs_err")))


@query("truth_vs_pred", lambda: full_eval_with() + f"""
SELECT order_id, target, {r('hours')} AS true_hours, {r('pred_hours')} AS pred_hours, active,
       active <> (hours > 0) AS miss FROM tp_pred""", "H")
def q_truth_vs_pred(spark, sf):
    """H6: per (order, target) truth, prediction and a MISS marker."""
    tp = test_predictions(spark, sf)
    return round_doubles(tp.select("order_id", "target", F.col("hours").alias("true_hours"), "pred_hours", "active",
                                   (F.col("active") != (F.col("hours") > 0)).alias("miss")))
