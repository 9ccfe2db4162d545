"""Lifecycle queries (L1-L8).  Champion = the ``lr`` pseudo-model,
challenger = the ``ens`` soft vote, each with its own validation-tuned
thresholds, evaluated on the test split."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from jobsheet.config import part_catalog
from jobsheet.operators import lifecycle as L
from jobsheet.operators import metrics as J
from jobsheet.operators import thresholds as TH
from jobsheet.plans import sqlbase as S
from jobsheet.plans.q_eval import _mfw_sql, full_eval_with, scores_long, splits_frame
from jobsheet.plans.registry import query, round_doubles
from jobsheet.sources import order_view as V
from jobsheet.sources import sinks as K

CFG = part_catalog()
r, big, q = S.r, S.big, S.q
CHAMPION, CHALLENGER = "lr", "ens"


def model_predictions(spark, sf):
    sl = scores_long(spark, sf)
    th = TH.best_f1_threshold(sl.where(F.col("split") == "val"), ["model", "target"])
    p = TH.apply_threshold(sl.where(F.col("split") == "test"), th.select("model", "target", "threshold"),
                           ["model", "target"])
    return p.withColumn("pred_hours", J.cascade_hours(F.col("active"), F.col("dur")))


def model_metrics(spark, sf):
    """One record per model, under the keys of a metrics file."""
    return J.macro_and_fw(J.per_target_report(model_predictions(spark, sf), ["model", "target"]), ["model"]) \
        .withColumnsRenamed({"macro_mae_e2e": "macro_mae_hrs", "fw_mae_e2e": "fw_mae_hrs"})


MM = """
mp AS (SELECT s.model, s.order_id, s.target, s.y, s.hours, s.p >= b.threshold AS active,
              CASE WHEN s.p >= b.threshold THEN greatest(0.0, s.dur) ELSE 0.0 END AS pred_hours
       FROM sc s JOIN best b ON s.model = b.model AND s.target = b.target WHERE s.split = 'test'),
mptr AS (SELECT model, target, (tp + tn) / (tp + fp + fn + tn) AS accuracy,
                CASE WHEN 2*tp+fp+fn > 0 THEN 2.0*tp/(2*tp+fp+fn) ELSE 0.0 END AS f1,
                CASE WHEN tp+fn > 0 THEN tp/(tp+fn) ELSE 0.0 END AS recall,
                CASE WHEN tp+fp > 0 THEN tp/(tp+fp) ELSE 0.0 END AS precision, mae_e2e, prevalence
         FROM (SELECT model, target, count_if(y = 1 AND active) AS tp, count_if(y <> 1 AND active) AS fp,
                      count_if(y = 1 AND NOT active) AS fn, count_if(y <> 1 AND NOT active) AS tn,
                      avg(abs(hours - pred_hours)) AS mae_e2e, avg(y::DOUBLE) AS prevalence
               FROM mp GROUP BY model, target)),
mm AS (SELECT * RENAME (macro_mae_e2e AS macro_mae_hrs, fw_mae_e2e AS fw_mae_hrs) FROM (""" + _mfw_sql("mptr", "model", round_out=False) + """)),
mml AS (UNPIVOT mm ON COLUMNS(* EXCLUDE (model)) INTO NAME metric VALUE value)"""


def _rules_sql():
    # written out here, so that a wrong constant of the operator shows
    rows = """
    SELECT 'R1_fw_f1' AS rule_id, 'fw_f1' AS metric, '>=' AS cmp, 'minus' AS kind, 0.005::DOUBLE AS tol, 'frequency-weighted F1 may drop at most 0.005' AS description
    UNION ALL SELECT 'R2_fw_mae', 'fw_mae_hrs', '<=', 'times', 1.05::DOUBLE, 'frequency-weighted MAE may grow at most 5%'
    UNION ALL SELECT 'R3_macro_f1', 'macro_f1', '>=', 'minus', 0.010::DOUBLE, 'macro F1 may drop at most 0.010'"""
    return f"""
rules AS ({rows}),
rr AS (SELECT r.rule_id, r.metric, r.description, c.value AS champion, h.value AS challenger,
              CASE WHEN r.kind = 'minus' THEN c.value - r.tol ELSE c.value * r.tol END AS bound, r.cmp
       FROM rules r JOIN mml c ON r.metric = c.metric AND c.model = {q(CHAMPION)}
                    JOIN mml h ON r.metric = h.metric AND h.model = {q(CHALLENGER)}),
rp AS (SELECT *, CASE WHEN cmp = '>=' THEN challenger >= bound ELSE challenger <= bound END AS passed FROM rr)"""


def _rules(spark, sf):
    return L.promotion_rules(model_metrics(spark, sf), CHAMPION, CHALLENGER, L.rules_table(spark))


@query("model_metrics", lambda: full_eval_with(MM) + "\nSELECT * RENAME (macro_mae_e2e AS macro_mae_hrs, fw_mae_e2e AS fw_mae_hrs) FROM ("
       + _mfw_sql("mptr", "model") + ")", "L")
def q_model_metrics(spark, sf):
    """Metric record per model (the input of every lifecycle operator)."""
    return round_doubles(model_metrics(spark, sf))


@query("promotion_rules", lambda: full_eval_with(MM, _rules_sql()) + f"""
SELECT rule_id, metric, description, {r('champion')} AS champion, {r('challenger')} AS challenger,
       {r('bound')} AS bound, passed FROM rp""", "L")
def q_promotion_rules(spark, sf):
    """L2: R1-R3 evaluated for the challenger against the champion."""
    return round_doubles(_rules(spark, sf))


@query("promotion_decision", lambda: full_eval_with(MM, _rules_sql()) + """
SELECT CASE WHEN bool_and(passed) THEN 'PROMOTED' ELSE 'REJECTED' END AS decision,
       'DRY RUN - would be ' || CASE WHEN bool_and(passed) THEN 'PROMOTED' ELSE 'REJECTED' END AS dry_run_decision,
       CAST(count_if(passed) AS BIGINT) AS n_passed, count(*) AS n_rules,
       coalesce(list_sort(list(rule_id) FILTER (WHERE NOT passed)), []) AS failed_rules FROM rp""", "L")
def q_promotion_decision(spark, sf):
    """L4: the decision record (and its dry-run wording)."""
    rr = _rules(spark, sf)
    d = L.promotion_decision(rr)
    dry = L.promotion_decision(rr, dry_run=True).select("decision").scalar()
    return d.select("decision", dry.alias("dry_run_decision"), "n_passed", "n_rules", "failed_rules")


@query("metric_comparison", lambda: full_eval_with(MM) + f"""
, dirs AS (SELECT 'macro_f1' AS metric, 1 AS direction UNION ALL SELECT 'macro_mae_hrs', -1 UNION ALL SELECT 'fw_f1', 1
         UNION ALL SELECT 'fw_mae_hrs', -1 UNION ALL SELECT 'fw_accuracy', 1),
cmp AS (SELECT d.metric, d.direction, c.value AS champion, h.value AS challenger, h.value - c.value AS delta
        FROM dirs d JOIN mml c ON d.metric = c.metric AND c.model = {q(CHAMPION)}
                    JOIN mml h ON d.metric = h.metric AND h.model = {q(CHALLENGER)})
SELECT metric, direction, {r('champion')} AS champion, {r('challenger')} AS challenger, {r('delta')} AS delta,
       CASE WHEN sign(delta) * direction > 0 THEN 'better' WHEN sign(delta) * direction < 0 THEN 'worse'
            ELSE 'same' END AS trend FROM cmp""", "L")
def q_metric_comparison(spark, sf):
    """L3: five metrics side by side with a direction-aware trend."""
    return round_doubles(L.metric_comparison(model_metrics(spark, sf), CHAMPION, CHALLENGER))


@query("retrain_gate", lambda: full_eval_with(MM) + f"""
SELECT {r('p.macro_f1')} AS prod_f1, {r('n.macro_f1')} AS new_f1, {r('n.macro_f1 - p.macro_f1')} AS gain,
       n.macro_f1 - p.macro_f1 > 0.02 AS stage
FROM mm p, mm n WHERE p.model = {q(CHAMPION)} AND n.model = {q(CHALLENGER)}""", "L")
def q_retrain_gate(spark, sf):
    """Stage the retrained model if macro F1 gains more than 2 points."""
    return round_doubles(L.retrain_gate(model_metrics(spark, sf), CHAMPION, CHALLENGER))


@query("shadow_compare", lambda: full_eval_with(MM) + f"""
SELECT o.target, count(*) AS n, {r('100.0 * count_if(o.active = n.active) / count(*)')} AS agreement_pct,
       {r('avg(abs(n.pred_hours - o.pred_hours))')} AS mean_abs_hour_delta,
       {r('avg(n.pred_hours - o.pred_hours)')} AS mean_hour_delta
FROM mp o JOIN mp n ON o.order_id = n.order_id AND o.target = n.target
WHERE o.model = {q(CHAMPION)} AND n.model = {q(CHALLENGER)} GROUP BY o.target""", "L")
def q_shadow_compare(spark, sf):
    """Champion and challenger on the same test orders."""
    p = model_predictions(spark, sf)
    return round_doubles(L.shadow_compare(p.where(F.col("model") == CHAMPION), p.where(F.col("model") == CHALLENGER)))


@query("model_info_or_stub", lambda: full_eval_with() + f"""
, info AS (SELECT m.model, m.v AS model_version, strftime(max(h.o_orderdate), '%Y-%m-%d') AS trained_on
           FROM (SELECT {q(CHAMPION)} AS model, 'v1' AS v UNION ALL SELECT {q(CHALLENGER)}, 'v2') m,
                orders h JOIN split s ON h.o_orderkey = s.order_id WHERE s.split = 'train' GROUP BY m.model, m.v)
SELECT d.model, coalesce(i.model_version, 'unknown') AS model_version, coalesce(i.trained_on, 'unknown') AS trained_on
FROM (SELECT DISTINCT model FROM sc) d LEFT JOIN info i ON d.model = i.model""", "L")
def q_model_info_or_stub(spark, sf):
    """Info sidecar per model; models without one get the stub."""
    sp = splits_frame(spark, sf).where(F.col("split") == "train").select("order_id")
    trained = V.headers(spark, sf).join(sp, "order_id").select(
        F.date_format(F.max("order_date"), "yyyy-MM-dd")).scalar()
    info = spark.createDataFrame([(CHAMPION, "v1"), (CHALLENGER, "v2")], "model string, model_version string") \
        .withColumn("trained_on", trained)
    models = scores_long(spark, sf).select("model").distinct()
    return L.model_info_or_stub(models, info)


@query("load_metrics_checked", lambda: full_eval_with(MM) + f"""
SELECT 'ok' AS "case", 'OK' AS status, CAST([] AS VARCHAR[]) AS missing, count(*) AS n_records FROM mm WHERE model = {q(CHALLENGER)} UNION ALL
SELECT 'keys', 'MISSING_KEYS', ['macro_f1', 'fw_mae_hrs'], count(*) FROM mm WHERE model = {q(CHALLENGER)} UNION ALL
SELECT 'missing', 'MISSING_FILE', NULL, 0 UNION ALL SELECT 'malformed', 'MALFORMED', NULL, 0""", "L")
def q_load_metrics_checked(spark, sf):
    """L1: a good metrics table, one without two keys, a missing path and an unparsable file."""
    base = K.shared_path(spark, "lifecycle", uuid.uuid4().hex)
    record = model_metrics(spark, sf).where(F.col("model") == CHALLENGER)
    record.write.json(f"{base}/ok")
    spark.read.json(f"{base}/ok").drop("macro_f1", "fw_mae_hrs").write.json(f"{base}/keys")
    spark.createDataFrame([("NOT JSON !!!",)], "value string").write.text(f"{base}/malformed")
    out = None
    for case in ("ok", "keys", "missing", "malformed"):
        part = L.load_metrics_checked(spark, f"{base}/{case}").withColumn("case", F.lit(case))
        out = part if out is None else out.unionByName(part)
    return out


#: The candidates in order; the first becomes champion, the second is only tried.
CANDIDATES = (("lr", False), ("ens", True), ("ens", False), ("gbt", False), ("lr", False))


def _promote_sql():
    steps = ["s0 AS (SELECT 'lr' AS champion, 0 AS archived)"]
    rows = []
    for k, (model, dry) in enumerate(CANDIDATES[1:], 1):
        won = f"(SELECT passed FROM duel WHERE c = s{k - 1}.champion AND h = {q(model)})"
        say = f"CASE WHEN {won} THEN 'PROMOTED' ELSE 'REJECTED' END"
        steps.append(f"s{k} AS (SELECT CASE WHEN {won} AND {not dry} THEN {q(model)} ELSE champion END AS champion, "
                     f"archived + CAST({won} AND {not dry} AS INTEGER) AS archived, champion AS before, {say} AS said FROM s{k - 1})")
        rows.append(f"SELECT {k} AS step, {q(model)} AS candidate, before AS champion_before, {repr('DRY RUN - would be ')} || said AS decision, "
                    f"champion AS champion_after, archived AS n_archived FROM s{k}" if dry else
                    f"SELECT {k} AS step, {q(model)} AS candidate, before AS champion_before, said AS decision, "
                    f"champion AS champion_after, archived AS n_archived FROM s{k}")
    return full_eval_with(MM) + """
, duel AS (SELECT c.model AS c, h.model AS h, h.fw_f1 >= c.fw_f1 - 0.005::DOUBLE AND h.fw_mae_hrs <= c.fw_mae_hrs * 1.05::DOUBLE
                  AND h.macro_f1 >= c.macro_f1 - 0.010::DOUBLE AS passed FROM mm c, mm h),
""" + ",\n".join(steps) + "\n" + " UNION ALL ".join(rows)


@query("archive_and_promote", _promote_sql, "L")
def q_archive_and_promote(spark, sf):
    """A dry run, rejections and promotions one after another against the champion of the moment."""
    mm = model_metrics(spark, sf).checkpoint()  # one row per model
    slot = L.ChampionSlot(spark, K.shared_path(spark, "champion", uuid.uuid4().hex))
    rules, rows = L.rules_table(spark), []
    for k, (model, dry) in enumerate(CANDIDATES):
        record, info = mm.where(F.col("model") == model), {"model_version": f"{k}", "trained_on": "2001-01-01"}
        if not k:
            slot.promote(record, info, "t0")
            continue
        before = slot.champion().first()["model"]
        decision = slot.decide(L.promotion_rules(mm, before, model, rules), record, info, f"t{k}", dry)
        rows.append((k, model, before, decision, slot.champion().first()["model"], len(slot.archive())))
    return spark.createDataFrame(rows, "step int, candidate string, champion_before string, decision string, champion_after string, n_archived int")
