"""Scoring and explanation (G9, H1-H6) and the model bundle.

Scoring works inside the row: a raw order is cleaned, featurised, vectorised with the
bundle's frozen vocabulary, aligned to its feature order and scored without a
shuffle, identically for batch and streaming input.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobsheet.config import OrderConfig
from jobsheet.functions import cleaning as C
from jobsheet.functions.regex import search
from jobsheet.functions.stats import rnd
from jobsheet.operators import positions as P
from jobsheet.operators import text as D
from jobsheet.operators.labels import with_placeholder
from jobsheet.operators.matrix import Constant, Linear, Trees, predict
from jobsheet.sources.versions import VersionStore

#: Raised whenever a saved bundle's parts or columns change.
FORMAT = 2


@dataclass
class Bundle:
    """Everything needed to score raw orders: per-target models, thresholds, choices,
    the numeric features in order, the frozen vocabulary and the make counts."""
    targets: tuple[str, ...]
    clf: dict[str, object]
    clf_kind: dict[str, str]
    thresholds: dict[str, float]
    reg: dict[str, object]
    reg_kind: dict[str, str]
    feature_order: list[str]
    vocab: DataFrame
    make_freq: DataFrame
    info: dict = field(default_factory=dict)


#: Part -> the columns it must have.
REQUIRED_PARTS = {
    "manifest": {"manifest"}, "models": {"stage", "target", "kind", "logistic", "base", "weights", "feature", "cut", "left", "right", "value", "gain", "roots"},
    "thresholds": {"target", "threshold", "clf_kind", "reg_kind"}, "feature_order": {"idx", "feature"},
    "vocab": {"kind", "idx", "term", "idf"}, "make_freq": {"make_clean", "make_freq"},
}
_MODELS = ("stage string, target string, kind string, logistic boolean, base double, weights array<double>, feature array<long>, cut array<double>, "
           "left array<long>, right array<long>, value array<double>, gain array<double>, roots array<long>")


def _model_row(stage: str, target: str, m) -> tuple:
    if isinstance(m, Constant):
        return (stage, target, "constant", False, float(m.value), *[None] * 8)
    if isinstance(m, Linear):
        return (stage, target, "linear", m.logistic, float(m.intercept), m.weights.tolist(), *[None] * 7)
    return (stage, target, "trees", m.logistic, float(m.base), None, *[x.tolist() for x in (m.feature, m.cut, m.left, m.right, m.value, m.gain, m.roots)])


def _model(r):
    if r.kind == "constant":
        return Constant(r.base)
    if r.kind == "linear":
        return Linear(np.array(r.weights), r.base, r.logistic)
    return Trees(r.base, np.array(r.feature, np.int64), np.array(r.cut, float), np.array(r.left, np.int64), np.array(r.right, np.int64),
                 np.array(r.value, float), np.array(r.gain, float), np.array(r.roots, np.int64), r.logistic)


def save_bundle(b: Bundle, root: str) -> int:
    """A9 save: the parts into a new version folder below ``root``, then the pointer; returns the version number."""
    spark = b.vocab.sparkSession
    store = VersionStore(spark, root)
    path = store.new_folder()
    models = [_model_row("clf", t, b.clf[t]) for t in b.targets] + [_model_row("reg", t, b.reg[t]) for t in b.targets]
    spark.createDataFrame(models, _MODELS).write.parquet(f"{path}/models")
    spark.createDataFrame([(t, float(b.thresholds[t]), b.clf_kind[t], b.reg_kind[t]) for t in b.targets],
                          "target string, threshold double, clf_kind string, reg_kind string").write.parquet(f"{path}/thresholds")
    spark.createDataFrame(list(enumerate(b.feature_order)), "idx int, feature string").write.parquet(f"{path}/feature_order")
    b.vocab.write.parquet(f"{path}/vocab")
    b.make_freq.write.parquet(f"{path}/make_freq")
    manifest = json.dumps(b.info | {"format": FORMAT, "targets": list(b.targets)})
    spark.createDataFrame([(manifest,)], "manifest string").write.json(f"{path}/manifest")
    return store.publish(path)


def read_bundle(spark: SparkSession, path: str) -> Bundle:
    """A9 load of one version folder: every part must be there with its columns, else one error names all that aren't."""
    parts, bad = {}, []
    for part, columns in REQUIRED_PARTS.items():
        try:
            parts[part] = spark.read.format("json" if part == "manifest" else "parquet").load(f"{path}/{part}")
            lacking = sorted(columns - set(parts[part].columns))
            if lacking:
                bad.append(f"{part} ({', '.join(lacking)})")
        except Exception:  # missing path or unreadable part
            bad.append(part)
    if bad:
        raise ValueError(f"model bundle at {path} is missing: {', '.join(bad)}")
    man = json.loads(parts["manifest"].first()["manifest"])
    if man.get("format") != FORMAT:
        raise ValueError(f"model bundle at {path} has format {man.get('format')}, not {FORMAT}")
    models = {(r.stage, r.target): _model(r) for r in parts["models"].collect()}  # two rows per target
    th = {r["target"]: r for r in parts["thresholds"].collect()}
    targets = tuple(man["targets"])
    without = [f"{stage} of {t}" for t in targets for stage in ("clf", "reg") if (stage, t) not in models or t not in th]
    if without:
        raise ValueError(f"model bundle at {path} is missing: {', '.join(without)}")
    order = [r["feature"] for r in parts["feature_order"].orderBy("idx").collect()]
    return Bundle(targets, {t: models["clf", t] for t in targets}, {t: th[t]["clf_kind"] for t in targets}, {t: th[t]["threshold"] for t in targets},
                  {t: models["reg", t] for t in targets}, {t: th[t]["reg_kind"] for t in targets}, order, parts["vocab"], parts["make_freq"], man)


def load_bundle(spark: SparkSession, root: str) -> Bundle:
    """The current version below ``root``."""
    now = VersionStore(spark, root).current()
    if now is None:
        raise ValueError(f"no model bundle at {root}")
    b = read_bundle(spark, now["folder"])
    b.info["version"] = now["number"]
    return b


# ------------------------------------------------------------------ scoring
def score_raw(orders: DataFrame, b: Bundle, cfg: OrderConfig, explain: bool = False) -> DataFrame:
    """H1 + G9 on raw orders (order_id, make, positions of raw structs).

    Adds per target probability (4 dp), active flag, hours (2 dp) and threshold, the active targets and the
    total; with ``explain`` the explanation of every active target (H3).  ``n_positions`` counts the raw list."""
    feats = P.nested_order_row(orders, cfg)
    feats = feats.join(b.make_freq.withColumnRenamed("make_freq", "_seen"), F.col("make") == F.col("make_clean"), "left") \
        .withColumn("make_freq", F.coalesce(F.col("_seen"), F.lit(1))).drop("_seen", "make_clean")
    vocabularies = [D.Vocabulary.of(b.vocab.where(F.col("kind") == k)) for k in ("word", "char")]
    have = set(feats.columns)
    numeric = [F.col(c) if c in have else F.lit(0.0) for c in b.feature_order]  # B9: missing -> 0, others left out
    doc = with_placeholder(F.col("order_text"), cfg.empty_placeholder)
    texts = [(D.word_grams(doc, 2), vocabularies[0]), (D.char_grams(doc), vocabularies[1])]
    feats = feats.withColumn("flags", F.array(*[F.col(k) for k in cfg.keyword_flags]))
    rows = D.vectorise(feats, ["order_id", "make", "raw_positions", "total_time", "total_price", "flags", "texts"], texts, numeric)
    scored = predict(rows, [*[b.clf[t] for t in b.targets], *[b.reg[t] for t in b.targets]], "scores")
    n = len(b.targets)
    preds = []
    for k, t in enumerate(b.targets):
        p = F.get("scores", F.lit(k))
        active = p >= F.lit(float(b.thresholds[t]))
        hours = F.when(active, F.greatest(F.lit(0.0), F.get("scores", F.lit(n + k)))).otherwise(F.lit(0.0))
        preds.append(F.struct(rnd(p, 4).alias("prob"), active.alias("active"), rnd(hours, 2).alias("predicted_hours"),
                              rnd(F.lit(float(b.thresholds[t])), 2).alias("threshold")))
    out = scored.withColumn("predictions", F.map_from_arrays(F.array(*[F.lit(t) for t in b.targets]), F.array(*preds)))
    out = out.withColumn("active_targets", active_steps(F.col("predictions"), b.targets)) \
        .withColumn("total_predicted_hours", rnd(sum(F.col("predictions")[t]["predicted_hours"] for t in b.targets), 2))
    if explain:
        out = out.withColumn("explanation", row_explanation(F.col("active_targets"), F.col("flags"), F.col("texts"), cfg))
    return out.withColumnRenamed("raw_positions", "n_positions").drop("idx", "val", "scores", "flags", "texts")


def row_explanation(active: Column, flags: Column, texts: Column, cfg: OrderConfig, k: int = 3) -> Column:
    """H3 inside the row: for each active target the triggered keywords, and the first ``k`` distinct position
    texts (cut to 80 characters before) that match one of its patterns.

    ``flags`` holds the order's keyword flags, ``texts`` the stripped non-empty position texts in order."""
    names = list(cfg.keyword_flags)
    targets = [t for t in cfg.target_keywords if t in cfg.targets]

    def entry(t):
        kws = cfg.target_keywords[t]
        hit = F.filter(F.array(*[F.when(F.get(flags, F.lit(names.index(kw))) == 1, F.lit(kw.removeprefix("kw_"))) for kw in kws]), lambda x: x.isNotNull())

        def matches(x):
            found = F.lit(False)
            for kw in kws:
                found = found | search(x, cfg.keyword_flags[kw])
            return found
        cut = F.transform(F.filter(texts, matches), lambda x: F.left(x, F.lit(80)))
        return F.struct(hit.alias("triggered_keywords"), F.slice(F.array_distinct(cut), 1, k).alias("matching_positions"))
    none = F.struct(F.array().cast("array<string>").alias("triggered_keywords"), F.array().cast("array<string>").alias("matching_positions"))
    pairs = [F.when(F.array_contains(active, F.lit(t)), F.struct(F.lit(t).alias("key"), (entry(t) if t in targets else none).alias("value"))) for t in cfg.targets]
    return F.map_from_entries(F.array_compact(F.array(*pairs)))


def active_steps(pred_map: Column, targets: Sequence[str]) -> Column:
    """H2: active targets in canonical order."""
    return F.filter(F.array(*[F.lit(t) for t in targets]), lambda t: pred_map[t]["active"])


def explanation_snippets(pos: DataFrame, active: DataFrame, cfg: OrderConfig,
                         pos_key: Sequence[str] = ("line_no", "part_key", "supp_key"), k: int = 3) -> DataFrame:
    """H3 snippets: for each active (order, target) the first k distinct
    position texts (stripped, cut to 80 chars before de-duplication, in
    position order) that match any of the target's keyword patterns.

    Skew-safe: matches are (order, target, text) rows; de-duplication keeps
    the earliest position per text; ``row_number() <= k`` is applied with a
    partial group limit before the shuffle; only <= k rows are collected.
    """
    txt = C.clean_text(F.col("text"))
    patterns = list(dict.fromkeys(cfg.keyword_flags[kw] for kws in cfg.target_keywords.values() for kw in kws))  # each is searched once
    found = F.array(*[search(F.col("_t"), p) for p in patterns])
    wanted = {t: [patterns.index(cfg.keyword_flags[kw]) for kw in kws] for t, kws in cfg.target_keywords.items()}
    rows = []
    for t, at in wanted.items():
        hit = F.lit(False)
        for i in at:
            hit = hit | F.get("_found", F.lit(i))
        rows.append(F.when(hit, F.lit(t)))
    mine = pos.join(active.select("order_id").distinct(), "order_id", "left_semi")  # before any pattern is searched
    m = mine.withColumn("_t", txt).where(F.col("_t") != "").withColumn("_found", found).select(
        "order_id", *pos_key, F.left("_t", F.lit(80)).alias("snippet"), F.explode(F.array_compact(F.array(*rows))).alias("target"))
    m = m.join(active.select("order_id", "target"), ["order_id", "target"], "left_semi")
    first = m.groupBy("order_id", "target", "snippet").agg(F.min(F.struct(*pos_key)).alias("_pk"))
    w = Window.partitionBy("order_id", "target").orderBy("_pk")
    top = first.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k)
    return top.groupBy("order_id", "target").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_pk", "snippet"))), lambda x: x["snippet"])
        .alias("matching_positions"))


def triggered_keywords(feats: DataFrame, active: DataFrame, cfg: OrderConfig) -> DataFrame:
    """H3 keywords: flags = 1 among the target's keywords, 'kw_' stripped."""
    tk = F.create_map(*[x for t, kws in cfg.target_keywords.items()
                        for x in (F.lit(t), F.array(*[F.lit(kw) for kw in kws]))])
    flags = F.create_map(*[x for kw in cfg.keyword_flags for x in (F.lit(kw), F.col(kw))])
    j = active.select("order_id", "target").join(feats.select("order_id", *cfg.keyword_flags), "order_id", "left") \
        .fillna(0, list(cfg.keyword_flags))
    kws = F.filter(tk[F.col("target")], lambda kw: flags[kw] == 1)
    return j.select("order_id", "target", F.transform(kws, lambda kw: F.regexp_replace(kw, "^kw_", ""))
                    .alias("triggered_keywords"))


def explain(pos: DataFrame, feats: DataFrame, active: DataFrame, cfg: OrderConfig) -> DataFrame:
    """H3: keywords + snippets for every active (order, target)."""
    kw = triggered_keywords(feats, active, cfg)
    sn = explanation_snippets(pos, active, cfg)
    return kw.join(sn, ["order_id", "target"], "left").withColumn(
        "matching_positions", F.coalesce(F.col("matching_positions"), F.array().cast("array<string>")))


def format_response(scored: DataFrame, targets: Sequence[str], labels: dict[str, str]) -> DataFrame:
    """H4: the response document as a struct + JSON string; a target without a label is called by its id."""
    def entry(t):
        v = F.col("predictions")[t]
        return F.struct(F.lit(labels.get(t, t)).alias("label"), v["active"].alias("active"), v["prob"].alias("probability"),
                        v["threshold"].alias("threshold"), v["predicted_hours"].alias("predicted_hours"))
    predictions = F.map_from_arrays(F.array(*[F.lit(t) for t in targets]), F.array(*[entry(t) for t in targets]))
    explanation = [F.col("explanation")] if "explanation" in scored.columns else []
    resp = F.struct(
        F.col("make"), F.col("n_positions"),
        F.struct(rnd(F.col("total_time"), 2).alias("total_time_hrs"), rnd(F.col("total_price"), 2).alias("total_price_eur")).alias("input_summary"),
        predictions.alias("predictions"), F.col("active_targets").alias("active_steps"), F.col("total_predicted_hours"), *explanation)
    return scored.select("order_id", resp.alias("response"), F.to_json(resp).alias("response_json"))
