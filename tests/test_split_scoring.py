"""Split ranks, oversampling, explanations and scoring invariants."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from jobsheet.config import body_shop
from jobsheet.operators import scoring as H
from jobsheet.operators import split as E


def test_exact_rank_equals_row_number(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("order_id"), (F.col("id") % 3).alias("band"))
    r = E.exact_rank(df, ["band"], E.order_key("order_id"))
    w = Window.partitionBy("band").orderBy(E.order_key("order_id"))
    ref = df.withColumn("rn", F.row_number().over(w) - 1)
    j = r.join(ref, ["order_id", "band"])
    assert j.where(F.col("_rank") != F.col("rn")).count() == 0 and j.count() == 5000


def test_stratified_split_fractions(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("order_id"), (F.col("id") % 4).alias("band"))
    s = E.stratified_split(df, "band").groupBy("band", "split").count().collect()
    for r in s:
        assert r["count"] == {"test": 50, "val": 50, "train": 150}[r["split"]]


def test_random_oversample_tops_up_to_200(spark):
    rows = [(i, "t", 1 if i < 37 else 0, 1.0) for i in range(400)] + [(i, "u", 1, 1.0) for i in range(250)]
    df = spark.createDataFrame(rows, "order_id long, target string, y int, hours double")
    o = E.random_oversample(df)
    pos = {r["target"]: r["c"] for r in o.where("y = 1").groupBy("target").agg(F.count("*").alias("c")).collect()}
    assert pos == {"t": 200, "u": 250}
    assert o.where("target = 't' AND y = 0").count() == 363


def test_explanations_dedupe_cut_and_limit(spark):
    cfg = body_shop()
    long_text = "Lackieren " + "x" * 100
    texts = ["Lackieren Tür", "Lackieren Tür", long_text, long_text + "y", "Lackieren Haube", "Lackieren Dach", "Glas"]
    pos = spark.createDataFrame([(1, i, 0, 0, t) for i, t in enumerate(texts)],
                                "order_id long, line_no int, part_key long, supp_key long, text string")
    active = spark.createDataFrame([(1, "paintingSpraying")], "order_id long, target string")
    sn = H.explanation_snippets(pos, active, cfg).first()["matching_positions"]
    # cut to 80 chars before de-duplication, order kept, at most 3
    assert sn == ["Lackieren Tür", long_text[:80], "Lackieren Haube"]


def test_triggered_keywords(spark):
    cfg = body_shop()
    cols = {k: 0 for k in cfg.keyword_flags}
    cols.update(kw_lack=1, kw_klebetechnik=1)
    feats = spark.createDataFrame([(1, *cols.values())], ["order_id", *cols])
    active = spark.createDataFrame([(1, "paintingFinish")], "order_id long, target string")
    assert H.triggered_keywords(feats, active, cfg).first()["triggered_keywords"] == ["lack", "klebetechnik"]


def test_scored_invariants(spark):
    """inactive => 0 h, sum of per-target hours == total (+-0.01), keys ==
    target set - on the pseudo-scored test predictions."""
    from conftest import SF_SMALL
    from jobsheet.plans.q_eval import test_predictions
    tp = test_predictions(spark, SF_SMALL)
    assert tp.where(~F.col("active") & (F.col("pred_hours") != 0)).count() == 0
    per = tp.groupBy("order_id").agg(F.count("*").alias("k"), F.collect_set("target").alias("ts"))
    assert per.where(F.col("k") != 6).count() == 0


def test_synthetic_generator_contract(spark):
    from jobsheet.sources import synthetic as SY
    keys = spark.range(0, 3000).withColumnRenamed("id", "order_id")
    d = SY.synthetic_orders(keys).cache()
    pos = d.select("order_id", F.explode("input.calculatedPositions").alias("p"))
    assert d.where(~F.col("input.make").isin(list(SY.SYN_MAKES))).count() == 0
    n = d.select(F.size("input.calculatedPositions").alias("n")).agg(F.min("n"), F.max("n")).first()
    assert n[0] >= 1 and n[1] <= 15
    assert pos.where((F.col("p.genericCostCenter") == "material") & (F.col("p.totalTime") != 0)).count() == 0
    hail = d.where(F.exists("input.calculatedPositions", lambda p: p["text"].contains("HAGEL")
                            | p["text"].contains("DELLEN")))
    assert hail.where(F.col("output")["hailrepair"] <= 0).count() == 0
    # activity ~15% for a target without a hail rule
    share = d.select(F.avg((F.col("output")["glas"] > 0).cast("double"))).first()[0]
    assert 0.12 < share < 0.25
    again = SY.synthetic_orders(keys.repartition(7))
    flat = lambda x: x.select("order_id", "input", F.map_entries("output").alias("o"))
    assert flat(again).exceptAll(flat(d)).count() == 0
