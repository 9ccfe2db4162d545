"""Request contract (quarantine cases) and lifecycle rule boundaries."""

import json

import pytest
from pyspark.sql import functions as F

from jobsheet.operators import lifecycle as L
from jobsheet.sources import json_orders as A


def verdicts(spark, bodies):
    raw = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, value string")
    v = A.validate_requests(A.parse_requests(raw))
    return {r["i"]: [e["field"] + ":" + e["issue"] for e in r["errors"]] for r in v.collect()}, v


def test_request_cases(spark):
    p = {"text": "x", "total_time": 1, "total_price": 2, "cost_center": "painting"}
    bodies = [
        json.dumps({"make": "VW", "calculated_positions": []}),
        json.dumps({"make": "VW"}),
        json.dumps({"calculated_positions": [dict(p, total_price="not-a-number")]}),
        json.dumps({"order_id": 7, "calculated_positions": [dict(p, unknown_key=1)]}),
        json.dumps({"make": None, "calculated_positions": [p]}),
        json.dumps({"calculated_positions": [dict(p, total_price=-50.0)]}),
        json.dumps({"calculated_positions": [{"text": None, "total_time": None, "total_price": None,
                                              "cost_center": "  "}]}),
        "NOT JSON !!!",
    ]
    got, v = verdicts(spark, bodies)
    assert got[0] == ["calculated_positions:at least 1 item required"]
    assert got[1] == ["calculated_positions:field required"]
    assert got[2] == ["total_price:not a number"]
    assert got[3] == [] and got[4] == [] and got[5] == [] and got[6] == []
    assert got[7] == ["body:malformed JSON"]
    ok, bad = A.split_quarantine(v)
    a = {r["i"]: r for r in A.adapt_requests(ok).collect()}
    assert a[4]["make"] == "UNKNOWN"
    assert a[5]["positions"][0]["totalPrice"] == 0.0
    assert a[6]["positions"][0]["genericCostCenter"] == "unknown_cc" and a[6]["positions"][0]["text"] == ""
    assert bad.count() == 4


CHAMP = {"macro_f1": .838, "macro_recall": .860, "macro_accuracy": .938, "macro_mae_hrs": .96,
         "fw_f1": .935, "fw_recall": .941, "fw_accuracy": .943, "fw_mae_hrs": .80}


def decide(spark, chall):
    rows = [("champ", *CHAMP.values()), ("chall", *[chall.get(k, v) for k, v in CHAMP.items()])]
    m = spark.createDataFrame(rows, ["model", *CHAMP])
    rr = L.promotion_rules(m, "champ", "chall", L.rules_table(spark))
    return {r["rule_id"]: r["passed"] for r in rr.collect()}, L.promotion_decision(rr).first()["decision"]


def test_rules_better_and_worse(spark):
    assert decide(spark, {"fw_f1": .940, "macro_f1": .840})[1] == "PROMOTED"
    rules, d = decide(spark, {"fw_f1": .920, "fw_mae_hrs": .90})
    assert d == "REJECTED" and not rules["R1_fw_f1"] and not rules["R2_fw_mae"] and rules["R3_macro_f1"]


def test_rule_boundaries_inclusive(spark):
    # values exactly on the bounds pass (computed the same way as the rules)
    rules, d = decide(spark, {"fw_f1": .935 - 0.005, "fw_mae_hrs": .80 * 1.05, "macro_f1": .838 - 0.010})
    assert d == "PROMOTED", rules


def test_load_metrics_checked(spark, tmp_path):
    good, bad, part = str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "part")
    spark.createDataFrame([tuple(CHAMP.values())], list(CHAMP)).write.json(good)
    spark.createDataFrame([("NOT JSON !!!",)], "v string").write.text(bad)
    spark.createDataFrame([(0.9,)], "fw_f1 double").write.json(part)
    assert L.load_metrics_checked(spark, good).first()["status"] == "OK"
    assert L.load_metrics_checked(spark, str(tmp_path / "nope")).first()["status"] == "MISSING_FILE"
    assert L.load_metrics_checked(spark, bad).first()["status"] == "MALFORMED"
    r = L.load_metrics_checked(spark, part).first()
    assert r["status"] == "MISSING_KEYS" and "macro_f1" in r["missing"]


def test_corrupt_lines_can_be_counted(spark, tmp_path):
    from jobsheet.sources import json_orders as J
    (tmp_path / "o.json").write_text('{"order_id": 1, "input": {"make": "A", "calculatedPositions": []}, "output": {}}\n\n{"order_id": 2, "input": {\n')
    o = J.read_orders(spark, str(tmp_path / "o.json"))
    assert o.count() == 2 and o.where("valid").count() == 1 and o.where("NOT valid").count() == 1
    assert J.filter_valid(o).count() == 1


def test_records_by_index(spark):
    from jobsheet.sources import json_orders as J
    df = spark.createDataFrame([(k * 3,) for k in range(11)], "k long").repartition(4)
    assert sorted(map(tuple, J.records_at(df, "k", [0, 10, 11, -1, 25]).collect())) == [(-1, 10, 30), (0, 0, 0), (10, 10, 30), (11, 0, 0), (25, 3, 9)]
    assert J.records_at(df.limit(0), "k", [1]).collect() == []


@pytest.fixture
def slot(spark, tmp_path):
    return L.ChampionSlot(spark, str(tmp_path / "slot"))


def record(spark, name, **change):
    return spark.createDataFrame([(name, *(CHAMP | change).values())], ["model", *CHAMP])


def rules(spark, change):
    m = record(spark, "champ").unionByName(record(spark, "chall", **change))
    return L.promotion_rules(m, "champ", "chall", L.rules_table(spark))


def test_promotion_archives_and_rejection_and_dry_run_change_nothing(spark, slot, tmp_path):
    slot.promote(record(spark, "champ"), {"model_version": "1/a", "trained_on": "2026-03-01"}, "t0")
    better = {"fw_f1": .940, "macro_f1": .840}
    files = sorted(p.relative_to(tmp_path) for p in tmp_path.rglob("*"))
    assert slot.decide(rules(spark, better), record(spark, "chall"), {}, "t1", dry_run=True) == "DRY RUN - would be PROMOTED"
    assert slot.decide(rules(spark, {"fw_f1": .5}), record(spark, "chall"), {}, "t1") == "REJECTED"
    assert files == sorted(p.relative_to(tmp_path) for p in tmp_path.rglob("*")) and slot.archive() == []
    assert slot.decide(rules(spark, better), record(spark, "chall"), {"model_version": "2", "trained_on": "2026-04-01"}, "t2") == "PROMOTED"
    assert slot.champion().first()["model"] == "chall"
    old = slot.archive()
    assert [x["slot"] for x in old] == ["champion_v1-a_20260301_t2"] and spark.read.parquet(old[0]["folder"]).first()["model"] == "champ"


def test_promotion_survives_a_crash(spark, slot):
    slot.promote(record(spark, "champ"), {}, "t0")
    publish, slot.store.publish = slot.store.publish, None  # dies between writing and moving the pointer
    with pytest.raises(TypeError):
        slot.promote(record(spark, "chall"), {}, "t1")
    slot.store.publish = publish
    assert slot.champion().first()["model"] == "champ" and slot.recover() == 1 and slot.recover() == 0
    assert slot.champion().first()["model"] == "champ"
    slot.promote(record(spark, "chall"), {}, "t2")
    assert slot.champion().first()["model"] == "chall" and len(slot.archive()) == 1


def test_two_promotions_at_once(spark, slot):
    slot.promote(record(spark, "champ"), {}, "t0")
    publish = slot.store.publish

    def late(*a, **k):  # another promotion comes first
        slot.store.publish = publish
        slot.promote(record(spark, "other"), {}, "t1")
        return publish(*a, **k)
    slot.store.publish = late
    with pytest.raises(RuntimeError):
        slot.promote(record(spark, "chall"), {}, "t1")
    assert slot.champion().first()["model"] == "other"
