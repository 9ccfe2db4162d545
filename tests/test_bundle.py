"""Bundle versions, scoring of raw orders, responses and streaming with a moving pointer."""

import json
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobsheet.config import body_shop
from jobsheet.operators import positions as P
from jobsheet.operators import scoring as H
from jobsheet.operators.matrix import Constant, Linear, Trees
from jobsheet.sources.versions import VersionStore

CFG = body_shop()
RAW = "order_id long, make string, positions array<struct<text:string,totalPrice:string,totalTime:string,genericCostCenter:string>>"
ORDERS = [
    (1, "VW", [("HAGELSCHADENREPARATUR DELLEN PDR", "2000", "10", "hail"), ("Lackieren Tür", "300.5", "2", "painting"), ("", "0", "0", None)]),
    (2, None, [("test position", "-5", "120", "painting")]),
    (3, "AUDI", []),
    (4, " audi ", None),
    (5, "BMW", [(None, "abc", None, ""), ("Lackieren " + "x" * 100, "1", "1", "painting"), ("Lackieren " + "x" * 100, "2", "1", "painting")]),
]


def bundle(spark, p=0.9):
    order = [c for c in P.feature_columns(CFG) if c != "price_material"] + ["gone_feature"]  # one left out, one that no longer exists
    words, chars = ["hagelschadenreparatur", "lackieren", "lackieren tür", "test"], [" te", "est"]
    vocab = spark.createDataFrame([("word", k, t, 1.0 + k) for k, t in enumerate(words)] + [("char", k, t, 2.0) for k, t in enumerate(chars)],
                                  "kind string, idx int, term string, idf double")
    n = len(words) + len(chars) + len(order)
    targets = CFG.targets
    clf = {t: Constant(p if k % 2 == 0 else 0.2) for k, t in enumerate(targets)}
    w = np.zeros(n)
    w[1], w[len(words) + len(chars) + order.index("total_time")] = 3.0, -0.25
    clf[targets[1]] = Linear(w, 0.5, True)
    reg = {t: Constant(1.256) for t in targets}
    at = len(words) + len(chars) + order.index("make_freq")
    reg[targets[0]] = Trees(1.0, np.array([at, -1, -1]), np.array([3.5, 0, 0]), np.array([1, -1, -1]), np.array([2, -1, -1]),
                            np.array([0.0, -9.0, 2.5]), np.array([1.0, 0, 0]), np.array([0]))
    make = spark.createDataFrame([("AUDI", 7), ("VW", 2)], "make_clean string, make_freq long")
    return H.Bundle(targets, clf, {t: "lr" for t in targets}, {t: 0.5 for t in targets}, reg, {t: "lgbm" for t in targets}, order, vocab, make)


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bundle") / "b")
    H.save_bundle(bundle(spark), path)
    return path


def rows(df):
    return {r.order_id: r.asDict(recursive=True) for r in df.collect()}


def test_score_is_the_same_before_and_after_saving(spark, root):
    orders = spark.createDataFrame(ORDERS, RAW)
    a, b = rows(H.score_raw(orders, bundle(spark), CFG, explain=True)), rows(H.score_raw(orders, H.load_bundle(spark, root), CFG, explain=True))
    assert a == b and set(a) == {1, 2, 3, 4, 5}


def test_invariants(spark, root):
    out = rows(H.score_raw(spark.createDataFrame(ORDERS, RAW), H.load_bundle(spark, root), CFG, explain=True))
    for r in out.values():
        assert set(r["predictions"]) == set(CFG.targets)
        assert r["total_predicted_hours"] >= 0 and abs(sum(p["predicted_hours"] for p in r["predictions"].values()) - r["total_predicted_hours"]) < 0.01
        for t, p in r["predictions"].items():
            assert p["active"] or p["predicted_hours"] == 0.0
            assert (t in r["active_targets"]) == p["active"]
        assert set(r["explanation"]) == set(r["active_targets"])
    assert [out[k]["n_positions"] for k in (1, 2, 3, 4, 5)] == [3, 1, 0, 0, 3]
    first = CFG.targets[0]
    # make count: AUDI 7 > 3.5 -> 1 + 2.5; VW 2 and unseen 1 -> 1 - 9, floored at 0
    assert [out[k]["predictions"][first]["predicted_hours"] for k in (1, 2, 3, 4)] == [0.0, 0.0, 3.5, 3.5]
    assert out[3]["make"] == "AUDI" and out[4]["make"] == "AUDI" and out[2]["make"] == "UNKNOWN"


def test_vector_blocks_and_alignment(spark, root):
    """The linear model sees the frozen TF-IDF weight of its word and the aligned total time."""
    out = rows(H.score_raw(spark.createDataFrame(ORDERS, RAW), H.load_bundle(spark, root), CFG))
    # order 1: words hagelschadenreparatur, lackieren, 'lackieren tür' with idf 1, 2, 3
    weight = 2 / np.sqrt(1 + 4 + 9)
    z = 3.0 * weight - 0.25 * 12 + 0.5
    assert out[1]["predictions"][CFG.targets[1]]["prob"] == pytest.approx(1 / (1 + np.exp(-z)), abs=6e-5)


def test_explanation(spark, root):
    out = rows(H.score_raw(spark.createDataFrame(ORDERS, RAW), bundle(spark, 0.99), CFG, explain=True))
    hail = out[1]["explanation"].get("hailrepair")
    assert hail == {"triggered_keywords": ["hagel", "dellen"], "matching_positions": ["HAGELSCHADENREPARATUR DELLEN PDR"]}
    spraying = out[5]["explanation"].get("paintingSpraying")
    if spraying is not None:  # cut to 80 characters before equal texts become one
        assert spraying["matching_positions"] == [("Lackieren " + "x" * 100)[:80]]


def test_response_shape(spark, root):
    labels = {k: v for k, v in CFG.target_labels.items() if k != CFG.targets[0]}
    scored = H.score_raw(spark.createDataFrame(ORDERS, RAW), H.load_bundle(spark, root), CFG, explain=True)
    for r in H.format_response(scored, CFG.targets, labels).collect():
        body = json.loads(r.response_json)
        assert {"make", "n_positions", "input_summary", "predictions", "active_steps", "total_predicted_hours", "explanation"} <= set(body)
        assert set(body["input_summary"]) == {"total_time_hrs", "total_price_eur"}
        for t, p in body["predictions"].items():
            assert set(p) == {"label", "active", "probability", "threshold", "predicted_hours"}
        assert body["predictions"][CFG.targets[0]]["label"] == CFG.targets[0]  # no label: the id
        assert all(set(body["explanation"][s]) == {"triggered_keywords", "matching_positions"} for s in body["active_steps"])
    plain = H.format_response(H.score_raw(spark.createDataFrame(ORDERS, RAW), H.load_bundle(spark, root), CFG), CFG.targets, labels)
    assert "explanation" not in json.loads(plain.first().response_json)


def test_missing_parts_columns_and_format_are_reported(spark, tmp_path):
    with pytest.raises(ValueError, match="no model bundle"):
        H.load_bundle(spark, str(tmp_path / "none"))
    spark.createDataFrame([("{}",)], "manifest string").write.json(str(tmp_path / "b" / "manifest"))
    spark.createDataFrame([(0,)], "idx int").write.parquet(str(tmp_path / "b" / "feature_order"))
    with pytest.raises(ValueError) as e:
        H.read_bundle(spark, str(tmp_path / "b"))
    said = str(e.value).split("missing:")[1]
    assert "models" in said and "vocab" in said and "feature_order (feature)" in said and "manifest" not in said
    path = str(tmp_path / "c")
    H.save_bundle(bundle(spark), path)
    folder = VersionStore(spark, path).current()["folder"]
    spark.createDataFrame([('{"format": 1, "targets": []}',)], "manifest string").write.mode("overwrite").json(f"{folder}/manifest")
    with pytest.raises(ValueError, match="format 1"):
        H.load_bundle(spark, path)


def test_pointer_moves_once_per_version(spark, tmp_path):
    store = VersionStore(spark, str(tmp_path / "v"))
    assert store.current() is None and store.entries() == []
    assert store.publish("x/1", who="a") == 1
    numbers, errors = [], []

    def writer(k):
        try:
            numbers.append(VersionStore(spark, str(tmp_path / "v")).publish(f"x/{k}"))
        except Exception as ex:
            errors.append(ex)
    threads = [threading.Thread(target=writer, args=(k,)) for k in range(2, 6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and sorted(numbers) == [2, 3, 4, 5] and store.current()["number"] == 5
    with pytest.raises(RuntimeError):
        store.publish("x/9", expected=2)
    assert len(store.entries()) == 5 and not [p for p in (tmp_path / "v").iterdir() if p.name.startswith("aside")]


def test_nested_row_equals_the_grouped_features(spark):
    """The in-row features of raw orders are those of the flat positions."""
    from conftest import SF_SMALL
    from jobsheet.plans import q_models as Q
    from jobsheet.plans.q_orders import features_frame
    flat = features_frame(spark, SF_SMALL)
    nested = P.nested_order_row(Q.raw_orders(spark, SF_SMALL), Q.CFG)
    names = [c for c in P.feature_columns(Q.CFG) if c != "make_freq"]
    j = flat.alias("a").join(nested.alias("b"), "order_id")
    bad = [F.count_if(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) > 1e-6 * (1 + F.abs(F.col(f"a.{c}")))).alias(c) for c in names]
    bad += [F.count_if(F.col("a.order_text") != F.col("b.order_text")).alias("order_text"), F.count_if(F.col("a.make") != F.col("b.make")).alias("make")]
    assert {k: v for k, v in j.select(*bad).first().asDict().items() if v} == {} and j.count() == flat.count()


def documents(tmp, name, orders):
    (tmp / "in").mkdir(exist_ok=True)
    lines = [json.dumps({"order_id": i, "input": {"make": m, "calculatedPositions": ps and [dict(zip(("text", "totalPrice", "totalTime", "genericCostCenter"), p)) for p in ps]}})
             for i, m, ps in orders]
    (tmp / "in" / name).write_text("\n".join([*lines, '{"order_id": 99, "input": {']))


def test_stream_takes_a_new_version_and_replays_batches(spark, tmp_path):
    from jobsheet.plans.q_stream import order_stream
    from jobsheet.streaming.monitor import score_order_stream
    root, out, check = (str(tmp_path / x) for x in ("bundle", "out", "check"))
    H.save_bundle(bundle(spark, 0.9), root)
    documents(tmp_path, "a.json", ORDERS[:2])

    def run():
        score_order_stream(order_stream(spark, str(tmp_path / "in")), root, out, check, CFG, explain=True).awaitTermination()
        return {r.order_id: r for r in spark.read.parquet(out).collect()}
    assert {k: r.model_version for k, r in run().items()} == {1: 1, 2: 1}
    H.save_bundle(bundle(spark, 0.8), root)
    documents(tmp_path, "b.json", ORDERS[2:])
    found = run()
    assert {k: r.model_version for k, r in found.items()} == {1: 1, 2: 1, 3: 2, 5: 2}  # order 4 has no list: A2 drops it
    for r in found.values():
        batch = H.score_raw(spark.createDataFrame([o for o in ORDERS if o[0] == r.order_id], RAW), bundle(spark, 0.9 if r.model_version == 1 else 0.8), CFG, explain=True)
        assert H.format_response(batch, CFG.targets, CFG.target_labels).first().response == r.response  # the stream equals the batch
    # a batch that runs again after a lost commit replaces what it left
    commits = sorted((tmp_path / "check" / "commits").glob("[0-9]*"))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    assert len(run()) == 4 and spark.read.parquet(out).count() == 4
