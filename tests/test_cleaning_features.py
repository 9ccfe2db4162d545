"""Position cleaning and the per-order feature row on hand fixtures."""

import math

import pytest
from pyspark.sql import functions as F

from jobsheet.config import body_shop
from jobsheet.operators import positions as P

CFG = body_shop()
POS_SCHEMA = ("order_id long, line_no int, part_key long, supp_key long, text string, "
              "total_price string, total_time string, cost_center string")


def frame(spark, rows):
    return spark.createDataFrame(rows, POS_SCHEMA)


def features(spark, rows, headers=None, clamp=False):
    pos = frame(spark, rows)
    h = headers or [(1, "VOLKSWAGEN")]
    hdr = spark.createDataFrame(h, "order_id long, make string")
    clean = P.clean_positions(pos, CFG, clamp_time=clamp)
    # empty make lookup: every make gets the default frequency 1
    mf = spark.createDataFrame([], "make_clean string, make_freq long")
    return {r["order_id"]: r.asDict() for r in P.order_features(clean, hdr, CFG, make_freq=mf).collect()}


UNIT = [(1, 1, 0, 0, "HAGEL DELLEN PDR", "250.0", "120", "bodywork"),
        (1, 2, 0, 0, "LACKIEREN KOTFLÜGEL", "180.0", "60", "painting")]


def test_unit_fixture_by_hand(spark):
    f = features(spark, UNIT)[1]
    assert f["n_positions"] == 2 and f["total_time"] == 180 and f["total_price"] == 430
    assert f["mean_time"] == 90 and f["std_time"] == 30 and f["max_price"] == 250
    assert f["time_bodywork"] == 120 and f["time_painting"] == 60
    assert math.isclose(f["ratio_painting_time"], 1 / 3) and math.isclose(f["ratio_bodywork_time"], 2 / 3)
    assert f["has_painting_cc"] == 1 and f["has_hail_cc"] == 0
    assert f["kw_hagel"] == 1 and f["kw_dellen"] == 1 and f["kw_lack"] == 1 and f["kw_glas"] == 0
    assert f["make_VOLKSWAGEN"] == 1 and f["make_other"] == 0 and f["make_freq"] == 1


def test_empty_row_dropped_and_numeric_strings(spark):
    rows = UNIT + [(1, 3, 0, 0, "", "0", "0", "")]
    assert features(spark, rows)[1]["n_positions"] == 2
    f = features(spark, [(1, 1, 0, 0, "X", "150", "90", "others")])[1]
    assert f["total_time"] == 90.0 and f["total_price"] == 150.0


def test_negative_price_clamped_then_dropped(spark):
    # empty text, negative price, zero time: price clamps to 0 -> row dropped
    f = features(spark, [(1, 1, 0, 0, "  ", "-50", "0", None), (1, 2, 0, 0, "A", "10", "1", None)])[1]
    assert f["n_positions"] == 1 and f["n_others"] == 0


def test_negative_time_batch_vs_api(spark):
    rows = [(1, 1, 0, 0, "A", "10", "-5", "painting")]
    assert features(spark, rows)[1]["total_time"] == -5.0
    assert features(spark, rows, clamp=True)[1]["total_time"] == 0.0


def test_non_numeric_is_null_not_failure(spark):
    f = features(spark, [(1, 1, 0, 0, "A", "abc", "2", "painting")])[1]
    assert f["total_price"] == 0.0 and f["total_time"] == 2.0


def test_order_without_positions_keeps_zero_row(spark):
    f = features(spark, UNIT, headers=[(1, "VOLKSWAGEN"), (2, None)])
    assert f[2]["n_positions"] == 0 and f[2]["total_time"] == 0 and f[2]["make"] == "UNKNOWN"
    assert f[2]["make_other"] == 1


def test_cross_position_pattern_and_unknown_cc(spark):
    rows = [(1, 1, 0, 0, "Kamera", "1", "1", "weird"), (1, 2, 0, 0, "Kalibrierung", "1", "1", None)]
    f = features(spark, rows)[1]
    assert f["kw_kalibrier"] == 1           # kamera.*kalib spans the two positions
    assert sum(f[f"n_{c}"] for c in CFG.cost_centers) == 0


def test_lookahead_pattern(spark):
    assert features(spark, [(1, 1, 0, 0, "Lackmaterial", "1", "1", "x")])[1]["kw_lack"] == 0
    assert features(spark, [(1, 1, 0, 0, "Lack neu", "1", "1", "x")])[1]["kw_lack"] == 1


def test_median_one_position_std_zero(spark):
    f = features(spark, [(1, 1, 0, 0, "A", "3", "7", "x")])[1]
    assert f["median_time"] == 7 and f["std_time"] == 0


def test_nested_equals_flat(spark):
    from pyspark.sql import Row
    rows = UNIT + [(1, 3, 0, 0, "Scheibe ersetzen", "99", "0", "others"), (1, 4, 0, 0, "", "0", "0", "")]
    flat = features(spark, rows)[1]
    docs = spark.createDataFrame([Row(order_id=1, positions=[
        Row(text=r[4], totalPrice=r[5], totalTime=r[6], genericCostCenter=r[7]) for r in rows])])
    nested = P.nested_order_features(docs, CFG).first().asDict()
    for k, v in nested.items():
        assert flat[k] == pytest.approx(v), k


def test_result_independent_of_partitioning(spark):
    from jobsheet.plans import q_orders
    from conftest import SF_SMALL
    a = q_orders.q_order_features(spark, SF_SMALL)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    b = q_orders.q_order_features(spark, SF_SMALL)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_suffixed_and_nan_numbers(spark):
    rows = [(1, 1, 0, 0, "A", "90d", "1.5f", "x"), (1, 2, 0, 0, "B", "NaN", "0x1p3", "x"), (1, 3, 0, 0, "C", " 1e2 ", "inf", "x")]
    got = P.clean_positions(frame(spark, rows), CFG, clamp_time=True).orderBy("line_no").collect()
    assert [r.total_price for r in got] == [0, 0, 100] and [r.total_time for r in got] == [0, 0, math.inf]
