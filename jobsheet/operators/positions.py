"""Position cleaning (B*) and the per-order feature row.

Flat form: one row per position, ``order_id`` + position-order key.  The
feature row is ONE ``groupBy(order_id)`` whose aggregates are all partial
(map-side) aggregations: sums / counts / max / moments are algebraic, exact
``median`` keeps a value->count map per group (memory grows with the number
of *distinct* values, not rows), and the order text is a sorted
``collect_list`` - the text of an order is itself the feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsheet.config import OrderConfig
from jobsheet.functions import cleaning as C
from jobsheet.functions.regex import search
from jobsheet.functions.stats import safe_div
from jobsheet.sources.order_view import POS_KEY


def explode_positions(orders: DataFrame, positions_col: str = "positions",
                      keep: Sequence[str] = ("order_id", "make")) -> DataFrame:
    """Nested order -> one row per position (B1); ``pos`` is 0-based.

    Orders with an empty / null list keep one row with null position fields
    (``posexplode_outer``) so they are not lost.  Narrow: no shuffle.
    """
    return orders.select(*keep, F.posexplode_outer(positions_col).alias("pos", "p")).select(
        *keep, "pos", "p.*")


def clean_positions(pos: DataFrame, cfg: OrderConfig, clamp_time: bool = False,
                    blank_cc_is_null: bool = False) -> DataFrame:
    """Coerce the four position fields and drop fully empty rows (B2).

    A row is dropped when its text is empty AND price is 0 AND time is 0,
    price being tested after clamping (so an empty row with a negative price
    is dropped too).
    """
    cleaned = pos.withColumns({
        "text": C.trimmed_text(F.col("text")),
        "total_price": C.clean_price(F.col("total_price"), C.is_double(pos, "total_price")),
        "total_time": C.clean_time(F.col("total_time"), clamp_time, C.is_double(pos, "total_time")),
        "cost_center": C.clean_cost_center(F.col("cost_center"), cfg.unknown_cc, blank_cc_is_null),
    })
    keep = (F.col("total_price") != 0) | (F.col("total_time") != 0) | (F.col("text") != "")  # the text is cleaned where the numbers don't decide
    return cleaned.where(keep)


def useful(price: Column, time: Column) -> Column:
    """A position carries work when price > 0 or time > 0."""
    return (price > 0) | (time > 0)


def _is_useful() -> Column:
    return useful(F.col("total_price"), F.col("total_time"))


def order_aggregates(clean: DataFrame, cfg: OrderConfig, key: str = "order_id",
                     pos_key: Sequence[str] = POS_KEY) -> DataFrame:
    """C1-C3 + texts, one row per order that has at least one clean position."""
    t, p, cc = F.col("total_time"), F.col("total_price"), F.col("cost_center")
    aggs = [
        F.count(F.lit(1)).alias("n_positions"),
        F.count_if(_is_useful()).alias("n_useful"),
        F.count_if(t == 0).alias("n_zero_time"),
        F.count_if(p == 0).alias("n_zero_price"),
        F.sum(t).alias("total_time"),
        F.sum(p).alias("total_price"),
        F.max(t).alias("max_time"),
        F.avg(t).alias("mean_time"),
        F.median(t).alias("median_time"),
        F.max(p).alias("max_price"),
        F.avg(p).alias("mean_price"),
        F.stddev_pop(t).alias("std_time"),
        F.stddev_pop(p).alias("std_price"),
    ]
    for c in cfg.cost_centers:
        aggs += [
            F.sum(F.when(cc == c, t)).alias(f"time_{c}"),
            F.sum(F.when(cc == c, p)).alias(f"price_{c}"),
            F.count_if(cc == c).alias(f"n_{c}"),
        ]
    # one sorted list of (position key, text, useful) serves both texts
    aggs.append(F.array_sort(F.collect_list(F.struct(
        *[F.col(k) for k in pos_key], F.lower("text").alias("t"), _is_useful().alias("u")))).alias("_parts"))
    g = clean.groupBy(key).agg(*aggs)
    return g.withColumns({
        # Every cleaned position, empties included (double blanks kept)
        "full_text": F.array_join(F.transform("_parts", lambda x: x["t"]), " "),
        # Useful, non-empty positions only
        "order_text": F.array_join(F.transform(
            F.filter("_parts", lambda x: x["u"] & (F.trim(x["t"]) != "")), lambda x: x["t"]), " "),
    }).drop("_parts")


NUMERIC_ZERO_FILL = (
    "n_positions", "n_useful", "n_zero_time", "n_zero_price", "total_time", "total_price",
    "max_time", "mean_time", "median_time", "max_price", "mean_price", "std_time", "std_price",
)


def feature_columns(cfg: OrderConfig) -> list[str]:
    """Numeric feature names in canonical order (the saved feature order)."""
    cols = list(NUMERIC_ZERO_FILL)
    for c in cfg.cost_centers:
        cols += [f"time_{c}", f"price_{c}", f"n_{c}"]
    cols += [f"ratio_{c}_time" for c in cfg.ratio_time_ccs]
    cols += [f"ratio_{c}_price" for c in cfg.ratio_price_ccs]
    cols += [f"has_{c}_cc" for c in cfg.flag_ccs]
    cols += list(cfg.keyword_flags)
    cols += ["make_freq"] + [make_col(m) for m in cfg.top_makes] + ["make_other"]
    return cols


def make_col(m: str) -> str:
    return "make_" + m.replace("-", "_")


def make_frequency(headers: DataFrame) -> DataFrame:
    """Make -> number of orders with that make (over all given orders).

    Result size is bounded by the number of distinct makes; AQE turns the
    join below into a broadcast at run time when it is small.
    """
    return headers.groupBy(C.clean_make(F.col("make")).alias("make_clean")).agg(
        F.count(F.lit(1)).alias("make_freq"))


def order_features(clean: DataFrame, headers: DataFrame, cfg: OrderConfig,
                   make_freq: DataFrame | None = None, key: str = "order_id") -> DataFrame:
    """The full per-order feature row.

    ``headers`` is the order universe ``(order_id, make)``; orders whose
    positions were all dropped keep a row of zeros (never a crash).
    """
    agg = order_aggregates(clean, cfg, key)
    h = headers.select(key, C.clean_make(F.col("make")).alias("make_clean"))
    df = h.join(agg, key, "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in NUMERIC_ZERO_FILL}
    for c in cfg.cost_centers:
        for pre in ("time_", "price_", "n_"):
            zero[pre + c] = F.coalesce(F.col(pre + c), F.lit(0))
    zero["full_text"] = F.coalesce(F.col("full_text"), F.lit(""))
    zero["order_text"] = F.coalesce(F.col("order_text"), F.lit(""))
    df = df.withColumns(zero)
    tt, tp = F.col("total_time"), F.col("total_price")
    derived = {}
    for c in cfg.ratio_time_ccs:
        derived[f"ratio_{c}_time"] = safe_div(F.col(f"time_{c}"), tt)
    for c in cfg.ratio_price_ccs:
        derived[f"ratio_{c}_price"] = safe_div(F.col(f"price_{c}"), tp)
    for c in cfg.flag_ccs:
        derived[f"has_{c}_cc"] = (F.col(f"n_{c}") > 0).cast("int")
    for name, pat in cfg.keyword_flags.items():
        derived[name] = search(F.col("full_text"), pat).cast("int")
    df = df.withColumns(derived)
    mf = make_freq if make_freq is not None else make_frequency(headers)
    df = df.join(mf, "make_clean", "left").withColumn(
        "make_freq", F.coalesce(F.col("make_freq"), F.lit(1)))
    onehot = {make_col(m): (F.col("make_clean") == m).cast("int") for m in cfg.top_makes}
    onehot["make_other"] = (~F.col("make_clean").isin(list(cfg.top_makes))).cast("int")
    df = df.withColumns(onehot)
    return df.select(key, F.col("make_clean").alias("make"), *feature_columns(cfg),
                     "full_text", "order_text")


def order_text_frame(clean: DataFrame, orders: DataFrame, cfg: OrderConfig, key: str = "order_id") -> DataFrame:
    """B4 / B5 / C6 only: order texts and keyword flags for every order of
    ``orders`` (the order universe), without the header / make joins the
    full feature row needs.  Unused aggregates are pruned by Catalyst."""
    agg = order_aggregates(clean, cfg, key).select(key, "full_text", "order_text")
    d = orders.select(key).join(agg, key, "left").fillna("", ["full_text", "order_text"])
    return d.withColumns({name: search(F.col("full_text"), pat).cast("int")
                          for name, pat in cfg.keyword_flags.items()})


def eda_ratio_ccs(cfg: OrderConfig) -> list[str]:
    """The profiling variant keeps time ratios for the first two ratio centres
    that are among its (all-but-last) cost centres."""
    ccs = cfg.cost_centers[:-1] if len(cfg.cost_centers) > 1 else cfg.cost_centers
    return [c for c in cfg.ratio_time_ccs if c in ccs][:2]


def eda_order_features(pos: DataFrame, headers: DataFrame, cfg: OrderConfig,
                       key: str = "order_id") -> DataFrame:
    """The profiling variant - raw rows (no drop, no clamp), cost centres
    without the last one, ratios for the first two ratio centres.

    Raw numerics are coerced with try_cast -> 0; null cost centres match
    nothing.  Orders without positions get no row (inner semantics).
    """
    t = F.coalesce(C.to_double(F.col("total_time")), F.lit(0.0))
    p = F.coalesce(C.to_double(F.col("total_price")), F.lit(0.0))
    cc = F.coalesce(F.col("cost_center"), F.lit(""))
    ccs = cfg.cost_centers[:-1] if len(cfg.cost_centers) > 1 else cfg.cost_centers
    aggs = [
        F.count(F.lit(1)).alias("n_positions"),
        F.count_if((p > 0) | (t > 0)).alias("n_useful"),
        F.count_if(t == 0).alias("n_zero_time"),
        F.count_if(p == 0).alias("n_zero_price"),
        F.sum(t).alias("total_time_input"),
        F.sum(p).alias("total_price_input"),
        F.max(t).alias("max_time_pos"),
        F.avg(t).alias("mean_time_pos"),
        F.max(p).alias("max_price_pos"),
        F.avg(p).alias("mean_price_pos"),
    ]
    for c in ccs:
        aggs += [F.coalesce(F.sum(F.when(cc == c, t)), F.lit(0.0)).alias(f"time_{c}"),
                 F.coalesce(F.sum(F.when(cc == c, p)), F.lit(0.0)).alias(f"price_{c}"),
                 F.count_if(cc == c).alias(f"n_{c}")]
    g = pos.groupBy(key).agg(*aggs)
    r = {f"ratio_{c}_time": safe_div(F.col(f"time_{c}"), F.col("total_time_input"))
         for c in eda_ratio_ccs(cfg)}
    g = g.withColumns(r)
    return headers.select(key, F.coalesce(F.col("make"), F.lit("unknown")).alias("make")).join(g, key, "inner")


def nested_order_features(orders: DataFrame, cfg: OrderConfig, positions_col: str = "positions",
                          key: str = "order_id", carry: Sequence[str] = ()) -> DataFrame:
    """C1-C6 computed inside each order document with higher-order functions:
    no shuffle, no state - the form used for streams of whole orders.

    ``positions`` holds raw ``struct<text, totalPrice, totalTime,
    genericCostCenter>`` in position order.
    """
    kept = F.filter(F.transform(positions_col, lambda p: F.struct(
        C.clean_text(p["text"]).alias("text"), C.clean_price(p["totalPrice"]).alias("price"),
        C.clean_time(p["totalTime"]).alias("time"),
        C.clean_cost_center(p["genericCostCenter"], cfg.unknown_cc).alias("cc"))),
        lambda p: (p["text"] != "") | (p["price"] != 0) | (p["time"] != 0))
    # the cleaned list, then what several features need of it, are columns of their own: each is evaluated once a row
    ps = F.col("_kept")

    def total(f, pred=None):
        return F.aggregate(ps, F.lit(0.0), lambda acc, p: acc + (F.when(pred(p), p[f]).otherwise(0.0) if pred else p[f]))

    def count(pred):
        return F.aggregate(ps, F.lit(0).cast("long"), lambda acc, p: acc + F.when(pred(p), 1).otherwise(0))

    d = orders.select(key, kept.alias("_kept"), *carry)
    d = d.select("*", F.size(ps).alias("_n"), F.array_sort(F.transform(ps, lambda p: p["time"])).alias("_times"),
                 total("time").alias("_time"), total("price").alias("_price"),
                 F.array_join(F.transform(ps, lambda p: F.lower(p["text"])), " ").alias("_text"))
    n, times, tt, tp = F.col("_n"), F.col("_times"), F.col("_time"), F.col("_price")
    half = (n / 2).cast("int")
    median = F.when(n == 0, F.lit(0.0)).when(n % 2 == 1, F.element_at(times, half + 1)).otherwise(
        (F.element_at(times, F.greatest(half, F.lit(1))) + F.element_at(times, half + 1)) / 2)
    mean_t = F.when(n > 0, tt / n).otherwise(0.0)
    mean_p = F.when(n > 0, tp / n).otherwise(0.0)

    def std(f, mu):
        return F.when(n > 0, F.sqrt(F.aggregate(ps, F.lit(0.0), lambda acc, p: acc + (p[f] - mu) * (p[f] - mu)) / n)) \
            .otherwise(0.0)
    cols = {
        "n_positions": n.cast("long"),
        "n_useful": count(lambda p: (p["price"] > 0) | (p["time"] > 0)),
        "n_zero_time": count(lambda p: p["time"] == 0),
        "n_zero_price": count(lambda p: p["price"] == 0),
        "total_time": tt, "total_price": tp,
        "max_time": F.coalesce(F.array_max(F.transform(ps, lambda p: p["time"])), F.lit(0.0)),
        "mean_time": mean_t, "median_time": median,
        "max_price": F.coalesce(F.array_max(F.transform(ps, lambda p: p["price"])), F.lit(0.0)),
        "mean_price": mean_p, "std_time": std("time", mean_t), "std_price": std("price", mean_p),
    }

    def is_cc(c):
        return lambda p: p["cc"] == c
    for c in cfg.cost_centers:
        cols[f"time_{c}"] = total("time", is_cc(c))
        cols[f"price_{c}"] = total("price", is_cc(c))
        cols[f"n_{c}"] = count(is_cc(c))
    for name, pat in cfg.keyword_flags.items():
        cols[name] = search(F.col("_text"), pat).cast("int")
    return d.select(key, *[v.alias(k) for k, v in cols.items()], *[F.col(c) for c in carry])


def nested_order_row(orders: DataFrame, cfg: OrderConfig, positions_col: str = "positions", key: str = "order_id") -> DataFrame:
    """The whole feature row (C1-C8 without the make count) and the texts of raw orders (order_id, make, positions), inside the row.

    ``raw_positions`` counts the list as it came, ``texts`` are its stripped non-empty texts in order."""
    none = F.array().cast(orders.schema[positions_col].dataType)
    named = orders.select(key, F.coalesce(F.col(positions_col), none).alias("_ps"), F.col("make").alias("_make"))
    f = nested_order_features(named, cfg, "_ps", key, carry=("_ps", "_make"))
    kept = F.filter(F.transform("_ps", lambda p: F.struct(
        C.clean_text(p["text"]).alias("text"), C.clean_price(p["totalPrice"]).alias("price"), C.clean_time(p["totalTime"]).alias("time"))),
        lambda p: useful(p["price"], p["time"]) & (p["text"] != ""))
    make = C.clean_make(F.col("_make"))
    derived = {"make": make, "order_text": F.array_join(F.transform(kept, lambda p: F.lower(p["text"])), " "),
               "texts": F.filter(F.transform("_ps", lambda p: C.clean_text(p["text"])), lambda x: x != ""),
               "raw_positions": F.size("_ps").cast("long")}
    derived |= {f"ratio_{c}_time": safe_div(F.col(f"time_{c}"), F.col("total_time")) for c in cfg.ratio_time_ccs}
    derived |= {f"ratio_{c}_price": safe_div(F.col(f"price_{c}"), F.col("total_price")) for c in cfg.ratio_price_ccs}
    derived |= {f"has_{c}_cc": (F.col(f"n_{c}") > 0).cast("int") for c in cfg.flag_ccs}
    derived |= {make_col(m): (make == m).cast("int") for m in cfg.top_makes}
    derived["make_other"] = (~make.isin(list(cfg.top_makes))).cast("int")
    return f.withColumns(derived).drop("_ps", "_make")
