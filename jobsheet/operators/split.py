"""Splitting, weighting and resampling.

The stratified split needs an exact rank of each order inside its stratum.
A window partitioned by stratum alone would put a whole stratum (there are
only four) into one task, so the rank is built in two levels: the hex digest
``md5(order_id)`` is uniform, its first three digits give 4,096 sub-buckets
per stratum; a tiny aggregate gives each sub-bucket's offset and a window
over (stratum, sub-bucket) ranks inside it.  Exact, and no partition holds
more than ~1/16,384 of the orders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_key(col: str = "order_id") -> Column:
    """Portable deterministic sort key (same digest in any SQL engine)."""
    return F.md5(F.col(col).cast("string"))


def exact_rank(df: DataFrame, group: Sequence[str], key: Column, prefix_len: int = 3) -> DataFrame:
    """Add ``_rank`` (0-based rank of ``key`` within ``group``) and ``_n``
    (group size) without a window over the whole group."""
    d = df.withColumns({"_k": key, "_b": F.substring(key, 1, prefix_len)})
    counts = d.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_cb"))
    wcum = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    wall = Window.partitionBy(*group)
    counts = counts.withColumns({"_off": F.coalesce(F.sum("_cb").over(wcum), F.lit(0)),
                                 "_n": F.sum("_cb").over(wall)})
    inner = Window.partitionBy(*group, "_b").orderBy("_k")
    d = d.withColumn("_r", F.row_number().over(inner) - 1)
    return d.join(counts, [*group, "_b"]).withColumn("_rank", F.col("_off") + F.col("_r")) \
        .drop("_k", "_b", "_cb", "_off", "_r")


def stratified_split(df: DataFrame, stratum: str, key_col: str = "order_id",
                     test_frac: float = 0.2, val_frac_of_rest: float = 0.25) -> DataFrame:
    """60/20/20 train/val/test, stratified, deterministic.

    In each stratum the first ``test_frac`` of md5 order are test, the next
    ``val_frac_of_rest * (1 - test_frac)`` are validation.  Falls back to one
    stratum when a stratum has fewer than 2 members.
    """
    small = df.groupBy(stratum).count().agg(F.min("count")).scalar()
    strat = F.when(small < 2, F.lit("all")).otherwise(F.col(stratum).cast("string"))
    d = df.withColumn("_stratum", strat)
    r = exact_rank(d, ["_stratum"], order_key(key_col))
    val_frac = val_frac_of_rest * (1 - test_frac)
    pos = F.col("_rank").cast("double")
    n = F.col("_n").cast("double")
    split = (F.when(pos < test_frac * n, "test")
             .when(pos < (test_frac + val_frac) * n, "val").otherwise("train"))
    return r.withColumn("split", split).drop("_rank", "_n", "_stratum")


def split_distribution(splits: DataFrame) -> DataFrame:
    """Sizes per split and n_active value counts per split."""
    return splits.groupBy("split", "n_active").agg(F.count(F.lit(1)).alias("n_orders"))


def time_split(df: DataFrame, ts: str, val_start: str, test_start: str) -> DataFrame:
    """Past -> train, [val_start, test_start) -> val, later -> test."""
    t = F.col(ts)
    return df.withColumn("split", F.when(t < F.lit(val_start).cast("timestamp_ntz"), "train")
                         .when(t < F.lit(test_start).cast("timestamp_ntz"), "val").otherwise("test"))


def class_weights(train_long: DataFrame, group: Sequence[str] = ("target",), y: str = "y",
                  eps: float = 1e-9) -> DataFrame:
    """w+ = max(1, n- / (n+ + eps)), w- = 1."""
    g = train_long.groupBy(*group).agg(F.count_if(F.col(y) == 1).alias("n_pos"),
                                       F.count_if(F.col(y) == 0).alias("n_neg"))
    return g.withColumn("w_pos", F.greatest(F.lit(1.0), F.col("n_neg") / (F.col("n_pos") + F.lit(eps))))


DRAW_CHUNK = 100_000


def random_oversample(train_long: DataFrame, target_n: int = 200, seed: int = 42,
                      key: str = "order_id", y: str = "y") -> DataFrame:
    """For targets with 0 < n+ < target_n, add drawn copies of positives
    until there are exactly target_n.  Draw j takes the positive whose rank (by md5 of the key) is a
    hash of (seed, target, j) modulo n+: with replacement, repeatable, portable.

    The ranks are exact over all tasks (:func:`exact_rank`), the draws are made in chunks and both are dealt by
    (target, rank), so neither positives nor draws of one target meet in one task."""
    pos = train_long.where(F.col(y) == 1)
    small = pos.groupBy("target").agg(F.count(F.lit(1)).alias("n_pos")).where(F.col("n_pos") < target_n)
    ranked = exact_rank(pos.join(small, "target"), ["target"], order_key(key)).withColumnRenamed("_rank", "idx").drop("_n", "n_pos")
    need = F.lit(target_n) - F.col("n_pos")
    chunks = small.select("target", "n_pos", F.explode(F.sequence(F.lit(0), ((need - 1) / DRAW_CHUNK).cast("long"))).alias("_c")) \
        .repartition("target", "_c")
    last = F.least(need, (F.col("_c") + 1) * DRAW_CHUNK) - 1
    draws = chunks.select("target", "n_pos", F.explode(F.sequence(F.col("_c") * DRAW_CHUNK, last)).alias("j"))
    hashed = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), "target", F.col("j").cast("string"))), 1, 12), 16, 10).cast("long")
    draws = draws.select("target", (hashed % F.col("n_pos")).alias("idx"), "j")
    extra = draws.join(ranked, ["target", "idx"]).withColumn("copy", F.col("j") + 1).drop("j", "idx")
    base = train_long.withColumn("copy", F.lit(0).cast("long"))
    return base.unionByName(extra.select(*base.columns))


def winsorise(df: DataFrame, train: DataFrame, value: str = "hours", q: float = 0.95,
              group: Sequence[str] = ("target",)) -> DataFrame:
    """E5: clip to [0, p95 of the training positives] (exact percentile)."""
    caps = train.where(F.col(value) > 0).groupBy(*group).agg(
        F.percentile(value, F.lit(q)).alias("cap"))
    return df.join(caps, list(group), "left").withColumn(
        f"{value}_wins", F.least(F.greatest(F.col(value), F.lit(0.0)), F.coalesce(F.col("cap"), F.col(value))))


def skew_screen(long: DataFrame, value: str = "hours", ratio_min: float = 3.0, skew_min: float = 3.0) -> DataFrame:
    """Targets whose positives have max/p95 >= 3 and skew >= 3."""
    from jobsheet.functions.stats import sample_skewness
    pos = long.where(F.col(value) > 0)
    n = F.count(F.lit(1))
    g = pos.groupBy("target").agg(n.alias("n"), F.max(value).alias("max"),
                                  F.percentile(value, F.lit(0.95)).alias("p95"),
                                  sample_skewness(F.col(value), n.cast("double")).alias("skew"))
    return g.withColumn("winsorise", (F.col("max") / F.col("p95") >= ratio_min) & (F.col("skew") >= skew_min))
