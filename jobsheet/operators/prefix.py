"""Exact running sums over a sorted key, per group, without putting a whole
group into one task.

A window ``partitionBy(group).orderBy(key)`` sends every row of a group to a
single task; for keys with many distinct values (continuous features,
model probabilities) that grows with the data.  Instead:

1. ``repartitionByRange(group, key)`` - balanced, ordered chunks; a hot
   group simply spans several chunks;
2. running sums inside each (chunk, group) piece - bounded by chunk size;
3. per (chunk, group) totals -> offsets of earlier chunks of the same group
   (a window over at most #chunks rows per group);
4. running sum = offset + in-chunk running sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobsheet.session import checkpoint_dir


def prefix_sums(df: DataFrame, group: Sequence[str], key: str, values: Sequence[str],
                descending: bool = False, partitions: int | None = None) -> DataFrame:
    """Adds ``cum_<v>`` (inclusive running sum of v in key order within the
    group) and ``tot_<v>`` (group total) for every v.  Keys should be unique
    within a group (aggregate per distinct key first)."""
    group = list(group)
    order = F.col(key).desc() if descending else F.col(key).asc()
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Range bounds come from a sample of shuffled input, so two evaluations
    # could chunk differently: materialise the chunking once (reliable
    # checkpoint in the shared checkpoint folder) and derive everything from it.
    checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(n, *[F.col(g) for g in group], order) \
        .withColumn("_chunk", F.spark_partition_id()).checkpoint()
    w_in = Window.partitionBy("_chunk", *group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumns({f"_run_{v}": F.sum(v).over(w_in) for v in values})
    chunk_tot = ranged.groupBy("_chunk", *group).agg(*[F.sum(v).alias(f"_ct_{v}") for v in values])
    w_prev = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*group)
    offs = chunk_tot.select("_chunk", *group,
                            *[F.coalesce(F.sum(f"_ct_{v}").over(w_prev), F.lit(0)).alias(f"_off_{v}") for v in values],
                            *[F.sum(f"_ct_{v}").over(w_all).alias(f"tot_{v}") for v in values])
    j = local.join(offs, ["_chunk", *group])
    out = j.withColumns({f"cum_{v}": F.col(f"_off_{v}") + F.col(f"_run_{v}") for v in values})
    return out.drop("_chunk", *[f"_run_{v}" for v in values], *[f"_off_{v}" for v in values])


def exact_quantiles(df: DataFrame, value: str, quantiles: dict[str, float], group: Sequence[str] = ()) -> DataFrame:
    """Exact interpolated quantiles (name -> q) of the non-null values, per group; without a group one row (null if empty).

    Values are counted, their running counts come from :func:`prefix_sums`, and each quantile is a minimum over the
    values beyond its rank: no task holds the values of a group, as a percentile's state does."""
    group = list(group)
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    placed = prefix_sums(counts, group, "_v", ["_n"])
    picks = []
    for k, q in enumerate(quantiles.values()):
        at = F.lit(float(q)) * (F.col("tot__n") - 1)
        picks += [F.min(F.when(F.col("cum__n") > F.floor(at), F.col("_v"))).alias(f"_lo{k}"),
                  F.min(F.when(F.col("cum__n") > F.ceil(at), F.col("_v"))).alias(f"_hi{k}"), F.max(at - F.floor(at)).alias(f"_at{k}")]
    found = placed.groupBy(*group).agg(*picks)
    return found.select(*group, *[(F.col(f"_lo{k}") + (F.col(f"_hi{k}") - F.col(f"_lo{k}")) * F.col(f"_at{k}")).alias(n) for k, n in enumerate(quantiles)])
