"""Target shaping: binarise, wide<->long, roll-ups, complexity band (B6-B10,
C10-C11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_placeholder(text: Column, placeholder: str = "[leer]") -> Column:
    """Blank document -> placeholder (inference and embeddings side)."""
    return F.when(F.trim(text) == "", F.lit(placeholder)).otherwise(text)


def binarise(wide: DataFrame, targets: Sequence[str], key: str = "order_id") -> DataFrame:
    """``hours > 0`` -> 1 / 0."""
    return wide.select(key, *[(F.col(t) > 0).cast("int").alias(t) for t in targets])


def unpivot(wide: DataFrame, targets: Sequence[str], key: str = "order_id",
            name: str = "target", value: str = "hours") -> DataFrame:
    """B8 wide -> long; narrow (an Expand per row, no shuffle)."""
    return wide.unpivot(key, list(targets), name, value)


def pivot_targets(long: DataFrame, targets: Sequence[str], key: str = "order_id",
                  name: str = "target", value: str = "hours") -> DataFrame:
    """B8 long -> wide in one aggregation of plain columns (a pivot groups by
    key and name first and keeps an array per key); missing cells become 0."""
    w = long.groupBy(key).agg(*[F.first(F.when(F.col(name) == t, F.col(value)), ignorenulls=True).alias(t) for t in targets])
    return w.select(key, *[F.coalesce(F.col(t), F.lit(0.0)).alias(t) for t in targets])


def clip_nonnegative(c: Column) -> Column:
    """``max(0, x)``."""
    return F.greatest(F.lit(0.0), c)


def align_features(df: DataFrame, saved_order: Sequence[str], key: str | None = None) -> DataFrame:
    """Project onto a saved feature order; missing -> 0.0, extras dropped."""
    have = set(df.columns)
    cols = [F.col(c) if c in have else F.lit(0.0).alias(c) for c in saved_order]
    return df.select(*([key] if key else []), *cols)


def target_rollups(wide: DataFrame, targets: Sequence[str], key: str = "order_id") -> DataFrame:
    """Per order the number of active steps and the summed hours."""
    n_active = sum((F.col(t) > 0).cast("int") for t in targets)
    total = sum(F.col(t) for t in targets)
    return wide.select(key, n_active.cast("int").alias("n_active"), total.alias("total_hours"))


def complexity_band(n_active: Column) -> Column:
    """C11: right-closed bins (-1,3], (3,6], (6,9], (9,100]."""
    return (F.when(n_active <= 3, "low").when(n_active <= 6, "medium")
            .when(n_active <= 9, "high").otherwise("very_high"))
