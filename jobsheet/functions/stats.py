"""Statistics helpers shared by profiling and evaluation operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rnd(c: Column, digits: int = 6) -> Column:
    """Round half-up through IEEE arithmetic only: floor(x*10^d + 0.5)/10^d.

    Spark's ``round`` rounds the decimal representation, other engines round
    the binary value; this form gives bit-identical results everywhere.
    """
    scale = float(10 ** digits)
    return (F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).cast("double")


def safe_div(num: Column, den: Column, default: float = 0.0) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(default))


def sample_skewness(x: Column, n: Column) -> Column:
    """Bias-corrected skewness G1 = g1 * sqrt(n(n-1)) / (n-2); null when n < 3."""
    g1 = F.skewness(x)
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(x: Column, n: Column) -> Column:
    """Bias-corrected excess kurtosis G2; null when n < 4."""
    g2 = F.kurtosis(x)
    return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    den = 2 * tp + fp + fn
    return F.when(den > 0, 2 * tp / den).otherwise(F.lit(0.0))


def precision(tp: Column, fp: Column) -> Column:
    return F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))


def recall(tp: Column, fn: Column) -> Column:
    return F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
