"""The order view: repair-order shaped data derived from the driver tables.

An *order* is an ``orders`` row; its *positions* (line items) are its
``lineitem`` rows joined to ``part``.  Messy input is injected by fixed,
deterministic rules so every cleaning branch is exercised on real volume:

=================  ==========================================================
order_id / make    ``o_orderkey`` / ``upper(c_mktsegment)``; null when
                   ``o_orderkey % 17 = 0``
text               ``upper(p_name || ' ' || p_type || ' ' || p_brand)``; ''
                   when ``l_partkey % 13 = 0``
total_price        ``l_extendedprice``; 0 when ``l_suppkey % 7 = 0``; negated
                   when ``l_partkey % 29 = 0``
total_time         ``l_quantity``; 0 when ``l_returnflag = 'N'``
cost_center        ``lower(p_type)``; null when ``l_partkey % 23 = 0``
targets            per part type t: sum(l_quantity)/10 over the order's
                   ``l_returnflag = 'R'`` lines of type t, else 0
position order     (line_no, part_key, supp_key) - unique within an order
=================  ==========================================================

These rules rewrite values; they never drop rows (a line whose part is
missing has an empty text and no cost center).  :mod:`jobsheet.plans.sqlbase`
states the same view in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsheet.config import OrderConfig, part_catalog
from jobsheet.sources.tables import table

POS_KEY = ("line_no", "part_key", "supp_key")


def position_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to part, projected to the columns the view needs.

    ``part`` is a dimension (~1/30 of lineitem); Catalyst / AQE choose a
    broadcast hash join while it is under the broadcast threshold and a
    sort-merge join beyond, with AQE splitting skewed part keys.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_extendedprice", "l_returnflag")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    return li.join(part, li.l_partkey == part.p_partkey, "left")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw positions ``(order_id, line_no, part_key, supp_key, text,
    total_price, total_time, cost_center)`` - before cleaning."""
    j = position_lines(spark, sf_dir)
    return j.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supp_key"),
        F.when(F.col("l_partkey") % 13 == 0, F.lit(""))
        .otherwise(F.upper(F.concat_ws(" ", "p_name", "p_type", "p_brand"))).alias("text"),
        F.when(F.col("l_suppkey") % 7 == 0, F.lit(0.0))
        .when(F.col("l_partkey") % 29 == 0, -F.col("l_extendedprice"))
        .otherwise(F.col("l_extendedprice")).alias("total_price"),
        F.when(F.col("l_returnflag") == "N", F.lit(0.0))
        .otherwise(F.col("l_quantity")).alias("total_time"),
        F.when(F.col("l_partkey") % 23 == 0, F.lit(None).cast("string"))
        .otherwise(F.lower("p_type")).alias("cost_center"),
    )


def order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order universe ``(order_id)`` - for operators that need no header
    attribute (avoids the customer join, which Catalyst cannot drop)."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"))


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: ``(order_id, make, order_date)``."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey, "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderkey") % 17 == 0, F.lit(None).cast("string"))
        .otherwise(F.upper("c_mktsegment")).alias("make"),
        F.col("o_orderdate").alias("order_date"),
    )


def targets_wide(spark: SparkSession, sf_dir: str, cfg: OrderConfig | None = None) -> DataFrame:
    """One row per order, one double column per target (0 = step absent).

    A single partial+final hash aggregation over lineitem, then a join to
    the order headers so orders without lines get all-zero targets.
    """
    cfg = cfg or part_catalog()
    j = position_lines(spark, sf_dir).where(F.col("l_returnflag") == "R")
    ptype = F.lower("p_type")
    sums = j.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        *[F.sum(F.when(ptype == t, F.col("l_quantity"))).alias(t) for t in cfg.targets])
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"))
    return o.join(sums, "order_id", "left").select(
        "order_id", *[(F.coalesce(F.col(t), F.lit(0.0)) / 10.0).alias(t) for t in cfg.targets])


def targets_long(spark: SparkSession, sf_dir: str, cfg: OrderConfig | None = None) -> DataFrame:
    """``(order_id, target, hours)`` - the wide table unpivoted (no shuffle)."""
    cfg = cfg or part_catalog()
    w = targets_wide(spark, sf_dir, cfg)
    return w.unpivot("order_id", list(cfg.targets), "target", "hours")
