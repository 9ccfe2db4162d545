"""Sinks and side tables (A10-A12) and the JSON fixtures written from the
order view.  Every path is under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``), never a machine-local temp directory."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsheet.session import checkpoint_dir


def shared_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([checkpoint_dir(spark).rstrip("/"), *parts])


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a table in the shared folder and read back: the lineage is cut, each row is made once
    (a checkpoint makes the last stage's rows twice) and later reads take only the columns they need."""
    path = shared_path(df.sparkSession, "kept", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_metrics(metrics: DataFrame, path: str, slot: str, model_version: str, fmt: str = "json") -> None:
    """A10: metrics partitioned by (slot, model_version); re-running a slot
    replaces only that partition (dynamic partition overwrite)."""
    df = metrics.withColumns({"slot": F.lit(slot), "model_version": F.lit(model_version)})
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("slot", "model_version").format(fmt).save(path))


# FIXED VALUES - what a model info record calls the feature groups.
FEATURE_GROUPS = ("tfidf_word_ngrams", "tfidf_char_ngrams", "numeric_aggregates", "keyword_flags", "make_encoding")


def write_model_info(spark: SparkSession, path: str, targets: Sequence[str], model_version: str = "unknown", trained_on: str = "unknown",
                     stage1: str = "boosted trees or logistic regression per target, F1-tuned thresholds",
                     stage2: str = "per-target regressor by the dispatch table") -> None:
    """A10: one JSON record that describes a bundle without loading it."""
    row = ("model_info", model_version, trained_on, len(targets), list(targets), stage1, stage2, list(FEATURE_GROUPS))
    spark.createDataFrame([row], "artifact string, model_version string, trained_on string, n_targets long, targets array<string>, "
                                 "stage1 string, stage2 string, feature_groups array<string>").write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.format(fmt).load(path)


def write_metric_csv(tables: Sequence[DataFrame], path: str) -> None:
    """Union of metric tables as CSV with a header."""
    u = tables[0]
    for t in tables[1:]:
        u = u.unionByName(t)
    u.write.mode("overwrite").option("header", True).csv(path)


def read_metric_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def order_documents(pos: DataFrame, headers: DataFrame, targets_wide: DataFrame,
                    targets: Sequence[str]) -> DataFrame:
    """Order view -> one JSON document per order, with deterministic defects:
    output missing when order_id % 101 = 0, position list null when % 103 =
    0, the line truncated (corrupt) when % 107 = 0."""
    lists = pos.groupBy("order_id").agg(F.array_sort(F.collect_list(F.struct(
        "line_no", "part_key", "supp_key", F.col("text"), F.col("total_price").alias("totalPrice"),
        F.col("total_time").alias("totalTime"), F.col("cost_center").alias("genericCostCenter")))).alias("ps"))
    d = headers.join(lists, "order_id", "left").join(targets_wide, "order_id", "left")
    oid = F.col("order_id")
    plist = F.transform(F.coalesce(F.col("ps"), F.array()), lambda p: p.dropFields("line_no", "part_key", "supp_key"))
    doc = F.struct(
        oid.alias("order_id"),
        F.struct(F.col("make"), F.when(oid % 103 == 0, F.lit(None)).otherwise(plist).alias("calculatedPositions"))
        .alias("input"),
        F.when(oid % 101 == 0, F.lit(None)).otherwise(
            F.map_from_arrays(F.array(*[F.lit(t) for t in targets]), F.array(*[F.col(t) for t in targets])))
        .alias("output"))
    corrupt = F.concat(F.lit('{"order_id": '), oid.cast("string"), F.lit(', "input": {'))
    return d.select(F.when(oid % 107 == 0, corrupt).otherwise(F.to_json(doc)).alias("value"))


def request_documents(pos: DataFrame, headers: DataFrame) -> DataFrame:
    """Order view -> API-style requests (snake_case, every number a JSON
    string, an extra key) with deterministic defects: no position list when
    order_id % 13 = 0, a non-numeric price on parts with part_key % 31 = 0."""
    lists = pos.groupBy("order_id").agg(F.array_sort(F.collect_list(F.struct(
        "line_no", "part_key", "supp_key", "text", "total_time", "total_price", "cost_center"))).alias("ps"))
    d = headers.join(lists, "order_id", "left")
    plist = F.transform(F.coalesce(F.col("ps"), F.array()), lambda p: F.struct(
        p["text"].alias("text"), p["total_time"].cast("string").alias("total_time"),
        F.when(p["part_key"] % 31 == 0, F.lit("not-a-number")).otherwise(p["total_price"].cast("string"))
        .alias("total_price"),
        p["cost_center"].alias("cost_center"), F.lit("x").alias("unknown_key")))
    oid = F.col("order_id")
    body = F.struct(oid.alias("order_id"), F.col("make"), F.lit(True).alias("explain"),
                    F.when(oid % 13 == 0, F.lit(None)).otherwise(plist).alias("calculated_positions"))
    return d.select("order_id", F.to_json(body).alias("value"))
