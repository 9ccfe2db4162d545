"""Model lifecycle as tables (L1-L8): checked metric loading, promotion
rules, comparison, decision, archive + pointer, retrain gate, shadow run.

Metric records are one row per model: ``(model, macro_*, fw_*)``.  Rules
are data (a small table), evaluated by a join + ``bool_and``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsheet.sources.versions import VersionStore

# FIXED VALUES - the keys a metrics record must have.
REQUIRED_KEYS = ("macro_f1", "fw_f1", "fw_mae_hrs", "macro_mae_hrs")

# FIXED VALUES - promotion rules of the original: id, metric, comparison,
# tolerance kind, tolerance.  challenger must satisfy: cmp(challenger, bound)
PROMOTION_RULES = (
    ("R1_fw_f1", "fw_f1", ">=", "minus", 0.005, "frequency-weighted F1 may drop at most 0.005"),
    ("R2_fw_mae", "fw_mae_hrs", "<=", "times", 1.05, "frequency-weighted MAE may grow at most 5%"),
    ("R3_macro_f1", "macro_f1", ">=", "minus", 0.010, "macro F1 may drop at most 0.010"),
)
# FIXED VALUES - the metrics that are shown side by side; -1 where less is better.
COMPARED = (("macro_f1", 1), ("macro_mae_hrs", -1), ("fw_f1", 1), ("fw_mae_hrs", -1), ("fw_accuracy", 1))


def load_metrics_checked(spark: SparkSession, path: str, required: Sequence[str] = REQUIRED_KEYS) -> DataFrame:
    """L1: read a metrics JSON table; distinct outcomes for a missing path,
    unparsable content and missing required keys (required minus present)."""
    schema_row = "status string, missing array<string>, n_records long"
    try:
        df = spark.read.option("mode", "PERMISSIVE").json(path)
    except Exception as ex:  # path does not exist
        if "PATH_NOT_FOUND" in str(ex) or "does not exist" in str(ex):
            return spark.createDataFrame([("MISSING_FILE", None, 0)], schema_row)
        raise
    cols = set(df.columns)
    if cols <= {"_corrupt_record"}:
        return spark.createDataFrame([("MALFORMED", None, 0)], schema_row)
    missing = [k for k in required if k not in cols]
    n = df.select(F.count(F.lit(1))).scalar()
    return spark.range(1).select(
        F.lit("MISSING_KEYS" if missing else "OK").alias("status"),
        F.array(*[F.lit(m) for m in missing]).cast("array<string>").alias("missing"), n.alias("n_records"))


def rules_table(spark: SparkSession, rules=PROMOTION_RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "rule_id string, metric string, cmp string, kind string, "
                                              "tol double, description string")


def _long(metrics: DataFrame, model_col: str = "model") -> DataFrame:
    keys = [c for c in metrics.columns if c != model_col]
    return metrics.unpivot(model_col, keys, "metric", "value")


def promotion_rules(metrics: DataFrame, champion: str, challenger: str, rules: DataFrame) -> DataFrame:
    """L2: each rule evaluated inclusively on raw floats."""
    lg = _long(metrics)
    c = lg.where(F.col("model") == champion).select("metric", F.col("value").alias("champion"))
    h = lg.where(F.col("model") == challenger).select("metric", F.col("value").alias("challenger"))
    j = F.broadcast(rules).join(c, "metric").join(h, "metric")  # rules: a handful of rows
    bound = F.when(F.col("kind") == "minus", F.col("champion") - F.col("tol")).otherwise(F.col("champion") * F.col("tol"))
    passed = F.when(F.col("cmp") == ">=", F.col("challenger") >= bound).otherwise(F.col("challenger") <= bound)
    return j.select("rule_id", "metric", "description", "champion", "challenger", bound.alias("bound"),
                    passed.alias("passed"))


def metric_comparison(metrics: DataFrame, champion: str, challenger: str, compared=COMPARED) -> DataFrame:
    """L3: delta per metric and a direction-aware trend."""
    spark = metrics.sparkSession
    dirs = F.broadcast(spark.createDataFrame(list(compared), "metric string, direction int"))
    lg = _long(metrics)
    c = lg.where(F.col("model") == champion).select("metric", F.col("value").alias("champion"))
    h = lg.where(F.col("model") == challenger).select("metric", F.col("value").alias("challenger"))
    d = dirs.join(c, "metric").join(h, "metric").withColumn("delta", F.col("challenger") - F.col("champion"))
    s = F.signum(F.col("delta")) * F.col("direction")
    return d.withColumn("trend", F.when(s > 0, "better").when(s < 0, "worse").otherwise("same"))


def promotion_decision(rule_results: DataFrame, dry_run: bool = False) -> DataFrame:
    """L4: PROMOTED when every rule passes, else REJECTED; dry runs say what
    would happen and write nothing."""
    g = rule_results.agg(F.bool_and("passed").alias("all_passed"), F.count_if("passed").alias("n_passed"),
                         F.count(F.lit(1)).alias("n_rules"),
                         F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("rule_id")))).alias("failed_rules"))
    verdict = F.when(F.col("all_passed"), "PROMOTED").otherwise("REJECTED")
    if dry_run:
        verdict = F.concat(F.lit("DRY RUN - would be "), verdict)
    rules = rule_results.select(F.collect_list(F.struct(
        F.col("rule_id").alias("id"), F.col("description"), F.col("passed"),
        F.format_string("%s: challenger %.4f vs bound %.4f", F.col("metric"), F.col("challenger"),
                        F.col("bound")).alias("detail"))).alias("rules"))
    return g.select(verdict.alias("decision"), "n_passed", "n_rules", "failed_rules",
                    rules.scalar().alias("rules"))


class ChampionSlot:
    """The champion and its archive as versions of one store.

    A promotion writes the challenger's record into a new folder and then moves the pointer, which names
    the new champion and archives the old one in a single step: a crash before it leaves the champion as it
    was (and a folder that :meth:`recover` removes), a crash after it leaves nothing to do."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.store = spark, VersionStore(spark, root)

    def champion(self) -> DataFrame | None:
        now = self.store.current()
        return None if now is None else self.spark.read.parquet(now["folder"])

    def archive(self) -> list[dict]:
        """The former champions, oldest first, with their slot names."""
        found = self.store.entries()
        return [old | {"slot": new["archived"]} for old, new in zip(found, found[1:])]

    def promote(self, metrics: DataFrame, info: dict, stamp: str) -> int:
        """Make ``metrics`` (one record) the champion; fails if another promotion came between."""
        now = self.store.current()
        folder = self.store.new_folder()
        metrics.write.parquet(folder)
        slot = None
        if now is not None:
            version = str(now.get("model_version", "unknown")).replace("/", "-")
            slot = f"champion_v{version}_{str(now.get('trained_on', 'unknown')).replace('-', '')}_{stamp}"
        return self.store.publish(folder, expected=now["number"] if now else 0, archived=slot, promoted_at=stamp, **info)

    def decide(self, rules: DataFrame, metrics: DataFrame, info: dict, stamp: str, dry_run: bool = False) -> str:
        """The decision (L4), carried out unless it is a rejection or a dry run."""
        decision = promotion_decision(rules, dry_run).first()["decision"]
        if decision == "PROMOTED":
            self.promote(metrics, info, stamp)
        return decision

    def recover(self) -> int:
        """Remove the folders of promotions that never moved the pointer; call it where no promotion is running."""
        return self.store.sweep()


def model_info_or_stub(models: DataFrame, info: DataFrame) -> DataFrame:
    """Model info joined on the model; missing -> 'unknown' stub."""
    j = models.join(info, "model", "left")
    return j.select("model", F.coalesce("model_version", F.lit("unknown")).alias("model_version"),
                    F.coalesce("trained_on", F.lit("unknown")).alias("trained_on"))


def retrain_gate(metrics: DataFrame, production: str, retrained: str, min_gain: float = 0.02) -> DataFrame:
    """Stage a retrained model when its macro F1 beats production by
    more than ``min_gain``."""
    p = metrics.where(F.col("model") == production).select(F.col("macro_f1").alias("prod_f1"))
    r = metrics.where(F.col("model") == retrained).select(F.col("macro_f1").alias("new_f1"))
    g = p.select("prod_f1", r.select("new_f1").scalar().alias("new_f1"))
    return g.withColumn("gain", F.col("new_f1") - F.col("prod_f1")).withColumn(
        "stage", F.col("gain") > min_gain)


def shadow_compare(old: DataFrame, new: DataFrame, on: Sequence[str] = ("order_id", "target")) -> DataFrame:
    """The same orders through two models - per target agreement of the
    active flags and hour deltas."""
    j = old.select(*on, F.col("active").alias("a_old"), F.col("pred_hours").alias("h_old")).join(
        new.select(*on, F.col("active").alias("a_new"), F.col("pred_hours").alias("h_new")), list(on))
    return j.groupBy("target").agg(
        F.count(F.lit(1)).alias("n"),
        (100.0 * F.count_if(F.col("a_old") == F.col("a_new")) / F.count(F.lit(1))).alias("agreement_pct"),
        F.avg(F.abs(F.col("h_new") - F.col("h_old"))).alias("mean_abs_hour_delta"),
        F.avg(F.col("h_new") - F.col("h_old")).alias("mean_hour_delta"))
