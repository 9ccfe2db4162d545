"""Benchmark: run the headline queries on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and print ONE JSON line.

Each query is executed completely with the ``noop`` sink (every row is
produced, nothing is collected to the driver).  ``value`` is the summed wall
time of the headline queries; ``orders_per_sec`` is the flagship feature
query's throughput (orders featurised per second).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "order_features", "clean_positions", "order_texts", "eda_order_features", "cooccurrence",
    "nonzero_distribution", "token_frequency", "rule_baseline", "conversion_grid", "spearman_matrix",
    "stratified_split", "threshold_sweep_f1", "average_precision", "clf_metrics", "macro_fw_metrics",
    "explain_orders", "tfidf_weights", "validate_requests", "prevalence_report", "rolling_prevalence_drift",
    "feature_drift", "score_stream", "stream_error_rate",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from jobsheet.session import local_session
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus if cpus.isdigit() else "8")),
                          app="jobsheet-bench")
    from jobsheet.plans import catalog  # noqa: F401
    from jobsheet.plans.registry import REGISTRY
    # warm the JVM / parquet footers once so the first query is not billed for start-up
    spark.read.parquet(f"{sf_dir}/orders.parquet").write.format("noop").mode("overwrite").save()
    if "score_stream" in names:  # the files that arrive are a fixture, not part of the query
        from jobsheet.plans.q_stream import order_files
        order_files(spark, sf_dir)
    times: dict[str, float] = {}
    for n in names:
        t0 = time.perf_counter()
        df = REGISTRY[n].fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
        print(f"# {n}: {times[n]:.2f}s", file=sys.stderr, flush=True)
    n_orders = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    sf = sf_dir.split("sf")[-1]
    out = {
        "metric": "headline_queries_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "orders": n_orders,
        "orders_per_sec": round(n_orders / times["order_features"], 1) if "order_features" in times else None,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
