"""Times headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tidemark.catalog import QUERIES
from tidemark.session import DEFAULTS

HEADLINE = [
    "drift_report", "drift_summary_scored", "psi_numeric", "psi_categorical", "ks_two_sample", "ks_all_columns",
    "quantile_edges", "histogram_on_edges", "hist30", "category_counts", "binary_metrics", "class_report",
    "stratified_split", "stratified_folds", "standardize_ref_fit", "one_hot_long", "label_encode", "trial_mean",
    "payload_normalize", "people_fanout", "window_psi", "smote_counts", "pca_explained", "gbt_score", "rf_importance",
]


WARM_UP = "drift_report"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("tidemark-bench")
    conf = {**DEFAULTS, "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false"}
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    # One untimed run of the flagship: JVM start-up and class loading are not a query.
    QUERIES[WARM_UP](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in wanted:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "warm_up": WARM_UP, "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
