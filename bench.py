"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric": "total_sec", "value": N, "unit": "sec",
"queries": {...}, "sf": ...}.  Each query is forced to completion with the
``noop`` sink (full execution, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "null_report", "describe", "iqr_outlier_report", "correlation_matrix", "box_stats", "histogram",
    "impute_median", "winsorize", "parse_money", "pct_change", "label_encode", "one_hot_drop_first",
    "stratified_split", "stratified_kfold", "roc_auc", "split_report", "classification_report",
    "train_two_labels", "winners", "nearest_centre", "silhouette", "knn", "dbscan_kind", "lof",
    "relabel", "model_forest", "model_logistic", "stream_profile", "csv_roundtrip", "prepare_orders",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    os.environ["TESSERA_MASTER"] = f"local[{cpus}]"
    os.environ.setdefault("TESSERA_SHUFFLE_PARTITIONS", str(max(int(cpus), 8)))
    from tessera.plans.registry import queries
    from tessera.session import get_spark
    spark = get_spark()
    qs = queries()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in qs]
    times = {}
    from tessera.plans import label_audit, modelling
    spark.range(1000).selectExpr("sum(id)").collect()  # the JVM's start is no query's time
    for n in names:
        label_audit._cache.clear()  # each query makes its own tables
        modelling._cache.clear()
        t = time.time()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t, 3)
        print(f"{n}: {times[n]}s", file=sys.stderr, flush=True)  # progress; stdout keeps the one JSON line
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
