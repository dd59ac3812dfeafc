"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full through the ``noop`` sink (no rows are
collected to the driver) and timed; one JSON line is printed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskweave.plans import registry  # noqa: E402
from riskweave.session import build_session  # noqa: E402

HEADLINE = [
    "build_features",            # flagship: every per-user feature, one wide row per user
    "w03_fail_streak",           # segmented sequence scan
    "a19_card_sharing",          # user-card graph rollups
    "g04_g05_graph_oof",         # leakage-safe graph features, 5 folds in one pass
    "g01_target_encode_oof",     # out-of-fold target encoding
    "t02_cramers_v",             # 11x11 association matrix (the reference's "about 5 minutes" step)
    "t03_theils_u",
    "t04_t05_feature_report",    # AUC + point-biserial over 46 features
    "g08_g09_knn_distance",      # exact KNN (train and test)
    "g11_lof",                   # local outlier factor
    "m05_threshold_sweep",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    spark.read.parquet(f"{sf_dir}/events.parquet").count()          # JVM warm-up, not timed
    times = {}
    for name in (only or HEADLINE):
        t0 = time.time()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
