"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion with the ``noop`` sink (full computation, nothing collected),
after one untimed warm-up pass of the same queries on the sf0.01 tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flowguard.plans.queries import REGISTRY  # noqa: E402
from flowguard.session import build_session  # noqa: E402

HEADLINE = [
    "m20_prepare",
    "m21_prepare_all",
    "j_graph_lookup",
    "w4_stratified_split",
    "a15_inspection",
    "a5_medians",
    "w1_pr_curve_lineitem",
    "a18_roc_auc",
    "a22_attack_types",
    "m14_threshold_analysis",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    # warm-up: JIT-compile the same code paths on the 10x smaller tables (not timed)
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in names:
        REGISTRY[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
        spark.catalog.clearCache()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        spark.catalog.clearCache()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
