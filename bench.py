"""Headline timings: one JSON line.

Each query is built and fully executed from the given tables (results go to the
no-op sink); shared intermediates are dropped before every timing, so a number
includes everything the query needs.  The median of BENCH_REPEAT runs counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roispark import build_session
from roispark.catalog import queries
from roispark.catalog.base import forget

HEADLINE = [
    "j2_overlap_counts", "m1_intensity", "m11_roi_metrics", "g2_cutoffs", "g5_two_pass_gate", "k2_stable_matching",
    "k3_match_table", "k11_constraint_audit", "l1_relabel", "q1_mask_statistics", "q2_connected_components",
    "r2_gated_pairs", "r6_register", "t2_grouping_sets", "t6_kruskal_wallis", "t15_model_rows", "i9_fingerprints",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": str(2 * int(cpus) if cpus.isdigit() else 16),
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "20g"),
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    every = queries()
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    # Class loading and code generation are paid once per session, on the smallest tables.
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    for name in ("m11_roi_metrics", "k3_match_table", "t6_kruskal_wallis"):
        if os.path.isdir(small):
            every[name](spark, small).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        runs = []
        for _ in range(repeat):
            forget()
            start = time.perf_counter()
            every[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
