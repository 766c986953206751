"""Benchmark of the headline queries.

Runs each query of ``HEADLINE`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints one JSON line:
{"metric": ..., "value": total seconds, "unit": "sec", "queries": {...}, "sf": ...}.
Each query is executed to the end with the no-op sink (nothing is
collected to the driver); the time is the median of ``$BENCH_RUNS`` warm
runs (default 3) after one untimed warm-up run.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pixelchange.plans.catalogue import QUERIES  # noqa: E402
from pixelchange.session import local_session  # noqa: E402

HEADLINE = [
    "q06_training_chips",
    "q09_assemble_series",
    "q12_scores",
    "q13_harmonic_fit",
    "q15_segments",
    "q20_upsert_latest",
    "q28_feature_vector",
    "q31_full_detector",
    "q32_change_detection_job",
    "q36_decode_chip",
]


def run(spark, name, sf):
    t = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    parts = int(cpus) * 2 if cpus.isdigit() else 16
    spark = local_session(cpus, shuffle_partitions=parts, app="pixelchange-bench")
    times = {}
    for name in names:
        run(spark, name, sf_dir)                      # warm-up (JIT, file listing)
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total_median", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus, "runs": runs, "shuffle_partitions": parts}))
    spark.stop()


if __name__ == "__main__":
    main()
