"""Benchmark the headline queries.

Runs each query to completion through Spark's ``noop`` sink (the whole
plan executes, nothing is collected to the driver) and prints one JSON
line. Environment: BENCH_SF_DIR (default /root/testdata/sf0.1),
BENCH_CPUS (default 8), BENCH_REPS (default 1; the median is reported),
BENCH_QUERIES (comma list, default the headline set).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "q_score_summary", "q_unit_extract", "q_line_extract", "q_adult_extract", "q_child_extract",
    "q_response_summary", "q_locations", "q_response_report", "q_question_summary", "q_goal_cascade",
    "q_monthly_percent", "q_percentile_lookup", "q_assignment_audit", "q_goals_conformed",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from boxscore.registry import QUERIES
    from boxscore.session import get_session

    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus * 2, app_name="boxscore-bench")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        elapsed = time.perf_counter() - t0
        spark.catalog.clearCache()  # no stage cached by one query may serve the next
        return elapsed

    run(names[0])  # warm-up: JVM, code generation, file listing caches
    timings = {}
    for name in names:
        timings[name] = round(statistics.median(run(name) for _ in range(reps)), 3)
        print(f"{name}: {timings[name]} s", file=sys.stderr, flush=True)
    sf = sf_dir.rsplit("sf", 1)[-1] if "sf" in os.path.basename(sf_dir) else sf_dir
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": cpus, "reps": reps}))
    spark.stop()


if __name__ == "__main__":
    main()
