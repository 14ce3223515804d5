"""Benchmark of the headline queries.

Runs each query twice on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]`` and forces full evaluation with a ``noop``
write (nothing is collected). Prints one JSON line: the warm (second) run
per query, their sum as ``value``, and the cold runs alongside.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from benchtrail.registry import QUERIES, load_all  # noqa: E402
from benchtrail.session import build_session  # noqa: E402

HEADLINE = {
    "r1_regression_alert": "r1_regression_alert",
    "a12_latest_record": "a12_latest_record",
    "r4_delta_histogram": "a9_delta_histogram",
    "r4_compare_builds": "a8_compare_builds",
    "j5_coverage_chain": "j5_coverage_chain",
    "j6_token_match": "j6_token_match_documents",
    "a1_loop_merge": "a1_merge_loops",
    "s2_parse_profile_report": "s2_parse_profile_report",
    "r8_culprit_search": "r8_culprit_search",
    "r5_compat_summary": "r5_compat_test_summary",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", app="benchtrail-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    load_all()
    cold, warm = {}, {}
    for label, name in HEADLINE.items():
        for run in (cold, warm):
            t = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            run[label] = round(time.time() - t, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_warm_total", "value": round(sum(warm.values()), 3), "unit": "sec",
                      "queries": warm, "cold": cold, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
