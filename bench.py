"""Time the headline queries and print one JSON line.

BENCH_SF_DIR picks the data (default /root/testdata/sf0.1), BENCH_CPUS the cores. Every
query builds its input from the parquet tables and is materialised whole; nothing is kept
between queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import QUERIES  # noqa: E402
from plumbline.session import local_session  # noqa: E402

HEADLINE = [
    "e8_suite_results", "e9_unexpected_rows", "x3_unique", "x5_patterns", "c1_missing_values_severe", "c6_conjoined_severe",
    "r5_cap_outliers", "r9_isolation_forest", "r11_chained", "r14_revalidated", "d11_report_shared", "s5_derived_append",
    "q1_lineage", "m5_split", "m9_test_metrics", "m10_roc_auc", "m11_class_report", "m12_cv_summary", "m13_comparison",
    "f6_arrivals", "m6_logistic_regression", "m7_random_forest", "m14_training_run",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the engine before the clock
    times = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
