"""Headline queries timed on one machine; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS set the data, the cores and the runs per query.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from feira.queries import queries  # noqa: E402
from feira.session import build_session  # noqa: E402

HEADLINE = [
    "d1_sales_by_category_month", "d4_customer_segments", "c5_sellers_within_800km", "b15_fuzzy_name",
    "b26_text_search", "d27_origin_destination", "i1_event_buckets", "i3_sessions", "c9_promotion_at_order",
    "k1_product_catalog", "d21_iqr_price", "e4_status_transitions", "k5_freight_by_distance",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
                                      "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g"})
    spark.sparkContext.setLogLevel("ERROR")
    registered, timed = queries(), {}
    names = sys.argv[1:] or HEADLINE
    for name in names:
        samples = []
        for run in range(runs + 1):
            start = time.perf_counter()
            registered[name](spark, folder).write.format("noop").mode("overwrite").save()
            if run:  # the first run warms up
                samples.append(time.perf_counter() - start)
        timed[name] = round(statistics.median(samples), 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "headline query time, sum of medians", "value": round(sum(timed.values()), 3), "unit": "sec",
        "queries": timed, "sf": float(scale.group(1)) if scale else folder, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
