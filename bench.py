"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row is
produced, nothing is collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harvestwatch.queries import queries  # noqa: E402
from harvestwatch.session import get_spark  # noqa: E402

HEADLINE = (
    "flood_by_region", "monthly_mean", "price_pivot", "price_change", "high_conflict",
    "master_join", "ipc_rule", "features", "streak", "group_profile", "distribution", "kpis",
    "entity_profile", "histogram", "latest_snapshot", "alert_feed", "bulletin_lines",
    "scenario_score", "scenario_status", "panel_spine", "classification_report",
    "regression_metrics", "stratified_split", "isolation_forest", "phase_model",
)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(HEADLINE)
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus),
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    qs = queries()
    # warm-up: JVM, class loading, Python workers
    qs["flood_by_region"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
