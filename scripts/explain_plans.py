"""Summarise the final (post-AQE) physical plans of the headline queries.

Usage: python scripts/explain_plans.py [sf_dir] > docs/PLANS.md
Each query is executed (noop sink) so AQE's final plan is shown; the summary
counts exchanges and join strategies and lists every Parquet scan with its
pushed filters and read schema.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from harvestwatch.queries import queries  # noqa: E402
from harvestwatch.session import get_spark  # noqa: E402

HEADLINE = ("flood_by_region", "price_pivot", "high_conflict", "master_join", "features", "alert_feed",
            "bulletin_lines", "entity_profile", "histogram", "stratified_split", "isolation_forest")
OPS = ("Exchange hashpartitioning", "Exchange SinglePartition", "Exchange rangepartitioning",
       "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "Window",
       "HashAggregate", "ObjectHashAggregate", "Subquery", "ReusedExchange", "AQEShuffleRead",
       "ArrowEvalPython", "FlatMapGroupsInArrow", "TakeOrderedAndProject", "CartesianProduct",
       "BroadcastNestedLoopJoin")


def final_only(plan: str) -> str:
    """Drop the ``== Initial Plan ==`` subtrees AQE prints next to the final ones."""
    out, skip_at = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-|"))
        if skip_at is not None:
            if depth >= skip_at:
                continue
            skip_at = None
        if "== Initial Plan ==" in line:
            skip_at = depth
            continue
        out.append(line)
    return "\n".join(out)


def summarise(plan: str) -> tuple[dict, list]:
    plan = final_only(plan)
    counts = {op: len(re.findall(re.escape(op), plan)) for op in OPS}
    scans = []
    for line in plan.splitlines():
        if "FileScan parquet" in line:
            loc = re.search(r"Location: \w+\(\d+ paths\)\[([^\]]*)", line)
            path = loc.group(1) if loc else ""
            name = os.path.basename(path) if path.endswith(".parquet") else "stage table (checkpoint dir)"
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            schema = re.search(r"ReadSchema: (struct<[^>]*>?)", line)
            scans.append((name, pushed.group(1) if pushed else "", schema.group(1) if schema else ""))
    return counts, scans


def _features_plan(spark, sf):
    from harvestwatch.plans import standin as S
    from harvestwatch.plans.features import build_features
    from harvestwatch.plans.master import build_master
    t = S.monthly_tables(spark, sf)
    m = build_master(t["rain"], t["prices"], t["conflict"], north=S.STANDIN_NORTH, vulnerable=S.STANDIN_VULNERABLE)
    return build_features(m, north=S.STANDIN_NORTH, coastal=S.STANDIN_COASTAL)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    qs = queries()
    from harvestwatch.plans import standin as S
    from harvestwatch.plans.clean import clean_prices, clean_rainfall, monthly_events_stage_from_raw
    stages = {
        "stage: rainfall monthly (raw orders x customer)": lambda: clean_rainfall(
            S.rain_raw(spark, sf), measures=S.STANDIN_RAIN, anomaly_from="rainfall_mm"),
        "stage: prices monthly (raw lineitem x part)": lambda: clean_prices(S.prices_raw(spark, sf)),
        "stage: events monthly (raw lineitem)": lambda: monthly_events_stage_from_raw(S.events_raw(spark, sf)),
        "stage: master + features (from the monthly stage tables)": lambda: _features_plan(spark, sf),
    }
    print("# Final physical plans (post-AQE) of the headline queries\n")
    print(f"Generated by `scripts/explain_plans.py` on `{os.path.basename(sf)}`. Stage tables written by "
          "`cut_lineage` appear as Parquet scans of `hw-stages/<id>`.\n")
    items = [(k, v) for k, v in stages.items()] + [(n, (lambda n=n: qs[n](spark, sf))) for n in HEADLINE]
    for name, build in items:
        df = build()
        df.collect()
        top = df._jdf.queryExecution().executedPlan()
        plan = (top.executedPlan() if top.nodeName() == "AdaptiveSparkPlan" else top).toString()
        counts, scans = summarise(plan)
        print(f"## {name}\n")
        print("| operator | count |\n| --- | --- |")
        for op, n in counts.items():
            if n:
                print(f"| {op} | {n} |")
        print("\n| scan | pushed filters | read schema |\n| --- | --- | --- |")
        for s in scans:
            print(f"| {s[0]} | {s[1]} | `{s[2][:140]}` |")
        print()


if __name__ == "__main__":
    main()
