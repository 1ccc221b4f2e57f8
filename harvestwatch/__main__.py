"""Command line: ``python -m harvestwatch run ...`` / ``python -m harvestwatch score ...``.

run    raw CSV / landed JSON pages -> stage tables, models, feeds and reports
score  a feature table + saved models -> predictions, feeds and reports
"""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="harvestwatch")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="full batch pipeline")
    r.add_argument("--rainfall", required=True)
    r.add_argument("--prices", required=True)
    ev = r.add_mutually_exclusive_group(required=True)
    ev.add_argument("--events", help="events CSV")
    ev.add_argument("--events-pages", help="folder of landed JSON pages")
    r.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    r.add_argument("--no-models", action="store_true", help="rule-based scores instead of fitted models")
    s = sub.add_parser("score", help="score a feature table with saved models")
    s.add_argument("--features", required=True, help="Parquet feature table")
    s.add_argument("--models", required=True, help="folder written by run (out/models)")
    s.add_argument("--out", required=True)
    for p in (r, s):
        p.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    a = ap.parse_args(argv)

    from .plans import pipeline as P
    from .plans import reports as R
    from .session import get_spark
    from .sources import write_feed, write_lines, write_stage
    spark = get_spark(a.master)
    if a.cmd == "run":
        paths = {"rainfall": a.rainfall, "prices": a.prices}
        paths["events_pages" if a.events_pages else "events"] = a.events_pages or a.events
        st = P.run(spark, paths, a.out, models=not a.no_models)
        print({k: v.count() for k, v in st.items()})
    else:
        pred = write_stage(P.score_saved(spark.read.parquet(a.features), a.models), f"{a.out}/predictions")
        write_feed(R.alert_snapshot(pred), f"{a.out}/alerts_latest", R.snapshot_order())
        write_feed(R.alert_feed(pred), f"{a.out}/alerts_feed", R.feed_order())
        write_lines(R.bulletin_document(pred), f"{a.out}/bulletin", R.document_order())
        print({"predictions": pred.count()})
    return 0


if __name__ == "__main__":
    sys.exit(main())
