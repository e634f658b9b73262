"""Command line for the history jobs: ``python -m pulseboard <job> [options]``.

Sources come from catalog tables (``--tables name=table,...``; unnamed ones
default to their canonical names) or, for trials, from the fixture folder
(``--fixtures DIR``). Per-deployment rule rows come from ``--rules FILE``
(JSON object with the fields of ``pulseboard.config.Rules``).
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .config import Rules, fixture_rules
from .functions.dates import as_date
from .plans import history as HS
from .plans.touch_state import TouchState


def _rules(path: str | None, fixtures: bool) -> Rules:
    if not path:
        return fixture_rules() if fixtures else Rules()
    with open(path) as fh:
        raw = json.load(fh)
    return Rules(**{k: (tuple(tuple(x) if isinstance(x, list) else x for x in v) if isinstance(v, list) else v)
                    for k, v in raw.items()})


def _sources(spark, args):
    if args.fixtures:
        from .sources.materialize import fixture_sources

        return fixture_sources(spark, args.fixtures)
    from .sources import load_table_sources

    names = dict(kv.split("=", 1) for kv in args.tables.split(",")) if args.tables else {}
    return load_table_sources(spark, names)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="pulseboard")
    p.add_argument("job", choices=["refresh", "backfill", "enrich", "recompute-scores", "recompute-renewals",
                                   "backfill-daily", "coverage-report", "hub-top", "export-hub", "vacuum"])
    p.add_argument("--snapshots", required=True, help="snapshot table folder (partitioned by snapshot_date)")
    p.add_argument("--hub", help="hub folder (partitioned by anchor)")
    p.add_argument("--touches", help="folder of touch counts kept between runs (partitioned by day)")
    p.add_argument("--settled-days", type=int, help="stored touch days further back are not compared with the sources again")
    p.add_argument("--anchor", help="as-of date for refresh / hub-top")
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--out", help="output folder for export-hub and coverage-report")
    p.add_argument("--tables", default="")
    p.add_argument("--fixtures")
    p.add_argument("--rules")
    p.add_argument("--master")
    args = p.parse_args(argv)

    # the session as it is: its settings, and the shared folder, are the cluster's own
    builder = SparkSession.builder.appName("pulseboard")
    spark = (builder.master(args.master) if args.master else builder).getOrCreate()
    path = args.snapshots
    touches = TouchState(spark, args.touches, args.settled_days) if args.touches else None
    if args.job == "vacuum":
        tables = [HS.snapshot_table(spark, path), *([HS.hub_table(spark, args.hub)] if args.hub else []),
                  *([touches.table] if touches else [])]
        print(sum(t.vacuum() for t in tables), "files of lost writers deleted")
        return
    rules = _rules(args.rules, bool(args.fixtures))
    src = _sources(spark, args)
    if args.job == "refresh":
        HS.refresh(spark, src, rules, as_date(args.anchor), args.hub, path, touches)
    elif args.job == "backfill":
        HS.backfill_snapshots(spark, src, rules, args.start, args.end, path, touches)
    elif args.job == "enrich":
        print(HS.enrich_counts(spark, src, rules, args.start, args.end, path, touches), "rows enriched")
    elif args.job == "recompute-scores":
        print(HS.recompute_scores(spark, src, rules, args.start, args.end, path, touches), "rows recomputed")
    elif args.job == "recompute-renewals":
        print(HS.recompute_renewals(spark, src, rules, args.start, args.end, path, touches), "rows recomputed")
    elif args.job == "backfill-daily":
        print(HS.backfill_daily(spark, src, rules, path, touches), "rows filled")
    elif args.job == "coverage-report":
        report = HS.stored_coverage_report(spark, path)
        if args.out:
            report.write.mode("overwrite").option("header", "true").csv(args.out)
        else:  # every date, fetched part by part
            for r in report.toLocalIterator():
                print(r["snapshot_date"], r["reps"], r["avg_ars_per_day"])
    elif args.job == "hub-top":
        from .plans.hub import hub_top

        hub_top(HS.latest_hub(spark, args.hub, as_date(args.anchor)), 10).show(truncate=False)
    elif args.job == "export-hub":
        HS.export_hub_json(HS.latest_hub(spark, args.hub, as_date(args.anchor)), args.out)


if __name__ == "__main__":
    main()
