"""Command line: ``spark-submit -m tellstar <command> ...`` or ``python -m tellstar <command> ...``.

  land    --landing ROOT --raw RAW [--buckets N]   land every run + shared inputs (K5)
          (every command takes --scratch DIR before its name: a folder that all executors
          share; needed on a cluster whose spark.checkpoint.dir is not set)
  build   --raw RAW --marts MARTS [--now ISO]      star schema + serving table + declared tests
                                                   + source freshness; exit 1 on test failures
  report  NAME --marts MARTS                       show one report (B2-B11)
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

REPORTS = ("headline", "cost_per_correct", "accuracy_matrix", "writer_matrix", "latency_split", "ground_truth",
           "pricing_reference", "token_usage", "harness_evolution", "writer_series")


def _spark(a) -> SparkSession:
    spark = SparkSession.builder.appName("tellstar").getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    if a.scratch:
        spark.sparkContext.setCheckpointDir(a.scratch)
    return spark


def cmd_land(a) -> int:
    from .operators.landing import land_all

    counts = land_all(_spark(a), a.landing, a.raw, on_missing_records=a.on_missing, buckets=a.buckets)
    print(json.dumps(counts))
    return 0


def cmd_build(a) -> int:
    from pyspark.sql import functions as F

    from .operators.landing import read_raw
    from .operators.quality import freshness
    from .plans.declared_checks import run_declared_checks
    from .plans.marts import build_star
    from .plans.reports import materialize_analysis

    spark = _spark(a)
    build_star(spark, a.raw, a.marts)
    materialize_analysis(spark, a.marts)
    results = run_declared_checks(spark, a.raw, a.marts).collect()
    failed = [r for r in results if r.failures]
    for r in results:
        print(f"{'FAIL' if r.failures else 'PASS'} {r.check} {r.relation}.{r.column} failures={r.failures}")
    now = dt.datetime.fromisoformat(a.now) if a.now else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    fresh = freshness(read_raw(spark, a.raw, "run_manifest"), "loaded_at", now, relation="raw.run_manifest").first()
    print(f"freshness raw.run_manifest: {fresh.status} (age {fresh.age_hours:.1f} h)")
    print(f"PASS={len(results) - len(failed)} FAIL={len(failed)}")
    return 1 if failed or fresh.status == "error" else 0


def cmd_report(a) -> int:
    from .plans import marts as mt
    from .plans import reports as rp

    spark = _spark(a)
    if a.name == "ground_truth":
        df = rp.report_ground_truth(mt.load_mart(spark, a.marts, "dim_question"))
    elif a.name == "pricing_reference":
        df = rp.report_pricing_reference(mt.load_mart(spark, a.marts, "dim_token_pricing"))
    else:
        df = getattr(rp, f"report_{a.name}")(rp.load_analysis(spark, a.marts))
    df.show(a.rows, truncate=False)
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tellstar")
    p.add_argument("--scratch", default=None, help="shared scratch folder (default: spark.checkpoint.dir)")
    sub = p.add_subparsers(dest="command", required=True)
    land = sub.add_parser("land")
    land.add_argument("--landing", required=True)
    land.add_argument("--raw", required=True)
    land.add_argument("--buckets", type=int, default=None)
    land.add_argument("--on-missing", choices=("raise", "skip"), default="raise")
    land.set_defaults(fn=cmd_land)
    build = sub.add_parser("build")
    build.add_argument("--raw", required=True)
    build.add_argument("--marts", required=True)
    build.add_argument("--now", default=None, help="reference time for freshness (ISO, UTC)")
    build.set_defaults(fn=cmd_build)
    report = sub.add_parser("report")
    report.add_argument("name", choices=REPORTS)
    report.add_argument("--marts", required=True)
    report.add_argument("--rows", type=int, default=50)
    report.set_defaults(fn=cmd_report)
    a = p.parse_args(argv)
    return a.fn(a)


if __name__ == "__main__":
    sys.exit(main())
