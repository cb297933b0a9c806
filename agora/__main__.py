"""Command line: load raw CSV files, build the marts, run the checks, RFM.

    python -m agora load  --csv DIR --raw DIR            full refresh of the raw tables
    python -m agora run   --raw DIR [--warehouse DIR]    staging views + core/analytics marts
    python -m agora test  --raw DIR [--warehouse DIR]    declared checks on the built marts
    python -m agora rfm   --raw DIR [--as-of DATE]       RFM segment summary

``--testdata SF_DIR`` instead of ``--raw`` maps the star-schema test tables.
Without ``--warehouse`` the marts are written as catalog tables ``core.*`` and
``analytics.*``. The Spark master comes from spark-submit (or ``--master``).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from agora.plans.pipeline import Pipeline, from_testdata
from agora.session import build_session
from agora.sources import csv as csv_source


def _pipeline(spark, args) -> Pipeline:
    if args.testdata:
        return from_testdata(spark, args.testdata)
    return Pipeline(csv_source.read_loaded(spark, args.raw))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="agora", description=__doc__.splitlines()[0])
    parser.add_argument("--master", default=None)
    parser.add_argument("--driver-memory", default=None,
                        help="heap of a JVM started from here (local runs), e.g. 16g")
    sub = parser.add_subparsers(dest="command", required=True)
    load = sub.add_parser("load", help="CSV files -> raw tables (overwrite)")
    load.add_argument("--csv", required=True)
    load.add_argument("--raw", required=True)
    helps = {"run": "staging views + core/analytics marts (full refresh)",
             "test": "declared data-quality checks (report, stored failures)",
             "rfm": "RFM segment summary"}
    for name in ("run", "test", "rfm"):
        p = sub.add_parser(name, help=helps[name])
        src = p.add_mutually_exclusive_group(required=True)
        src.add_argument("--raw")
        src.add_argument("--testdata")
        if name == "run":
            p.add_argument("--warehouse", default=None)
            p.add_argument("--share", choices=("checkpoint", "persist"), default="checkpoint")
            p.add_argument("--staging-tables", action="store_true",
                           help="also write the staging models as tables of schema staging")
            p.add_argument("--check", action="store_true",
                           help="count the row-level checks while writing, then run all checks")
        if name == "test":
            p.add_argument("--store-failures", action="store_true")
            p.add_argument("--rebuild", action="store_true",
                           help="compute the marts instead of reading what run wrote")
            p.add_argument("--warehouse", default=None)
            p.add_argument("--severity", default=None)
            p.add_argument("--fail-on-error", action="store_true")
        if name == "rfm":
            p.add_argument("--as-of", default=None, help="YYYY-MM-DD (default: latest order)")
            p.add_argument("--recency-desc", action="store_true")
    args = parser.parse_args(argv)
    extra = {"spark.driver.memory": args.driver_memory} if args.driver_memory else None
    spark = build_session(args.master, extra=extra)

    if args.command == "load":
        for result in csv_source.load_raw(spark, args.csv, args.raw):
            print(f"{result.table}: {result.rows} rows in {result.location}")
        return 0
    pipe = _pipeline(spark, args)
    if args.command == "run":
        for name, where in pipe.build(spark, args.warehouse, share=args.share,
                                      staging_tables=args.staging_tables,
                                      check=args.check).items():
            print(f"{name}: {where} ({pipe.timings.get(name, 0.0):.1f} s)")
        if args.check:
            for r in pipe.check(spark):
                if r.failures:
                    print(f"{r.status}: {r.test}({r.model}.{r.column_name}) {r.failures}")
        return 0
    if args.command == "test":
        from agora.operators import quality

        if not args.rebuild:
            pipe.use_built(spark, args.warehouse)
        results = pipe.check(spark, store_failures=args.store_failures,
                             warehouse=args.warehouse, severity=args.severity)
        for r in sorted(results, key=lambda r: (r.model, r.column_name, r.test)):
            print(f"{r.status}: {r.test}({r.model}.{r.column_name}) {r.failures}")
        print(f"checks: {len(results)}, with failures: {sum(1 for r in results if r.failures)}")
        if args.fail_on_error:
            quality.raise_on_error(results)
        return 0
    if args.command == "rfm":
        pipe.rfm_as_of = dt.datetime.fromisoformat(args.as_of) if args.as_of else None
        pipe.rfm_recency_desc = args.recency_desc
        pipe.rfm_segmentation.show(truncate=False)
        return 0
    return 1


if __name__ == "__main__":
    sys.exit(main())
