"""spark-submit entry point for the jobs.

    spark-submit -m tallyhouse ingest   --raw-dir R --warehouse W [--source S] [--reset]
    spark-submit -m tallyhouse pipeline --raw-dir R --warehouse W --bank-seed B --run-date D
    spark-submit -m tallyhouse backfill --raw-dir R --warehouse W --bank-seed B --start D --end D
    spark-submit -m tallyhouse sql      --warehouse W "SELECT * FROM fct_revenue_reconciliation"

(or ``python -m tallyhouse ...`` for a local session).  Only counts, check
verdicts and SQL results of a ``show`` reach the driver.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys


def _date(s: str) -> dt.date:
    return dt.datetime.strptime(s, "%Y-%m-%d").date()


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tallyhouse")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("ingest", "pipeline", "backfill", "sql"):
        c = sub.add_parser(name)
        c.add_argument("--warehouse", required=True)
        if name != "sql":
            c.add_argument("--raw-dir", required=True)
        if name in ("pipeline", "backfill"):
            c.add_argument("--bank-seed", required=True)
            c.add_argument("--categories", default="",
                           help="comma-separated accepted product categories")
            c.add_argument("--skip-checks", action="store_true")
            c.add_argument("--skip-build", action="store_true")
            c.add_argument("--supersede-by-path", action="store_true",
                           help="a re-sent file replaces the older version of the same path")
    sub.choices["ingest"].add_argument("--source", default="all",
                                       choices=["all", "shopify", "amazon", "pos", "product"])
    sub.choices["ingest"].add_argument("--reset", action="store_true")
    sub.choices["pipeline"].add_argument("--run-date", type=_date, required=True)
    sub.choices["backfill"].add_argument("--start", type=_date, required=True)
    sub.choices["backfill"].add_argument("--end", type=_date, required=True)
    sub.choices["sql"].add_argument("query")
    sub.choices["sql"].add_argument("--published-only", action="store_true")
    args = p.parse_args(argv)

    from tallyhouse.operators.checks import DEFAULT_CATEGORIES
    from tallyhouse.plans import jobs
    from tallyhouse.session import build_session
    from tallyhouse.sources import manifest as mf
    from tallyhouse.sources.files import read_bank_seed

    spark = build_session()
    wh = mf.Warehouse(args.warehouse)
    if args.cmd == "ingest":
        out = mf.ingest(spark, wh, args.raw_dir, args.source, args.reset)
    elif args.cmd == "sql":
        jobs.register_views(spark, wh, args.published_only)
        spark.sql(args.query).show(truncate=False)
        return 0
    else:
        bank = read_bank_seed(spark, args.bank_seed)
        cats = tuple(c for c in args.categories.split(",") if c) or DEFAULT_CATEGORIES
        kw = dict(skip_checks=args.skip_checks, skip_build=args.skip_build, categories=cats,
                  supersede_by_path=args.supersede_by_path)
        if args.cmd == "pipeline":
            out = jobs.run_pipeline(spark, args.raw_dir, wh, args.run_date, bank, **kw)
        else:
            out = jobs.backfill(spark, args.raw_dir, wh, args.start, args.end, bank, **kw)
    print(json.dumps(out, default=str, indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
