"""Command line: ``python -m sitelens build --organizations P --traffic P --out DIR``."""

from __future__ import annotations

import argparse

from sitelens.plans.pipeline import run_pipeline
from sitelens.session import get_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="sitelens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="load traffic incrementally, rebuild tables and marts, run checks")
    b.add_argument("--organizations", required=True, help="company directory table name or path")
    b.add_argument("--traffic", required=True, help="monthly traffic table name or path")
    b.add_argument("--out", required=True, help="output folder on shared storage")
    b.add_argument("--no-checks", action="store_true")
    b.add_argument("--fail-on-error", action="store_true")
    b.add_argument("--input-gb", type=float, default=None, help="traffic input size, to size shuffles")
    b.add_argument("--full-refresh", action="store_true", help="reload all months instead of those after the high-water mark")
    b.add_argument("--lookback-months", type=int, default=0, help="reprocess this many loaded months")
    b.add_argument("--strict", action="store_true", help="an empty traffic table loads nothing")
    args = ap.parse_args(argv)
    spark = get_session()
    res = run_pipeline(spark, args.organizations, args.traffic, args.out,
                       run_checks=not args.no_checks, fail_on_error=args.fail_on_error,
                       input_bytes=int(args.input_gb * 2**30) if args.input_gb else None, strict=args.strict,
                       lookback_months=args.lookback_months, full_refresh=args.full_refresh)
    if res is not None:
        res.filter("failures > 0").show(300, truncate=False)


if __name__ == "__main__":
    main()
