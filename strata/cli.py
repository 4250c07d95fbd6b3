"""Command line: ``python -m strata.cli run|test --root <warehouse root>``.

``run`` builds bronze, merges silver and rebuilds gold from the landing
tables under ``<root>/landing_zone`` and prints the failing checks; ``test``
only runs the checks (bronze, gold and singular tests) on the stored tables.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="strata")
    ap.add_argument("command", choices=["run", "test"])
    ap.add_argument("--root", required=True, help="warehouse root folder / URI")
    ap.add_argument("--parks", default='[[1, "SF", "Park SF"], [2, "AQ", "Park AQ"]]',
                    help="JSON list of [park_key, park_code, park_name]")
    ap.add_argument("--calendar", default="2025-01-01,2026-12-31")
    ap.add_argument("--as-of", default=None)
    args = ap.parse_args(argv)

    from .plans.layers import check_layers, run_layers, stored_layers
    from .session import get_session

    spark = get_session()
    parks = [tuple(p) for p in json.loads(args.parks)]
    start, end = args.calendar.split(",")
    if args.command == "run":
        report = run_layers(spark, args.root, parks, as_of=args.as_of, calendar=(start, end),
                            park_prefixes=[p[1].lower() for p in parks])
    else:
        report = check_layers(*stored_layers(spark, args.root), parks, (start, end))
    bad = report.filter("status != 'PASS'").collect()
    for r in bad:
        print(f"{r.status:5s} {r.model:28s} {r.test:50s} {r.failures}")
    return 1 if any(r.status == "FAIL" for r in bad) else 0


if __name__ == "__main__":
    sys.exit(main())
