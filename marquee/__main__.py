"""Command line: ``python -m marquee run --raw PATH --out PATH [--fresh]``.

Runs the end-to-end job (landed documents -> quarantine -> published clean
table -> reports and chart data) with the session that ``spark-submit`` (or
the environment) configures, and prints the run status as JSON.  Without
``--fresh`` the published clean table is reused while the landed files are
the same.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="marquee")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run_p = sub.add_parser("run", help="ingest, clean, publish and report")
    run_p.add_argument("--raw", required=True, help="landed documents (JSON lines or arrays)")
    run_p.add_argument("--out", required=True, help="output root (clean/, analysis/, quarantine/)")
    run_p.add_argument("--fresh", action="store_true", help="rebuild even if a clean table exists")
    run_p.add_argument("--multi-line", action="store_true", help="documents are JSON arrays")
    run_p.add_argument("--report-parallelism", type=int, default=4)
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession
    from marquee.plans.jobs import run

    spark = SparkSession.builder.appName("marquee").getOrCreate()
    result = run(spark, args.raw, args.out, fresh=args.fresh, multi_line=args.multi_line,
                 report_parallelism=args.report_parallelism)
    print(json.dumps({"quarantined": result["quarantined"],
                      "reports": [dict(zip(("report", "status", "rows", "error"), r))
                                  for r in result["reports"]]}))
    return 0 if all(r[1] == "ok" for r in result["reports"]) else 2


if __name__ == "__main__":
    sys.exit(main())
