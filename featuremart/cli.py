"""spark-submit entry point: build, publish and validate features.

    spark-submit featuremart/cli.py run --run-date 2025-06-10 --out s3a://bucket/features \\
        --source customers=s3a://raw/customers --source sessions=... --source events=... \\
        --source orders=... [--source-format parquet] [--format csv]

    spark-submit featuremart/cli.py backfill --run-date 2025-06-01 --run-date 2025-06-02 ...

Prints the manifest(s) as JSON lines. Reader options for all sources (for
example a JDBC ``url``) are passed with ``--option k=v``, those of one source
(``dbtable``, ``partitionColumn`` …) with ``--option events.dbtable=raw.events``.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from featuremart.plans.job import run_backfill, run_job, validate  # noqa: E402
from featuremart.session import get_session  # noqa: E402
from featuremart.sources.tables import SOURCE_COLUMNS  # noqa: E402


def _pairs(items: list[str]) -> dict[str, str]:
    out = {}
    for item in items or []:
        key, _, value = item.partition("=")
        out[key] = value
    return out


def _options(items: list[str]) -> dict[str, str | dict[str, str]]:
    """Common options, and under the name of a source its own."""
    out: dict[str, str | dict[str, str]] = {}
    for key, value in _pairs(items).items():
        name, dot, option = key.partition(".")
        if dot and name in SOURCE_COLUMNS:
            out.setdefault(name, {})[option] = value
        else:
            out[key] = value
    return out


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="featuremart")
    parser.add_argument("command", choices=["run", "backfill"])
    parser.add_argument("--run-date", action="append", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--source", action="append", help="name=path for customers/sessions/events/orders")
    parser.add_argument("--source-format", default="parquet")
    parser.add_argument("--option", action="append", help="reader option k=v, or source.k=v for one source")
    parser.add_argument("--format", default="csv", choices=["csv", "parquet"])
    args = parser.parse_args(argv)

    spark = get_session()
    paths, options = _pairs(args.source), _options(args.option)
    if args.command == "run":
        manifests = [
            run_job(spark, args.run_date[0], args.out, None, paths, args.source_format, options, args.format)
        ]
    else:
        manifests = run_backfill(
            spark, args.run_date, args.out, paths, args.source_format, options, args.format
        )
    for m in manifests:
        validate(spark, m)
        print(json.dumps(m))
    return 0


if __name__ == "__main__":
    sys.exit(main())
