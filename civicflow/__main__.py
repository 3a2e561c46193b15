"""Command line: run the whole batch flow.

    python -m civicflow --events /root/testdata/sf0.01 --out /path/to/output
    python -m civicflow --jsonl /path/to/raw.jsonl [--strict] --out /path/to/output

On a cluster submit it with spark-submit; the session comes from the cluster's settings
(``--local N`` builds a local session instead).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from civicflow.fixtures import raw_requests
from civicflow.plans.batch import run_batch
from civicflow.session import local_session
from civicflow.sources.jsonl import read_jsonl, read_jsonl_strict


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="civicflow", description=__doc__.split("\n\n")[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--events", help="folder holding events.parquet (the raw feed is derived from it)")
    src.add_argument("--jsonl", help="raw JSON-lines file or folder")
    ap.add_argument("--strict", action="store_true", help="JSON types and absent-vs-null as the record model")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--slice", nargs=2, default=(None, None), metavar=("BOROUGH", "TYPE"))
    ap.add_argument("--local", type=int, default=0, help="run on local[N] instead of the cluster session")
    args = ap.parse_args(argv)

    spark = local_session(args.local) if args.local else SparkSession.builder.getOrCreate()
    if args.events:
        raw = raw_requests(spark, args.events)
    else:
        raw = read_jsonl_strict(spark, args.jsonl) if args.strict else read_jsonl(spark, args.jsonl)
    reports = run_batch(spark, raw, args.out, *args.slice)
    for title, df in [
        ("raw feed: rows, columns, schema", reports.raw_shape),
        ("raw profile: columns by null count", reports.raw_profile),
        ("quarantine by reason", reports.quarantine_by_type),
        ("clean health check", reports.health),
        ("published answers", reports.summary),
        ("layout scan report", reports.scan_report),
    ]:
        print(f"\n== {title}")
        df.show(50, truncate=False)


if __name__ == "__main__":
    main()
