"""Run a registered query over a corpus folder::

    python -m pageops index_links /data/corpus --show 20
    python -m pageops index_links /data/corpus --out /data/out/index_links

``--out`` writes parquet (A10/B5 sink); ``--show`` prints rows (the original
loop printed each (title, link) pair).  Without either, the row count is
printed.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    from .plans.catalog import QUERIES
    from .plans.streams import STREAM_QUERIES

    queries = {**QUERIES, **STREAM_QUERIES}
    p = argparse.ArgumentParser(prog="pageops", description="Run a registered query over a corpus folder.")
    p.add_argument("query", choices=sorted(queries))
    p.add_argument("root", help="folder holding <table>.parquet files")
    p.add_argument("--out", help="write the result as parquet here")
    p.add_argument("--show", type=int, default=0, help="print this many rows")
    p.add_argument("--master", default=None, help="Spark master (default: the session's)")
    args = p.parse_args(argv)

    from pyspark.sql import SparkSession

    builder = SparkSession.builder.appName(f"pageops-{args.query}")
    if args.master:
        builder = builder.master(args.master)
    spark = builder.getOrCreate()
    df = queries[args.query](spark, args.root)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    if args.show:
        df.show(args.show, truncate=False)
    if not args.out and not args.show:
        print(df.count())
    return 0


if __name__ == "__main__":
    sys.exit(main())
