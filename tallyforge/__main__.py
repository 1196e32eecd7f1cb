"""Command line: run the gated build or any registered query.

    python -m tallyforge list
    python -m tallyforge query aum_by_segment --sf-dir /root/testdata/sf0.01
    python -m tallyforge build --sf-dir /root/testdata/sf0.01 --sink /shared/warehouse

``--master`` defaults to the cluster the session is submitted to (``local[*]``
when run directly). Stored intermediates go to ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tallyforge")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="names of the registered queries")
    q = sub.add_parser("query", help="run one registered query and print its rows")
    q.add_argument("name")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--rows", type=int, default=20)
    b = sub.add_parser("build", help="gated build of all models; gold tables go to --sink")
    b.add_argument("--sf-dir", required=True)
    b.add_argument("--sink", default=None)
    b.add_argument("--format", default="parquet")
    b.add_argument("--as-of", default=None)
    args = ap.parse_args(argv)

    from . import registry
    if args.cmd == "list":
        for name in registry.queries():
            print(name)
        return 0

    from .session import clean_scratch, get_spark
    spark = get_spark(args.master or ("local[*]" if "pyspark.shell" not in sys.modules else None))
    if args.cmd == "query":
        registry.queries()[args.name](spark, args.sf_dir).show(args.rows, truncate=False)
        clean_scratch(spark)
        return 0

    from .plans import build
    from .sources import adapter
    result = build.build(spark, adapter.bronze(spark, args.sf_dir), sink=args.sink, fmt=args.format,
                         as_of=args.as_of)
    build.build_report(spark, result).show(truncate=False)
    for model, test, column, failures, severity in result.tests:
        if failures:
            print(f"FAIL {model}.{test}({column}) failures={failures} [{severity}]")
    clean_scratch(spark)
    return 0 if all(s == "success" for s in result.status.values()) else 1


if __name__ == "__main__":
    sys.exit(main())
