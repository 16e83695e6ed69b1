"""Command line: list the queries, explain one, or write its result as Parquet.

    python -m lexgrain list
    python -m lexgrain explain NAME DATA_DIR
    python -m lexgrain run NAME DATA_DIR OUT_DIR
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lexgrain")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list")
    e = sub.add_parser("explain")
    r = sub.add_parser("run")
    for x in (e, r):
        x.add_argument("name")
        x.add_argument("data_dir")
    r.add_argument("out_dir")
    a = p.parse_args(argv)

    from lexgrain.plans import catalog

    found = catalog.all_queries()
    if a.command == "list":
        print("\n".join(sorted(found)))
        return 0
    if a.name not in found:
        print(f"no query {a.name!r}", file=sys.stderr)
        return 2
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName(f"lexgrain {a.name}").getOrCreate()
    df = found[a.name][0](spark, a.data_dir)
    if a.command == "explain":
        df.explain("formatted")
    else:
        df.write.mode("errorifexists").parquet(a.out_dir)
    return 0


if __name__ == "__main__":
    sys.exit(main())
