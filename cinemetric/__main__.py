"""Command line: ``python -m cinemetric <command>``.

    list                               names of the registered queries
    load RAW_DIR OUT_DIR               materialise the catalogue of RAW_DIR into OUT_DIR
    run NAME RAW_DIR [--stored DIR] [--out PATH] [--show N]
                                       run a named query over the raw or materialised
                                       catalogue; write Parquet to PATH or print N rows

On a cluster, submit with ``spark-submit -m cinemetric ...`` settings of your choice; the
shared ``spark.checkpoint.dir`` must be set there.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="cinemetric")
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("list")
    load = sub.add_parser("load")
    load.add_argument("raw_dir")
    load.add_argument("out_dir")
    run = sub.add_parser("run")
    run.add_argument("name")
    run.add_argument("raw_dir")
    run.add_argument("--stored")
    run.add_argument("--out")
    run.add_argument("--show", type=int, default=20)
    parser.add_argument("--master", default=None, help="e.g. local[8]; default: from spark-submit")
    args = parser.parse_args(argv)

    from cinemetric import registry

    if args.command == "list":
        print("\n".join(sorted(registry.all_queries())))
        return 0

    from cinemetric.session import build_session
    from cinemetric.sources.catalogue import Catalogue, StoredCatalogue, materialize

    spark = build_session(args.master)
    try:
        if args.command == "load":
            materialize(Catalogue(spark, args.raw_dir), args.out_dir)
            return 0
        queries = registry.all_queries()
        if args.name not in queries:
            print(f"unknown query {args.name!r}; see `python -m cinemetric list`", file=sys.stderr)
            return 2
        cat = StoredCatalogue(spark, args.stored, args.raw_dir) if args.stored else Catalogue(spark, args.raw_dir)
        df = queries[args.name](cat)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            df.show(args.show, truncate=False)
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
