"""python -m tidemill.cli query NAME SF_DIR | queries | data | train | backtest, over vendor folders."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path


def session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()


def feeds(spark, raw: str):
    """Units of the archives in a folder, as data frames of strings."""
    from tidemill.operators.parse import raw_units
    from tidemill.sources.csv7z import Csv7zDataSource

    spark.dataSource.register(Csv7zDataSource)
    out = {}
    for f in sorted(Path(raw).glob("*.7z")):
        df = spark.read.format("csv7z").load(str(f))
        for unit in raw_units(str(f)):
            key = tuple(unit.split("_"))
            out[key] = out[key].unionByName(df) if key in out else df
    return out


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemill", description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("queries")
    for command, names in {"query": ["name", "sf_dir"], "data": ["raw", "out"], "train": ["out", "folder"], "backtest": ["out", "model"]}.items():
        p = sub.add_parser(command)
        for n in names:
            p.add_argument(n)
    args = parser.parse_args(argv)
    from tidemill.plans import workflows as w
    from tidemill.plans.queries import QUERIES

    if args.command == "queries":
        print("\n".join(sorted(QUERIES)))
    elif args.command == "query":
        if args.name not in QUERIES:
            print(f"no such query: {args.name}", file=sys.stderr)
            return 2
        QUERIES[args.name](session(), args.sf_dir).show(20, truncate=False)
    elif args.command == "data":
        spark = session()
        print(w.run_data(feeds(spark, args.raw), args.out))
    elif args.command == "train":
        w.run_training(session(), args.out, args.folder)[1].orderBy("eval_day").show(100)
    else:
        from tidemill.operators.models import resolve_artifact

        w.run_backtest(session(), args.out, resolve_artifact(args.model))["report"].show(100)
    return 0


if __name__ == "__main__":
    sys.exit(main())
