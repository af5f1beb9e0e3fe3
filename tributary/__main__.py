"""Command line: ``python -m tributary {ingest,run,test,build}`` or with spark-submit."""

from __future__ import annotations

import argparse
import sys

from tributary import get_session
from tributary.plans.models import MODELS, build
from tributary.plans.quality import ChecksFailed, totals
from tributary.plans.run import check, run, select, stored
from tributary.sources.ingest import load_stations
from tributary.sources.tables import from_database, from_parquet


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tributary", description=__doc__)
    parser.add_argument("command", choices=("ingest", "run", "test", "build"))
    parser.add_argument("--database", default="default", help="where tables are written")
    parser.add_argument("--source-database", help="where source tables are (default: --database)")
    parser.add_argument("--source-path", help="folder with one Parquet folder per source table")
    parser.add_argument("--select", nargs="*", help="models or subsets; all if left out")
    parser.add_argument(
        "--keep", nargs="*", help="models to store besides the marts (default: all that are chosen)"
    )
    parser.add_argument(
        "--layered",
        action="store_true",
        help="store staging, intermediate and mart models in databases <database>_<layer>",
    )
    parser.add_argument(
        "--whole-files", action="store_true", help="a file is one JSON value, not one per line"
    )
    parser.add_argument(
        "--station", action="append", default=[], metavar="NAME=PATH", help="station to ingest"
    )
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    given = _arguments(argv)
    spark = get_session()
    if given.source_path:
        load = from_parquet(spark, given.source_path)
    else:
        load = from_database(spark, given.source_database or given.database)
    stations = dict(pair.split("=", 1) for pair in given.station)
    names = None if given.select is None else select(given.select)
    # A catalog cannot hold a DataFrame as a view, so what later sessions are to read is stored.
    keep = (names or list(MODELS)) if given.keep is None else given.keep
    failed = None
    try:
        if given.command == "ingest":
            landed = load_stations(spark, stations, given.database, whole_files=given.whole_files)
            outcomes = landed.collect()
        elif given.command == "run":
            build(spark, load, given.database, names, keep, layered=given.layered)
            outcomes = []
        elif given.command == "test":
            outcomes = check(load, names, stored(spark, given.database, given.layered))
        else:
            outcomes = run(
                spark, load, given.database, stations, names, keep, given.whole_files,
                layered=given.layered,
            )
    except ChecksFailed as problem:
        failed, outcomes = problem, problem.outcomes
    for outcome in outcomes:
        print(outcome)
    if any("check" in outcome for outcome in outcomes):
        print(totals(outcomes))
    if failed:
        print(f"failed checks: {failed}", file=sys.stderr)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
