"""Run a job: `python -m pricebeam.cli <job> ...`, or this file through spark-submit.

A scheduler calls `load`, `refresh` or `end-to-end` once per run; each drains what is new.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from pricebeam.plans import jobs
from pricebeam.sources.tables import Layers, create_layers, remove_old_versions
from pricebeam.streaming.refresh import load_raw_data, update_daily_index_metrics


def parser() -> argparse.ArgumentParser:
    made = argparse.ArgumentParser(prog="pricebeam")
    made.add_argument("job", choices=[
        "create", "ingest", "load", "refresh", "harmonize", "analytics", "end-to-end", "clean"])
    made.add_argument("--prefix", default="", help="environment prefix of the databases")
    made.add_argument("--root", help="storage root of the databases")
    made.add_argument("--log", nargs="*", default=[], metavar="TABLE", help="tables whose changes are logged")
    made.add_argument("--series", help="directory with one series_id=<id> directory per series")
    made.add_argument("--landing", help="directory of landed CSV files")
    made.add_argument("--checkpoint", help="directory for the checkpoints of load and refresh")
    made.add_argument("--start", type=dt.date.fromisoformat, default=dt.date(2020, 1, 1))
    made.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    made.add_argument("--keep-days", type=int, default=7, help="days that clean keeps versions out of use")
    made.add_argument("--strict-reference", action="store_true", help="fixed lookbacks on refresh")
    return made


def run(spark: SparkSession, args: argparse.Namespace) -> jobs.JobResult:
    layers = Layers(args.prefix, args.root, tuple(args.log))
    as_of = args.as_of or dt.date.today()
    if args.job == "ingest":
        return jobs.ingest(spark, args.series, args.landing, args.start, as_of)
    if args.job == "end-to-end":
        return jobs.end_to_end(spark, layers, args.series, args.landing, f"{args.checkpoint}/load",
                               args.start, as_of)
    create_layers(spark, layers)
    if args.job == "load":
        return load_raw_data(spark, layers, f"{args.landing}/*", f"{args.checkpoint}/load")
    if args.job == "refresh":
        return update_daily_index_metrics(spark, layers, f"{args.checkpoint}/refresh", as_of,
                                          args.strict_reference)
    if args.job == "harmonize":
        return jobs.run_harmonization(spark, layers)
    if args.job == "analytics":
        return jobs.run_analytics(spark, layers)
    if args.job == "clean":
        gone = remove_old_versions(spark, layers, dt.datetime.now(dt.timezone.utc), dt.timedelta(days=args.keep_days))
        return jobs.JobResult("cleaned", {"versions": len(gone)})
    return jobs.JobResult("created")


def main() -> None:
    args = parser().parse_args()
    spark = SparkSession.builder.appName(f"pricebeam {args.job}").getOrCreate()
    result = run(spark, args)
    print(result.status, dict(result.rows))


if __name__ == "__main__":
    main()
