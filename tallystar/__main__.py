"""Sales files to a star schema and reports.

Jobs: create the empty star, run the etl on a file or folder, ingest the new
files of a folder, reload the newest snapshot, report on the star, check its keys.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallystar.operators.checks import integrity
from tallystar.plans.analysis import first_rows, kept_marts, write_reports, year_report
from tallystar.plans.etl import reload_latest, run_etl
from tallystar.session import build_session, shuffle_partitions
from tallystar.sinks.star_tables import ensure_star
from tallystar.sources.snapshots import list_files
from tallystar.sources.star_tables import read_date_dim, read_fact, read_product_dim
from tallystar.streaming.ingest import ingest_new_files


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tallystar", description=__doc__)
    parser.add_argument("--master", help="only where spark-submit does not name one")
    jobs = parser.add_subparsers(dest="job", required=True)
    places = {
        "create": ["mart"],
        "etl": ["input", "lake", "mart"],
        "ingest": ["input", "lake", "mart"],
        "reload": ["lake", "mart"],
        "report": ["mart"],
        "check": ["mart"],
    }
    for job, names in places.items():
        sub = jobs.add_parser(job)
        for name in names:
            sub.add_argument(f"--{name}", required=True)
        if "input" in names:
            sub.add_argument("--date-format", action="append", default=[], dest="formats")
            sub.add_argument("--glob", help="only files whose names match the pattern")
        if job == "etl":
            sub.add_argument("--format", choices=["parquet", "csv"], default="parquet")
        if job == "ingest":
            sub.add_argument("--max-files", type=int, default=1000)
        if job == "report":
            sub.add_argument("--output", help="folder for the reports as tables")
            sub.add_argument("--year", type=int, help="only a year's sales by month and product")
    return parser


def _size_shuffles(spark: SparkSession, path: str) -> None:
    """Enough shuffle partitions for the input; adaptive execution merges small ones."""
    size = list_files(spark, path).agg(F.sum("length")).first()[0] or 0
    wanted = shuffle_partitions(size, spark.sparkContext.defaultParallelism)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", wanted)


def _report(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.year is not None:
        report = year_report(spark, args.mart, args.year)
        if args.output:
            report.write.mode("overwrite").parquet(f"{args.output}/year={args.year}")
        else:
            report.orderBy("month", "product_key").show(1000, truncate=False)
        return
    found = kept_marts(spark, args.mart)
    print(f"sales_fact: {read_fact(spark, args.mart).count()} rows")
    first_rows(spark, args.mart).show(truncate=False)
    if args.output:
        write_reports(found, args.output)
        return
    for name, report in found.items():
        print(name)
        report.show(truncate=False)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session("tallystar", args.master)
    if args.job == "create":
        ensure_star(spark, args.mart)
    elif args.job == "etl":
        _size_shuffles(spark, args.input)
        print(
            run_etl(
                spark, args.input, args.lake, args.mart, args.formats, args.format, args.glob
            )
        )
    elif args.job == "ingest":
        _size_shuffles(spark, args.input)
        ingest_new_files(
            spark,
            args.input,
            args.lake,
            args.mart,
            max_files=args.max_files,
            glob=args.glob,
            extra_formats=args.formats,
        )
    elif args.job == "reload":
        _size_shuffles(spark, args.lake)
        print(reload_latest(spark, args.lake, args.mart))
    elif args.job == "check":
        _size_shuffles(spark, args.mart)
        star = [read(spark, args.mart) for read in (read_fact, read_date_dim, read_product_dim)]
        integrity(*star).show(truncate=False)
    else:
        _size_shuffles(spark, args.mart)
        _report(spark, args)


if __name__ == "__main__":
    main()
