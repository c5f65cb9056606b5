"""Jobs for ``spark-submit``: ingest batch files, build and validate, profile a file.

    python -m stayledger ingest <batch folder> <history folder> [--force]
    python -m stayledger build <history folder> <warehouse folder>
    python -m stayledger profile <csv file or folder> [--output <folder>]

Session settings come from ``spark-submit`` or ``spark-defaults``; what they leave open is
set from the size of the input.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.operators.profile import column_profile, price_spread, revenue_profile
from stayledger.operators.quality import ERROR, check_suite, run_validation
from stayledger.plans.warehouse import build_warehouse, store_warehouse
from stayledger.session import apply_conf, cluster_conf, scratch
from stayledger.sources.batches import BATCH_GLOB
from stayledger.sources.history import ingest, read_history


def _size_settings(spark: SparkSession, folder: str, pattern: str) -> None:
    """Settings for the bytes of the input, from its listing."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    size = files.load(folder).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    apply_conf(spark, cluster_conf(size))


def _print(report: DataFrame) -> None:
    """A report has a row per check or column, so it is printed whole."""
    print(" | ".join(report.columns))
    for row in report.collect():
        print(" | ".join(str(value) for value in row))


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> int:
    _size_settings(spark, args.batches, args.pattern)
    rows = ingest(spark, args.batches, args.history, force=args.force, pattern=args.pattern)
    print(f"appended {rows:,} rows")
    return 0


def run_build(spark: SparkSession, args: argparse.Namespace) -> int:
    """Build all relations and keep them; the exit code tells whether an error check failed.

    Results and both reports go to the warehouse folder; intermediate tables are removed.
    """
    _size_settings(spark, args.history, "*.parquet")
    reports = {}
    with scratch(spark):
        relations = build_warehouse(read_history(spark, args.history), args.warehouse)
        store_warehouse(relations, args.warehouse)
        for name, report in (("check_suite", check_suite(relations)), ("run_validation", run_validation(relations))):
            where = f"{args.warehouse.rstrip('/')}/{name}"
            report.write.mode("overwrite").parquet(where)
            reports[name] = spark.read.parquet(where)
    failures = reports["check_suite"].where(F.col("failures") > 0)
    _print(failures)
    _print(reports["run_validation"])
    bad = failures.where(F.col("severity") == ERROR).count()
    return 1 if bad + reports["run_validation"].where(F.col("passed") == 0).count() else 0


def run_profile(spark: SparkSession, args: argparse.Namespace) -> int:
    _size_settings(spark, args.csv, "*")
    source = spark.read.option("header", True).option("escape", '"').csv(args.csv)
    for make in (column_profile, price_spread, revenue_profile):
        report = make(source)
        if args.output:
            where = f"{args.output.rstrip('/')}/{make.__name__}"
            report.write.mode("overwrite").parquet(where)
            report = spark.read.parquet(where)
        _print(report)
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="stayledger", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)
    job = jobs.add_parser("ingest")
    job.add_argument("batches")
    job.add_argument("history")
    job.add_argument("--force", action="store_true", help="load files that are already there again")
    job.add_argument("--pattern", default=BATCH_GLOB)
    job.set_defaults(run=run_ingest)
    job = jobs.add_parser("build")
    job.add_argument("history")
    job.add_argument("warehouse")
    job.set_defaults(run=run_build)
    job = jobs.add_parser("profile")
    job.add_argument("csv")
    job.add_argument("--output")
    job.set_defaults(run=run_profile)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"stayledger-{args.job}").getOrCreate()
    return args.run(spark, args)


if __name__ == "__main__":
    raise SystemExit(main())
