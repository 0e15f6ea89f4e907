"""Jobs for ``spark-submit``: set up the catalog, run a round, print the reports.

    spark-submit sluice/jobs.py setup [--location DIR]
    spark-submit sluice/jobs.py round --source DIR --lake DIR --countries CSV --departments CSV [--mode full]
    spark-submit sluice/jobs.py report --lake DIR --countries CSV --departments CSV
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from sluice import schemas
from sluice.plans.reports import lake_reports
from sluice.plans.runs import run_all
from sluice.session import build_session
from sluice.sinks.catalog import set_up_tables
from sluice.sources.csv import read_static_csv


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="sluice")
    jobs = parser.add_subparsers(dest="job", required=True)
    jobs.add_parser("setup").add_argument("--location")
    for name in ("round", "report"):
        job = jobs.add_parser(name)
        job.add_argument("--lake", required=True)
        job.add_argument("--countries", required=True)
        job.add_argument("--departments", required=True)
    jobs.choices["round"].add_argument("--source", required=True)
    jobs.choices["round"].add_argument("--mode", choices=["incremental", "full"], default="incremental")
    jobs.choices["round"].add_argument("--buckets", type=int)
    return parser


def _lookups(spark: SparkSession, options: argparse.Namespace) -> dict[str, DataFrame]:
    return {
        "country_code": read_static_csv(spark, options.countries, schemas.COUNTRY_LOOKUP),
        "department_code": read_static_csv(spark, options.departments, schemas.DEPARTMENT_LOOKUP),
    }


def main(arguments: list[str] | None = None) -> None:
    options = _parser().parse_args(arguments)
    spark = build_session(f"sluice-{options.job}")
    if options.job == "setup":
        set_up_tables(spark, options.location)
        return
    lookups = _lookups(spark, options)
    if options.job == "round":
        snapshots = run_all(
            spark, options.source, options.lake, lookups, mode=options.mode, n_buckets=options.buckets
        )
        for feed, snapshot in snapshots.items():
            print(f"{feed}: {'nothing new' if snapshot is None else f'version {snapshot.version}'}")
        return
    for name, frame in lake_reports(spark, options.lake, lookups["country_code"], lookups["department_code"]).items():
        print(name)
        frame.show(50, truncate=False)


if __name__ == "__main__":
    main()
