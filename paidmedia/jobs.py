"""Batch jobs for spark-submit.

    spark-submit paidmedia/jobs.py enrich RAW_CSV OUT [--format parquet|csv]
    spark-submit paidmedia/jobs.py summary ENRICHED OUT [--format parquet|csv]
    spark-submit paidmedia/jobs.py report NAME FOLDER OUT

``--shuffle-gb`` before the job's name sizes shuffle partitions for the largest shuffle.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from paidmedia.operators import enrich, performance  # noqa: E402
from paidmedia.plans import catalog  # noqa: E402
from paidmedia.session import session  # noqa: E402
from paidmedia.sources import files, schema  # noqa: E402


def run_enrich(spark: SparkSession, source: str, target: str, kind: str = "parquet") -> None:
    """Raw CSV in, 26-column table out."""
    table = enrich.enrich(files.load_csv(spark, source))
    if kind == "csv":
        files.write_csv(table, target)
    else:
        files.write_enriched(table, target)


def run_summary(spark: SparkSession, source: str, target: str, kind: str = "parquet") -> None:
    """Summary report of an enriched table, Parquet or CSV, as CSV."""
    if kind == "csv":
        table = files.load_csv(spark, source, schema.ENRICHED)
    else:
        table = files.load_enriched(spark, source)
    files.write_csv(performance.summary_report(table), target)


def run_report(spark: SparkSession, name: str, folder: str, target: str) -> None:
    """One registered query over a data folder, written as Parquet."""
    catalog.queries()[name](spark, folder).write.parquet(target)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--shuffle-gb", type=float, default=None)
    jobs = parser.add_subparsers(dest="job", required=True)
    job = jobs.add_parser("enrich")
    job.add_argument("source")
    job.add_argument("target")
    job.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    job = jobs.add_parser("summary")
    job.add_argument("source")
    job.add_argument("target")
    job.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    job = jobs.add_parser("report")
    job.add_argument("name", choices=sorted(catalog.queries()))
    job.add_argument("folder")
    job.add_argument("target")
    args = parser.parse_args(argv)

    size = None if args.shuffle_gb is None else int(args.shuffle_gb * 1024**3)
    spark = session(f"paidmedia-{args.job}", size)
    if args.job == "enrich":
        run_enrich(spark, args.source, args.target, args.format)
    elif args.job == "summary":
        run_summary(spark, args.source, args.target, args.format)
    else:
        run_report(spark, args.name, args.folder, args.target)


if __name__ == "__main__":
    main()
