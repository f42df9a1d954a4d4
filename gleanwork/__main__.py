"""Run one job: ``spark-submit run_job.py <job> …`` or ``python -m gleanwork <job> …``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from gleanwork import plans, sources


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="gleanwork", description="Collect and flatten records.")
    parser.add_argument("--run-date", help="yyyy-MM-dd; today if left out")
    parser.add_argument("--rejects", help="folder for what could not be used; _rejects in the target if left out")
    jobs = parser.add_subparsers(dest="job", required=True)

    def bounds(job: argparse.ArgumentParser) -> None:
        job.add_argument("--no-rejects", action="store_true", help="do not stage data to list rejects")
        job.add_argument("--max-records-per-file", type=int, default=0)
        atomic(job)

    def atomic(job: argparse.ArgumentParser) -> None:
        job.add_argument("--atomic", action="store_true", help="replace a day only when the run is complete")

    def files(job: argparse.ArgumentParser) -> None:
        bounds(job)
        job.add_argument("--lossless", action="store_true", help="keep blanks, and NULL apart from empty text")

    def grids(job: argparse.ArgumentParser) -> None:
        bounds(job)
        job.add_argument("--layout", choices=("lines", "wide", "long"), default="lines")
        job.add_argument("--width", type=int, help="columns of the wide layout")

    documents = jobs.add_parser("documents", help="files to text")
    documents.add_argument("source")
    documents.add_argument("target")
    documents.add_argument("--layout", choices=("lines", "flat"), default="lines")
    documents.add_argument("--pattern", help="only files whose names match, such as *.txt")
    files(documents)

    sheets = jobs.add_parser("sheets", help="exported online sheets to text tables")
    sheets.add_argument("source")
    sheets.add_argument("target")
    sheets.add_argument("--export", choices=("csv", "json"), default="csv")
    grids(sheets)

    workbooks = jobs.add_parser("workbooks", help="XLSX workbooks to text tables")
    workbooks.add_argument("source")
    workbooks.add_argument("target")
    grids(workbooks)

    responses = jobs.add_parser("responses", help="landed web responses to stored objects")
    responses.add_argument("source", help="Parquet: url, content_type, content_disposition, body")
    responses.add_argument("prefix")
    responses.add_argument("target")
    responses.add_argument("--no-rejects", action="store_true", help="list no responses without route or name")
    responses.add_argument("--plain-quotes", action="store_true", help="keep inner quotes of CSV text as they are")
    responses.add_argument("--nested", choices=("descendant", "own"), default="descendant")
    atomic(responses)

    requests = jobs.add_parser("requests", help="a key list to the addresses to fetch")
    requests.add_argument("keys")
    requests.add_argument("base", help="the address that all requests start with")
    requests.add_argument("target")
    requests.add_argument("--dataset", choices=("by_offense", "by_race"), default="by_offense")
    requests.add_argument("--first", type=int, default=1995, help="first year")
    requests.add_argument("--last", type=int, default=2018, help="last year")
    files(requests)

    payloads = jobs.add_parser("payloads", help="landed JSON answers to flat rows")
    payloads.add_argument("source", help="Parquet: key, status, body")
    payloads.add_argument("target")
    payloads.add_argument("--dataset", choices=("by_offense", "by_race"), default="by_offense")
    payloads.add_argument("--keys", help="key list; keys without an answer become rejects")
    payloads.add_argument("--layout", choices=("snapshot", "by_key"), default="snapshot")
    payloads.add_argument("--append", action="store_true", help="add to the day's folder")
    files(payloads)

    images = jobs.add_parser("images", help="images to the text of their metadata")
    images.add_argument("source")
    images.add_argument("target")
    files(images)
    return parser


def _chosen(args: argparse.Namespace, *names: str) -> dict:
    """The options of a job that writes text, by the names of its parameters."""
    options = {name: getattr(args, name) for name in (*names, "max_records_per_file", "atomic")}
    return options | {"keep_rejects": not args.no_rejects}


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName(f"gleanwork {args.job}").getOrCreate()
    common = {"run_date": args.run_date, "rejects_target": args.rejects}
    if args.job == "documents":
        plans.run_documents(
            spark,
            args.source,
            args.target,
            **common,
            **_chosen(args, "layout", "pattern", "lossless"),
        )
    elif args.job == "sheets":
        plans.run_sheets(
            spark,
            args.source,
            args.target,
            export=args.export,
            **common,
            **_chosen(args, "layout", "width"),
        )
    elif args.job == "workbooks":
        plans.run_workbooks(
            spark, args.source, args.target, **common, **_chosen(args, "layout", "width")
        )
    elif args.job == "responses":
        landed = spark.read.parquet(args.source)
        plans.run_landing(
            landed,
            args.prefix,
            args.target,
            escape_quotes=not args.plain_quotes,
            keep_rejects=not args.no_rejects,
            nested=args.nested,
            atomic=args.atomic,
            **common,
        )
    elif args.job == "requests":
        plans.run_requests(
            spark,
            args.keys,
            args.base,
            args.target,
            args.dataset,
            args.run_date,
            args.first,
            args.last,
            rejects_target=args.rejects,
            **_chosen(args, "lossless"),
        )
    elif args.job == "payloads":
        plans.run_payloads(
            spark.read.parquet(args.source),
            args.target,
            args.dataset,
            keys=sources.read_keys(spark, args.keys) if args.keys else None,
            layout=args.layout,
            mode="append" if args.append else "overwrite",
            **common,
            **_chosen(args, "lossless"),
        )
    else:
        plans.run_images(spark, args.source, args.target, **common, **_chosen(args, "lossless"))


if __name__ == "__main__":
    main(sys.argv[1:])
