"""Command line: the fraud reports, the table ingest, the event stream.

    spark-submit -m tallywright.cli fraud --input <parquet folder>
"""

from __future__ import annotations

import argparse

from tallywright.operators import bronze
from tallywright.operators.reports import show
from tallywright.operators.rules import FraudRules
from tallywright.plans.fraud import fraud_reports, print_reports
from tallywright.plans.ingest import ingest_report, ingest_transactions
from tallywright.schemas import CARD_FEED
from tallywright.session import (
    CatalogConfig,
    SessionConfig,
    fit_shuffle_partitions,
    fresh_folder,
    scratch,
)
from tallywright.sources import id_range, make_transactions, transactions_from_events
from tallywright.sources.tables import read_card_transactions
from tallywright.streaming import event_stream, run_windows, window_counts
from tallywright.streaming.jobs import MAX_FILES_PER_BATCH


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tallywright")
    top.add_argument("--master")
    top.add_argument("--shuffle-partitions", type=int, help="by default from the size of the input")
    jobs = top.add_subparsers(dest="job", required=True)

    fraud = jobs.add_parser("fraud", help="flag card transactions and print the reports")
    fraud.add_argument("--input", required=True)
    fraud.add_argument("--format", choices=["parquet", "csv", "json"], default="parquet")
    fraud.add_argument("--risky-category", default=FraudRules.risky_category)

    ingest = jobs.add_parser("ingest", help="write transactions to a table")
    ingest.add_argument("--input", help="Parquet events to ingest; generated ids without it")
    ingest.add_argument("--table", required=True)
    ingest.add_argument("--rows", type=int, default=100_000)
    ingest.add_argument("--partitions", type=int, default=16)
    ingest.add_argument("--draws", choices=["hash", "rand"], default="rand")
    ingest.add_argument("--batch-id")
    ingest.add_argument("--location", help="folder of a session-catalog table")

    stream = jobs.add_parser("stream", help="hourly counts of an event table, as a stream")
    stream.add_argument("--folder", required=True)
    stream.add_argument("--table", default="events")
    stream.add_argument("--watermark", default="1 day")
    stream.add_argument("--max-files", type=int, default=MAX_FILES_PER_BATCH)
    return top


def run_fraud(spark, args) -> None:
    if args.format == "parquet":
        raw = read_card_transactions(spark, args.input)
    else:
        raw = spark.read.schema(CARD_FEED).format(args.format).load(args.input)
    reports = fraud_reports(raw, FraudRules(risky_category=args.risky_category))
    print_reports(reports)
    reports.close()


def run_ingest(spark, args) -> None:
    if args.input:
        rows, needed = transactions_from_events(spark.read.parquet(args.input), args.batch_id), None
    else:
        ids = id_range(spark, args.rows, args.partitions)
        rows, needed = make_transactions(ids, args.batch_id, draws=args.draws), args.rows
    external = bronze.is_v2(spark, args.table)
    location = None if external else args.location or fresh_folder(spark, "bronze")
    table = ingest_transactions(
        rows, args.table, needed, "iceberg" if external else "parquet", location
    )
    show(ingest_report(table), "Records per merchant category", truncate=False)


def run_stream(spark, args) -> None:
    schema = spark.read.parquet(f"{args.folder}/{args.table}.parquet").schema
    stream = event_stream(spark, args.folder, args.table, schema, "ts", args.max_files)
    counted = window_counts(stream, "ts", ["event_type"], "value", watermark=args.watermark)
    show(run_windows(counted, ["event_type"]).orderBy("window_start", "event_type"), "Windows")


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SessionConfig(
        app_name=f"tallywright-{args.job}",
        master=args.master,
        shuffle_partitions=args.shuffle_partitions or 200,
        catalog=CatalogConfig.from_env(),
    ).build()
    inputs = [args.folder] if args.job == "stream" else [args.input] if args.input else []
    if inputs and not args.shuffle_partitions:
        fit_shuffle_partitions(spark, *inputs)
    if args.job == "ingest":
        run_ingest(spark, args)  # its table may lie in the shared folder, and stays
        return
    with scratch(spark):
        {"fraud": run_fraud, "stream": run_stream}[args.job](spark, args)


if __name__ == "__main__":
    main()
