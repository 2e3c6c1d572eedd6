"""Run a report or the ingest from the command line.

    python -m planledger daily --root R --out O [--as-of 2024-01-15] [--table db.t]
    python -m planledger daily-v2 --root R --out O
    python -m planledger monthly 202401 --root R --out O [--run-ts 2024-02-03T06:00:00]
    python -m planledger ingest --url jdbc:... --offers S.OFFERS --product S.PRODUCT --out O
        [--partition-column ID --partitions 64 [--lower 1 --upper 9000000]]
        [--product-partition-column ID]

``--table`` registers in the Hive catalog, so that the table is there after the run.
``--run-ts`` repeats a run: it stamps the rows and, in a close, stands in for open ends.
A partition column lets a table be read in parallel; the database is asked for its bounds
where they aren't given. Without one the table is read by one task. ``--count-losses``
prints how many values the casts of a report lost and how many keys are null.
"""

from __future__ import annotations

import argparse
import json
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from planledger.contracts import CastLosses, normalise, normalise_keys
from planledger.plans.ingest import ingest_cycle_discounts
from planledger.plans.snapshots import (
    daily_snapshot, daily_snapshot_v2, monthly_close, reduced_lists,
)
from planledger.session import build_session, scratch
from planledger.sources.sinks import write_snapshot
from planledger.sources.tables import JOB_TABLES, read_domain, read_jdbc


def period(text: str) -> str:
    """A month as ``yyyyMM``."""
    if not (len(text) == 6 and text.isdigit() and 1 <= int(text[4:]) <= 12):
        raise argparse.ArgumentTypeError(f"{text!r} is no month of the form yyyyMM")
    return text


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--out", required=True, help="folder to overwrite")
    common.add_argument("--files", type=int, help="number of output files (default: as computed)")
    common.add_argument("--shuffle-partitions", type=int, help="bytes of the largest shuffle / 200 MB")
    report = argparse.ArgumentParser(add_help=False, parents=[common])
    report.add_argument("--root", required=True, help="folder holding the source tables")
    report.add_argument("--plan-list", help="CSV file of the pay-per-use plans")
    report.add_argument("--table", help="external table to register over the folder")
    report.add_argument("--count-losses", action="store_true", help="print what casts lost, as JSON")
    report.add_argument("--run-ts", type=datetime.fromisoformat, help="the run's time (default: now)")
    daily = argparse.ArgumentParser(add_help=False, parents=[report])
    daily.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    parser = argparse.ArgumentParser(prog="planledger")
    jobs = parser.add_subparsers(dest="job", required=True)
    jobs.add_parser("daily", parents=[daily])
    jobs.add_parser("daily-v2", parents=[daily])
    jobs.add_parser("monthly", parents=[report]).add_argument("period", type=period, help="yyyyMM")
    ingest = jobs.add_parser("ingest", parents=[common])
    ingest.add_argument("--url", required=True)
    ingest.add_argument("--offers", required=True, help="table of the discount offers")
    ingest.add_argument("--product", required=True, help="product table")
    ingest.add_argument("--property", action="append", default=[], metavar="KEY=VALUE")
    ingest.add_argument("--partition-column", help="number, date or timestamp column of the offers")
    ingest.add_argument("--lower")
    ingest.add_argument("--upper")
    ingest.add_argument("--partitions", type=int)
    ingest.add_argument("--product-partition-column", help="the same of the product table; bounds are asked for")
    args = parser.parse_args(argv)
    if args.job == "ingest":
        if (args.lower is None) != (args.upper is None) or args.lower and not args.partition_column:
            parser.error("--lower and --upper go together, with --partition-column")
        parallel = args.partition_column or args.product_partition_column
        if (parallel is None) != (args.partitions is None):
            parser.error("a partition column and --partitions go together")
        column = args.partition_column
        args.bounds = (column, args.lower, args.upper, args.partitions) if column else None
        column = args.product_partition_column
        args.product_bounds = (column, None, None, args.partitions) if column else None
    return args


def session_settings(args: argparse.Namespace) -> dict[str, str]:
    """What the run needs of its session beyond the defaults."""
    if getattr(args, "table", None):
        return {"spark.sql.catalogImplementation": "hive"}
    return {}


def lasting_catalog(spark: SparkSession) -> bool:
    """Whether tables stay registered when the session ends."""
    return spark.conf.get("spark.sql.catalogImplementation") == "hive"


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "ingest":
        props = dict(item.split("=", 1) for item in args.property)
        offers = read_jdbc(spark, args.url, args.offers, props, args.bounds)
        product = read_jdbc(spark, args.url, args.product, props, args.product_bounds).selectExpr(
            "product_key", "product_desc"
        )
        product = normalise_keys(product, ["product_key"])
        plans = ingest_cycle_discounts(normalise(offers, "discount_offers"), product)
        write_snapshot(plans, args.out, fmt="parquet", files=args.files)
        return
    losses = CastLosses() if args.count_losses else None
    tables = read_domain(
        spark, args.root, JOB_TABLES[args.job], getattr(args, "period", None), args.plan_list, losses
    )
    now = args.run_ts or datetime.now()
    with scratch(spark):
        write_report(args, reduced_lists(tables, args.job), now)
    if losses:
        print(json.dumps(losses.counts()))


def write_report(args: argparse.Namespace, tables: dict[str, DataFrame], now: datetime) -> None:
    if args.job == "daily":
        report = daily_snapshot(tables, args.as_of, now)
    elif args.job == "monthly":
        report = monthly_close(tables, args.period, now)
    else:
        report = daily_snapshot_v2(tables, args.as_of)
    write_snapshot(report, args.out, args.table, files=args.files)


if __name__ == "__main__":
    arguments = parse_args()
    session = build_session(
        f"planledger-{arguments.job}",
        shuffle_partitions=arguments.shuffle_partitions,
        **session_settings(arguments),
    )
    if getattr(arguments, "table", None) and not lasting_catalog(session):
        raise SystemExit("--table needs a session with the Hive catalog; the table would vanish with this run")
    run(session, arguments)
