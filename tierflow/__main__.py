"""Command line for a scheduler: ``python -m tierflow <job> --database ...``."""

from __future__ import annotations

import argparse
from datetime import date, datetime, timezone

from pyspark.sql import SparkSession

from . import session
from .plans import flows
from .plans.incremental import run_gold_incremental, taken
from .sources.readers import read_clicks, read_crm, read_orders
from .streaming.clicks import FLUSH_BYTES, FLUSH_INTERVAL, Progress, click_source, compact_clicks, create_click_tables, ingest_clicks
from .streaming.crm import crm_source, ingest_crm
from .streaming.orders import compact_orders, create_orders_table, ingest_orders, order_changes


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tierflow")
    parser.add_argument("--database", required=True)
    parser.add_argument("--location", help="folder of the database when it is created")
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--run-ts", type=datetime.fromisoformat, help="UTC, default now")
    jobs = parser.add_subparsers(dest="job", required=True)

    silver = jobs.add_parser("silver", help="full refresh of the three silver tables")
    for source in ("orders", "clicks", "crm"):
        silver.add_argument(f"--{source}", required=True, help=f"bronze folder of {source}")

    gold = jobs.add_parser("gold", help="profile and export")
    gold.add_argument("--as-of", type=date.fromisoformat, help="default today")
    gold.add_argument("--orders-table", default="silver_orders", help="silver_orders_live for the incremental orders")

    load = jobs.add_parser("load", help="warehouse table from the export")
    load.add_argument("--buckets", type=int, help="by the rows, when not given")

    orders = jobs.add_parser("orders", help="take in new order change files")
    orders.add_argument("--changes", required=True, help="folder the change files land in")
    orders.add_argument("--root", required=True, help="folder of the incremental table")
    orders.add_argument("--checkpoint", required=True)
    orders.add_argument("--seq", default="seq", help="column with the order of the changes")
    orders.add_argument("--op", default="op", help="column with the kind of change")

    crm = jobs.add_parser("customers", help="take in new CRM exports")
    crm.add_argument("--crm", required=True, help="folder the exports land in")
    crm.add_argument("--root", required=True, help="folder of the deliveries")
    crm.add_argument("--checkpoint", required=True)
    crm.add_argument("--allow-corrupt", action="store_true", help="set lines that do not parse aside and go on")

    gold = jobs.add_parser("gold-incremental", help="profile and export from what is new in the logs of orders and clicks")
    gold.add_argument("--root", required=True, help="folder of the state")
    gold.add_argument("--as-of", type=date.fromisoformat, help="default today")

    clicks = jobs.add_parser("clicks", help="take in new click files as a stream")
    clicks.add_argument("--clicks", required=True, help="folder the click files land in")
    clicks.add_argument("--root", required=True, help="folder of the click tables")
    clicks.add_argument("--checkpoint", required=True)
    clicks.add_argument("--interval", help=f"time between flushes, such as '{FLUSH_INTERVAL}'; without it what is there is taken in")
    clicks.add_argument("--max-bytes", type=int, default=FLUSH_BYTES, help="about how much a flush takes in")
    clicks.add_argument("--files", type=int, help="files of a flush")

    compact = jobs.add_parser("compact-clicks", help="fold the log of clicks into its base")
    compact.add_argument("--root", required=True, help="folder of the click tables")

    compact = jobs.add_parser("compact-orders", help="fold the log of order changes into its base")
    compact.add_argument("--root", required=True, help="folder of the incremental table")
    return parser.parse_args(argv)


def _taken(spark: SparkSession, lake: flows.Lake, log: str) -> list[str] | None:
    """The batches a compaction may fold: those the incremental gold has, or any where there is none."""
    return taken(spark, lake, log) if spark.catalog.tableExists(lake.name("gold_state")) else None


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    run_ts = args.run_ts or now
    spark = session.build()
    lake = flows.Lake.create(spark, args.database, args.location, args.format)
    if args.job == "silver":
        flows.run_silver(
            lake,
            read_orders(spark, args.orders),
            read_clicks(spark, args.clicks),
            read_crm(spark, args.crm),
            run_ts,
        )
    elif args.job == "gold":
        flows.run_gold(spark, lake, args.as_of or now.date(), run_ts, args.orders_table)
    elif args.job == "load":
        flows.load_warehouse(spark, lake, args.buckets)
    elif args.job == "customers":
        source = crm_source(spark, args.crm)
        ingest_crm(source, lake, args.root, args.checkpoint, run_ts, allow_corrupt=args.allow_corrupt).awaitTermination()
    elif args.job == "gold-incremental":
        run_gold_incremental(spark, lake, args.root, args.as_of or now.date(), run_ts)
    elif args.job in ("clicks", "compact-clicks"):
        name = lake.name("silver_clicks")
        create_click_tables(spark, name, args.root)
        if args.job == "compact-clicks":
            compact_clicks(spark, name, args.root, only=_taken(spark, lake, f"{name}_log"))
            return
        # what is there is taken in at once; a flush is bounded when there is one after the other
        raw = click_source(spark, args.clicks, max_bytes=args.max_bytes if args.interval else None)
        with Progress(spark, name, args.root) as progress:
            query = ingest_clicks(raw, name, args.root, args.checkpoint, args.run_ts, args.interval, args.files)
            progress.finish(query)
    else:
        table, view = lake.name("orders_state"), lake.name("silver_orders_live")
        create_orders_table(spark, table, args.root, view)
        if args.job == "orders":
            changes = order_changes(spark, args.changes, sequence=args.seq, op_col=args.op)
            ingest_orders(changes, table, args.root, args.checkpoint, run_ts).awaitTermination()
        else:
            compact_orders(spark, table, args.root, view, only=_taken(spark, lake, f"{table}_log"))


if __name__ == "__main__":
    main()
