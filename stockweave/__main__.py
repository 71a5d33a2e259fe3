"""Jobs from the command line: `python -m stockweave etl --raw DIR --warehouse DIR ...`."""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from stockweave.plans import jobs
from stockweave.session import GIB, get_session, sized_for
from stockweave.sources.feeds import read_order_stream
from stockweave.sources.sinks import Warehouse
from stockweave.sources.tables import read_if_exists, read_tables
from stockweave.streaming.orders import decode_feed, load_order_stream


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="stockweave", description=__doc__)
    parser.add_argument(
        "--input-gib", type=int, default=1, help="size of the input, for shuffle and scan sizes"
    )
    job = parser.add_subparsers(dest="job", required=True)

    def add(name: str, about: str, *folders: str) -> argparse.ArgumentParser:
        sub = job.add_parser(name, help=about)
        for folder in folders:
            sub.add_argument(f"--{folder}", required=True, metavar="DIR")
        return sub

    add("etl", "clean the raw tables into the warehouse", "raw", "warehouse", "quarantine")
    lake = add("medallion", "bronze, silver and gold layers", "raw", "lake")
    lake.add_argument("--extracts", metavar="DIR")
    lake.add_argument("--gold-from", choices=("raw", "silver"), default="raw")
    marts = add("marts", "staging models and the customer mart", "warehouse")
    models = add("models", "train, store and apply the models", "warehouse", "models", "quarantine")
    procedures = add("procedures", "customer segments, stock transfers, scores", "warehouse")
    procedures.add_argument("--limit", type=int, default=100, help="transfers to list")
    stream = add(
        "stream", "clean what a feed holds now", "feed", "clean", "quarantine", "rejects", "checkpoint"
    )
    stream.add_argument("--delay", default="30 days", help="how long copies of an order are told")
    stream.add_argument("--per-batch", type=int, help="files a batch takes at most")
    for sub in (marts, models, procedures):
        sub.add_argument("--as-of", type=dt.date.fromisoformat, help="day of the report")
    add("exports", "reporting extracts", "warehouse", "quarantine", "extracts")
    load = add("load", "cloud warehouse from raw tables", "raw", "warehouse")
    load.add_argument("--extracts", metavar="DIR")
    add("publish", "copy files to the zones of the lake", "raw", "extracts", "quarantine", "lake")
    return parser


def main(arguments: Sequence[str], spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = spark or get_session(**sized_for(args.input_gib * GIB))
    if args.job == "etl":
        warehouse = Warehouse(location=args.warehouse)
        jobs.run_etl(read_tables(spark, args.raw), warehouse, args.quarantine)
    elif args.job == "medallion":
        jobs.run_medallion(spark, args.raw, args.lake, args.extracts, args.gold_from)
    elif args.job == "marts":
        tables = read_tables(spark, args.warehouse, "parquet")
        jobs.run_marts(tables, args.as_of, Warehouse(location=args.warehouse))
    elif args.job == "procedures":
        jobs.run_procedures(
            read_tables(spark, args.warehouse, "parquet"),
            Warehouse(location=args.warehouse),
            args.as_of,
            args.limit,
        )
    elif args.job == "stream":
        messages = read_order_stream(spark, "text", per_batch=args.per_batch, path=args.feed)
        load_order_stream(
            decode_feed(messages),
            args.clean,
            args.quarantine,
            args.checkpoint,
            args.delay,
            args.rejects,
        )
    elif args.job == "models":
        jobs.run_models(
            read_tables(spark, args.warehouse, "parquet"),
            Warehouse(location=args.warehouse),
            args.models,
            args.quarantine,
            args.as_of,
        )
    elif args.job == "exports":
        made = read_tables(
            spark, args.warehouse, "parquet", ("ml_demand_forecasts", "ml_churn_scores")
        )
        jobs.run_exports(
            read_tables(spark, args.warehouse, "parquet"),
            made["ml_demand_forecasts"],
            made["ml_churn_scores"],
            spark.read.parquet(f"{args.quarantine}/quarantine/anomaly_orders"),
            args.extracts,
        )
    elif args.job == "load":
        extracts = {}
        for name in ("demand_forecast", "customer_analytics") if args.extracts else ():
            found = read_if_exists(spark, name, f"{args.extracts}/{name}")
            if found is not None:
                extracts[name] = found
        jobs.run_warehouse_load(
            read_tables(spark, args.raw), Warehouse(location=args.warehouse), extracts
        )
    elif args.job == "publish":
        jobs.publish_files(spark, args.raw, args.extracts, args.quarantine, args.lake)


if __name__ == "__main__":
    main(sys.argv[1:])
