"""Command line: ``python -m panelworks analyze|fetch|consume ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from panelworks import sources, streaming
from panelworks.operators.reports import fetch, fetch_group_stats, fetch_metrics
from panelworks.plans.analyze import analyze
from panelworks.schema import MESSAGE_TOPIC, FilterSpec, PanelSpec
from panelworks.session import remove, tuned
from panelworks.sources.messages import ARRIVED

# Files carry no sequence number, so input order is taken from the scan.
FILE_SPEC = PanelSpec(order=("seq",))
ARRIVAL_SPEC = PanelSpec(at=ARRIVED)


def run_analyze(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = sources.load_raw(spark, args.input, on_bad=args.on_bad, numbered=True)
    run = analyze(spark, raw, args.output, args.rejected, spec=FILE_SPEC)
    run.by_group.show(50, truncate=False)
    remove(spark, run.staged)


def run_fetch(spark: SparkSession, args: argparse.Namespace) -> None:
    want = FilterSpec(args.indicator, args.year_from, args.year_to, args.region)
    found = fetch(sources.read_panel(spark, args.source), want)
    fetch_metrics(found).show()
    found.show(10)
    fetch_group_stats(found).show()


def run_consume(spark: SparkSession, args: argparse.Namespace) -> None:
    records = sources.parse_messages(
        sources.broker_stream(
            spark,
            args.brokers,
            topic=args.topic,
            group=args.group,
            max_per_trigger=args.max_per_trigger,
        )
    )
    every = f"{args.tick_seconds} seconds"
    streaming.flush_stream(
        records.drop(ARRIVED),
        f"{args.out_dir}/raw.parquet",
        f"{args.out_dir}/_flush",
        args.flush_threshold,
        every,
    )
    # windows run on arrival time: old records may come in at any moment
    means = streaming.sliding_stream(
        records, args.indicator, f"{args.window_seconds} seconds", every, spec=ARRIVAL_SPEC
    )
    streaming.top_stream(means, f"{args.out_dir}/top.parquet", f"{args.out_dir}/_top", every=every)
    spark.streams.awaitAnyTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="panelworks", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    batch = commands.add_parser("analyze", help="clean, validate, aggregate and store NDJSON")
    batch.add_argument("--input", required=True)
    batch.add_argument("--output", required=True)
    batch.add_argument("--rejected", required=True)
    batch.add_argument("--on-bad", choices=["fail", "drop", "keep"], default="fail")
    batch.set_defaults(run=run_analyze)

    query = commands.add_parser("fetch", help="filtered rows and their group statistics")
    query.add_argument("--source", required=True)
    query.add_argument("--indicator", default="birth_rate")
    query.add_argument("--year-from", type=int)
    query.add_argument("--year-to", type=int)
    query.add_argument("--region")
    query.set_defaults(run=run_fetch)

    live = commands.add_parser("consume", help="sliding top 5 and Parquet flush of a topic")
    live.add_argument("--brokers", default="localhost:9092")
    live.add_argument("--topic", default=MESSAGE_TOPIC)
    live.add_argument("--group", default="panelworks")
    live.add_argument("--out-dir", required=True)
    live.add_argument("--indicator", default="birth_rate")
    live.add_argument("--window-seconds", type=int, default=300)
    live.add_argument("--tick-seconds", type=int, default=30)
    live.add_argument("--flush-threshold", type=int, help="rows per Parquet file at most")
    live.add_argument("--max-per-trigger", type=int, help="records per micro-batch at most")
    live.set_defaults(run=run_consume)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = tuned(SparkSession.builder.appName("panelworks")).getOrCreate()
    args.run(spark, args)


if __name__ == "__main__":
    main()
