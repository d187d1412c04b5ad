"""Command line: run the streams over a landing folder, or build the serving tables.

    python -m hyetos.app stream --landing PATH --root PATH [--once]
    python -m hyetos.app serve --root PATH --out PATH [--bounded] [--as-of 2024-01-15T12:00]
"""

from __future__ import annotations

import argparse
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from hyetos.operators.cities import city_timeline, hourly_slice, monitored
from hyetos.operators.daily import daily_forecast, display_days
from hyetos.operators.flatten import ALERT_COLUMNS, flatten
from hyetos.operators.trends import with_window_bounds
from hyetos.params import SliceParams, Thresholds, TrendParams
from hyetos.plans.serving import city_card
from hyetos.schemas import ALERT, ALERT_DOCUMENT, DOCUMENT, TREND
from hyetos.session import configure
from hyetos.sources.documents import stream_documents
from hyetos.sources.snapshots import export_records, latest_entry, read_history, read_latest
from hyetos.streaming import queries as streams


def run_streams(spark: SparkSession, args: argparse.Namespace) -> None:
    """Trend and alerts as two independent queries over the same landing folder."""

    def documents(schema: str):
        return stream_documents(
            spark, args.landing, schema, arrays=args.arrays, max_files=args.max_files
        )

    def of_cities(forecast):
        return monitored(forecast, args.cities) if args.cities else forecast

    options = {"once": args.once, "interval": args.interval, "console": args.console}
    params = TrendParams(window=args.window)
    thresholds = Thresholds(args.high_temp, args.low_temp, args.high_wind)
    start_trend = streams.start_trend_bounded if args.bounded else streams.start_trend
    running = [
        start_trend(of_cities(flatten(documents(DOCUMENT))), args.root, params, **options),
        streams.start_alerts(
            of_cities(flatten(documents(ALERT_DOCUMENT), columns=ALERT_COLUMNS)),
            args.root,
            thresholds,
            **options,
        ),
    ]
    if args.once:
        streams.await_all(running)
    else:
        streams.await_any(spark)


def moment(text: str | None) -> datetime:
    """ISO text as UTC without zone, as sessions run in UTC; the present if there is none."""
    given = datetime.fromisoformat(text) if text else datetime.now(UTC)
    return given.astimezone(UTC).replace(tzinfo=None) if given.tzinfo else given


def current_trend(spark: SparkSession, root: str, bounded: bool):
    """The trend rows to serve: the newest snapshot, or every window closed so far.

    Refuses to serve nothing when the streams wrote the other kind.
    """
    chosen, other = streams.TRENDS, streams.TRENDS_BOUNDED
    if bounded:
        chosen, other = other, chosen
    if latest_entry(spark, root, chosen) is None and latest_entry(spark, root, other) is not None:
        raise SystemExit(f"{root} holds {other} only: {'leave out' if bounded else 'add'} --bounded")
    if bounded:
        return read_history(spark, root, chosen, TREND).drop("batch_id")
    return read_latest(spark, root, chosen, TREND)


def export(spark: SparkSession, args: argparse.Namespace) -> None:
    """Trend and alert snapshots as JSON records for clients."""
    export_records(current_trend(spark, args.root, args.bounded), f"{args.out}/trends")
    export_records(read_latest(spark, args.root, streams.EXTREME, ALERT), f"{args.out}/alerts")


def build_serving(spark: SparkSession, args: argparse.Namespace) -> None:
    """All serving tables of the latest snapshots, one folder each under ``--out``."""
    trend = with_window_bounds(current_trend(spark, args.root, args.bounded))
    alerts = read_latest(spark, args.root, streams.EXTREME, ALERT)
    as_of = moment(args.as_of)
    days = daily_forecast(trend)
    tables = {
        "city_card": city_card(trend, alerts),
        "city_timeline": city_timeline(trend),
        "hourly_slice": hourly_slice(trend, SliceParams(as_of)),
        "daily_forecast": days,
        "daily_display": display_days(days),
    }
    for name, table in tables.items():
        table.write.mode("overwrite").format(args.format).save(f"{args.out}/{name}")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="hyetos", description=__doc__.splitlines()[0])
    commands = top.add_subparsers(required=True)
    limits = Thresholds()

    stream = commands.add_parser("stream", help="run the trend and alert streams")
    stream.add_argument("--landing", required=True, help="folder the documents arrive in")
    stream.add_argument("--root", required=True, help="folder for history and checkpoints")
    stream.add_argument("--arrays", action="store_true", help="each file holds one JSON array")
    stream.add_argument("--max-files", type=int, help="files per batch at most")
    stream.add_argument("--cities", nargs="+", help="keep these locations only")
    stream.add_argument("--window", default=TrendParams().window)
    stream.add_argument("--bounded", action="store_true", help="write each window once, closed")
    stream.add_argument("--high-temp", type=float, default=limits.high_temp)
    stream.add_argument("--low-temp", type=float, default=limits.low_temp)
    stream.add_argument("--high-wind", type=float, default=limits.high_wind)
    stream.add_argument("--interval", help="time between batches, such as '5 minutes'")
    stream.add_argument("--once", action="store_true", help="stop after what has arrived")
    stream.add_argument("--console", action="store_true", help="show rows of every batch")
    stream.set_defaults(run=run_streams)

    serve = commands.add_parser("serve", help="build the serving tables")
    serve.add_argument("--root", required=True, help="folder the streams write to")
    serve.add_argument("--out", required=True)
    serve.add_argument("--bounded", action="store_true", help="serve the bounded trend")
    serve.add_argument("--as-of", help="ISO time the hourly slice is taken around; now if left out")
    serve.add_argument("--format", default="parquet", choices=["parquet", "json"])
    serve.set_defaults(run=build_serving)

    records = commands.add_parser("export", help="write the snapshots as JSON records")
    records.add_argument("--root", required=True, help="folder the streams write to")
    records.add_argument("--out", required=True)
    records.add_argument("--bounded", action="store_true", help="export the bounded trend")
    records.set_defaults(run=export)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = configure(SparkSession.builder.appName("hyetos")).getOrCreate()
    args.run(spark, args)


if __name__ == "__main__":
    main()
