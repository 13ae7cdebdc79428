"""Command line for the warehouse jobs (scheduling stays with whatever runs it).

    python -m candleworks init --warehouse DIR
    python -m candleworks load-screeners --warehouse DIR CSV [CSV ...]
    python -m candleworks candles --warehouse DIR --landing DIR [--quarantine DIR] [--stream CKPT]
    python -m candleworks indicators --warehouse DIR [--since yyyy-MM-dd]
    python -m candleworks news --warehouse DIR --landing DIR [--quarantine DIR] [--stream CKPT]
    python -m candleworks data-tests --warehouse DIR --spec schema.yml
    python -m candleworks audit --landing DIR

Without ``--stream`` the candle and news commands take the newest landing object
(the daily step); with it they catch up on every object not seen before.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys


def _print_rows(df) -> None:
    """Every row as a JSON line, one partition in memory at a time."""
    from pyspark.sql import functions as F

    for row in df.select(F.to_json(F.struct(*df.columns)).alias("line")).toLocalIterator():
        print(row["line"])


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="candleworks")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("init", "load-screeners", "candles", "indicators", "news", "data-tests", "audit"):
        c = sub.add_parser(name)
        if name != "audit":
            c.add_argument("--warehouse", default=None)
        if name in ("candles", "news", "audit"):
            c.add_argument("--landing", required=True)
        if name in ("candles", "news"):
            c.add_argument("--stream", default=None, help="checkpoint folder: catch up with a stream")
            c.add_argument("--quarantine", default=None, help="folder for rejected rows")
        if name == "indicators":
            c.add_argument("--since", default=None)
        if name == "load-screeners":
            c.add_argument("csv", nargs="+")
        if name == "data-tests":
            c.add_argument("--spec", required=True)
    args = p.parse_args(argv)

    from candleworks.session import get_session

    spark = get_session()
    if args.cmd == "audit":
        from candleworks.sources import landing
        _print_rows(landing.objects(spark, args.landing).orderBy("object"))
        return 0

    from candleworks.plans import daily
    from candleworks.plans.warehouse import Warehouse
    from candleworks.streaming import incremental

    wh = Warehouse(spark, args.warehouse)
    if args.cmd == "init":
        wh.init_schema()
    elif args.cmd == "load-screeners":
        from candleworks.sources.screener import read_screeners
        scr = read_screeners(spark, args.csv)
        wh.load_dimensions(scr)
        wh.load_stock_symbols(scr)
    elif args.cmd == "candles":
        if args.stream:
            incremental.ingest_candles(spark, wh, args.landing, args.stream, args.quarantine, max_files=8)
        else:
            print(daily.load_newest_candles(wh, args.landing, args.quarantine))
    elif args.cmd == "indicators":
        since = dt.date.fromisoformat(args.since) if args.since else None
        wh.compute_indicators()
        wh.compute_moving_averages(since=since)
        wh.build_calendar()
    elif args.cmd == "news":
        if args.stream:
            incremental.ingest_news(spark, wh, args.landing, args.stream, quarantine_dir=args.quarantine)
        else:
            print(daily.load_newest_news(wh, args.landing, args.quarantine))
    elif args.cmd == "data-tests":
        from candleworks.operators import quality
        wh.register_views()
        with open(args.spec) as fh:
            _print_rows(quality.tests_from_spec(spark, fh.read()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
