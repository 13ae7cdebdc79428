"""Landing jobs: turn vendor-shaped rows into the daily NDJSON objects.

* M7 ``land_candles``: tick rows -> one grouped bar per ticker and day -> vendor
  attribute names -> ``OHCL_<day>.json``.
* M8 ``land_news``: news items -> each day's extraction slice (a ``limit``
  is optional) -> numbered 0..n-1 in a declared order ->
  ``news_<day>.json``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from candleworks.operators import bars, numbering
from candleworks.operators import news as ns
from candleworks.sinks import landing as landing_sink
from candleworks.sinks import tables


def land_candles(ticks: DataFrame, base: str, symbol: Column, ts: str, price: str, size: Column,
                 tiebreak: str | None = None) -> None:
    daily = bars.daily_bars(ticks, symbol=symbol, ts=ts, price=price, size=size, tiebreak=tiebreak)
    landing_sink.write_daily_json(bars.to_landing_rows(daily), base, "OHCL", "trade_date")


def news_objects(items: DataFrame, limit: int | None = None) -> DataFrame:
    """The rows of each day's news object: the day's slice, numbered 0..n-1 in the
    declared feed order (time_published, url, title). ``items`` carries the vendor
    fields (arrays included) and no file date: the object's day is the publish day. Rows
    lie as they are to be written, a day in one task (a hot one in several)."""
    sliced = ns.day_slice(items, limit=limit, lag_days=0)
    numbered = numbering.number_and_deal(
        sliced.withColumnRenamed("extract_day", "file_date"), "file_date",
        list(ns.FEED_ORDER), "in_date_id", tables.writer_tasks(items.sparkSession))
    return numbered.drop("run_date", "time_from", "time_to")


def land_news(items: DataFrame, base: str, limit: int | None = None) -> None:
    landing_sink.write_daily_json(news_objects(items, limit), base, "news", "file_date", dealt=True)
