"""The daily entry points as the original schedule runs them: take the newest
landing object, derive its date from the name and load that one day; what is stored
already is skipped. (The streaming ingest in
:mod:`candleworks.streaming.incremental` is the catch-up form of the same step.)"""

from __future__ import annotations

from candleworks import schemas
from candleworks.plans.warehouse import Warehouse
from candleworks.sources import landing


def newest_day(wh: Warehouse, landing_dir: str):
    """(object name, date) of the most recently modified object, or None. The
    listing aggregates file metadata; only the one winning row reaches the driver."""
    listing = landing.objects(wh.spark, landing_dir, with_rows=False)  # metadata only
    row = (landing.newest_object(listing)
           .join(listing.select("object", "file_date"), "object", "inner").first())
    return None if row is None or row["object"] is None else (row["object"], row["file_date"])


def load_newest_candles(wh: Warehouse, landing_dir: str, quarantine_dir: str | None = None):
    """M4 daily step. Returns the loaded date, or None when there is nothing to do."""
    newest = newest_day(wh, landing_dir)
    if newest is None:
        return None
    _, day = newest
    if day is None:  # the newest object's name holds no date
        return None
    rows = landing.read_day(wh.spark, landing_dir, "OHCL", day.isoformat(), schemas.CANDLE_RAW)
    # The load skips what is stored, so a re-delivered object changes nothing and one
    # that has grown is merged.
    return day if wh.load_candles(rows, quarantine_dir, f"OHCL_{day}") else None


def load_newest_news(wh: Warehouse, landing_dir: str, quarantine_dir: str | None = None):
    """M6 daily step (no guard in the original; the load itself is repeatable)."""
    newest = newest_day(wh, landing_dir)
    if newest is None:
        return None
    _, day = newest
    if day is None:  # the newest object's name holds no date
        return None
    rows = landing.read_day(wh.spark, landing_dir, "news", day.isoformat(), schemas.NEWS_RAW)
    wh.load_news(rows, quarantine_dir, f"news_{day}")
    return day
