"""Candle loads: the day's bars against the symbol dimension, quarantine of
unknown tickers, the already-loaded guard and carry-forward of the last close.

Carry-forward rule (one row per known symbol and trading day once a symbol has
traded): a day without a trade repeats the last close as o = h = l = c, volume and
trade count 0, the last vwap, and the day's file stamp ``t``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candleworks import schemas
from candleworks.functions import times

FACT_COLS = ["stock_symbol", "o", "h", "c", "l", "v", "Trans", "t", "vwap", "filled", "trade_date"]


def with_trade_date(raw_landing: DataFrame) -> DataFrame:
    """Landing rows (ticker, ..., time) -> fact-shaped rows with the date derived
    once from the epoch text (null when the text is not a number). The landing
    object's date is kept as ``file_date``, its name as ``object``, its path as ``file`` and the text of a line
    that couldn't be parsed as ``raw`` (null when unknown)."""
    has = lambda name, kind="string": (F.col(name) if name in raw_landing.columns else F.lit(None)).cast(kind)
    return raw_landing.select(
        F.col("ticker").alias("stock_symbol"), "o", "h", "c", "l",
        F.round(F.col("v")).try_cast("bigint").alias("v"), F.col("trans").alias("trans"),
        F.col("time").alias("t"), "vwap",
        times.date_from_epoch_millis_text("time").alias("trade_date"),
        has("file_date", "date").alias("file_date"), has("object").alias("object"), has("file").alias("file"),
        has(schemas.CORRUPT).alias("raw"))


def _reason(dim_hit: str) -> "F.Column":
    return (F.when(F.col("raw").isNotNull(), F.lit("malformed"))
            .when(F.col("trade_date").isNull(), F.lit("bad_time"))
            .when(F.col("file_date").isNotNull() & (F.col("file_date") != F.col("trade_date")),
                  F.lit("file_date_mismatch"))
            .when((F.col("v") < 0) | (F.col("trans") < 0), F.lit("out_of_range"))
            .when(F.col(dim_hit).isNull(), F.lit("unknown_ticker")))


def _with_reason(bars: DataFrame, dim: DataFrame) -> DataFrame:
    hits = dim.select(F.col("stock_symbol").alias("_known")).distinct()
    return (bars.join(hits, F.col("stock_symbol") == F.col("_known"), "left")
            .withColumn("reason", _reason("_known")).drop("_known"))


def quarantine(bars: DataFrame, dim: DataFrame) -> DataFrame:
    """Rows a load must not take: unparseable time, a trade date other than the
    landing object's date, a negative volume or trade count (both are unsigned in the
    warehouse), or a ticker missing from the dimension."""
    return _with_reason(bars, dim).where(F.col("reason").isNotNull())


def accepted(bars: DataFrame, dim: DataFrame) -> DataFrame:
    return _with_reason(bars, dim).where(F.col("reason").isNull()).drop("reason")


def landed_days(bars: DataFrame) -> DataFrame:
    """(trade_date, t) of every row with a usable date that matches its object's
    date, whatever the ticker: a day whose file holds only unknown tickers is still
    a trading day on which known symbols get carried forward."""
    ok = F.col("trade_date").isNotNull() & (
        F.col("file_date").isNull() | (F.col("file_date") == F.col("trade_date")))
    return bars.where(ok).select("trade_date", "t")


def right_join_dim(day: DataFrame, dim: DataFrame) -> DataFrame:
    """Every symbol of the dimension with its bar of the day (null if it did not
    trade); bars of unknown tickers drop out. Written as dim LEFT JOIN bars."""
    return (dim.select("stock_symbol").join(
        day.withColumn("_traded", F.lit(True)), "stock_symbol", "left"))


def untraded(day: DataFrame, dim: DataFrame) -> DataFrame:
    return (right_join_dim(day, dim).where(F.col("_traded").isNull())
            .select("stock_symbol"))


def unknown_tickers(bars: DataFrame, dim: DataFrame) -> DataFrame:
    """Quarantine: bars whose ticker is not in the dimension."""
    return bars.join(dim.select("stock_symbol"), "stock_symbol", "left_anti")


def new_dates_only(incoming: DataFrame, loaded: DataFrame) -> DataFrame:
    """Already-loaded guard: drop incoming rows of a date the fact already holds.
    The date checked is the landing object's date when known (as the reference
    checks the file name), else the row's own trade date."""
    done = loaded.select(F.col("trade_date").alias("_done")).distinct()
    day = (F.coalesce(F.col("file_date"), F.col("trade_date")) if "file_date" in incoming.columns
           else F.col("trade_date"))
    return (incoming.withColumn("_day", day)
            .join(done, F.col("_day") == F.col("_done"), "left_anti").drop("_day"))


def not_stored(bars: DataFrame, stored: DataFrame) -> DataFrame:
    """Bars (in the fact's columns and types) that no stored row equals. Nulls are
    equal to each other."""
    have = stored.select(*[F.col(c).alias(f"_have_{c}") for c in FACT_COLS])
    same = [F.col(c).eqNullSafe(F.col(f"_have_{c}")) for c in FACT_COLS]
    return bars.join(have, same, "left_anti")


def traded(fact: DataFrame) -> DataFrame:
    """Stored rows of real trades, whatever they look like: fills are marked."""
    return fact.where(~F.coalesce(F.col("filled"), F.lit(False)))


def first_stamp(t: str = "t"):
    """Earliest epoch-ms stamp of a group, as text. The minimum is taken over the
    number (a hash aggregate with a map-side partial; a minimum over text would
    need a sort-based aggregate that sorts every input row first)."""
    return F.min(F.col(t).try_cast("bigint")).cast("string")


def _fact(df: DataFrame, filled: bool) -> DataFrame:
    return df.withColumn("filled", F.lit(filled)).select(*[F.col(c) for c in FACT_COLS])


def fill_day(day: DataFrame, dim: DataFrame, prior: DataFrame) -> DataFrame:
    """One day's load: traded known symbols, plus untraded symbols filled from
    ``prior`` (one candle per symbol, e.g. the fact's nearest earlier date)."""
    day_t = day.agg(first_stamp()).scalar()
    d = day.agg(F.max("trade_date")).scalar()
    traded = day.join(dim.select("stock_symbol"), "stock_symbol", "left_semi")
    missing = untraded(day, dim)
    filled = (missing.join(prior.select("stock_symbol", F.col("c").alias("_c"),
                                        F.col("vwap").alias("_vwap")), "stock_symbol", "inner")
              .select("stock_symbol", F.col("_c").alias("o"), F.col("_c").alias("h"),
                      F.col("_c").alias("c"), F.col("_c").alias("l"),
                      F.lit(0).cast("bigint").alias("v"), F.lit(0).cast("bigint").alias("Trans"),
                      day_t.alias("t"), F.col("_vwap").alias("vwap"), d.alias("trade_date")))
    return _fact(traded.withColumnRenamed("trans", "Trans"), False).unionByName(_fact(filled, True))


def nearest_before(history: DataFrame, day) -> DataFrame:
    """Candles of the latest date strictly before ``day`` (a scalar filter: on a
    table partitioned by trade_date one partition is read)."""
    prior_date = history.where(F.col("trade_date") < day).agg(F.max("trade_date")).scalar()
    return history.where(F.col("trade_date") == prior_date)


def load_latest_day(bars: DataFrame, dim: DataFrame, history: DataFrame) -> DataFrame:
    """The reference's daily step for the newest day in ``bars``: fill from the
    history's nearest earlier date."""
    d = bars.agg(F.max("trade_date")).scalar()
    day = bars.where(F.col("trade_date") == d)
    return fill_day(day, dim, nearest_before(history, d))


def last_of_day(bars: DataFrame) -> DataFrame:
    """``stock_symbol``, ``trade_date`` and ``_last``, the bar of each symbol and day that is carried:
    the one of the latest stamp (what follows the stamp only settles ties)."""
    order = F.struct(F.col("t").try_cast("bigint").alias("stamp"), "c", "vwap", "v", "trans", "o", "h", "l")
    return bars.groupBy("stock_symbol", "trade_date").agg(F.max(order).alias("_last"))


def fills(last: DataFrame, days: DataFrame) -> DataFrame:
    """A row for every symbol and trading day (``trade_date``, ``_day_t``) after its first bar that
    has none, from the bar before. ``last`` has one row per symbol and day of trade."""
    last_day = days.agg(F.max("trade_date")).scalar()
    after = F.lead("trade_date").over(Window.partitionBy("stock_symbol").orderBy("trade_date"))
    gaps = (last.withColumn("_from", F.date_add("trade_date", 1))
            .withColumn("_to", F.coalesce(F.date_sub(after, 1), last_day)).where("_from <= _to")
            .select("stock_symbol", "_last", F.explode(F.sequence("_from", "_to")).alias("trade_date")))
    # Trading days are bounded by the calendar (about 250 a year), so broadcasting
    # them is safe at any data volume.
    close = F.col("_last.c")
    return gaps.join(F.broadcast(days), "trade_date").select(
        "stock_symbol", *[close.alias(c) for c in ("o", "h", "c", "l")], F.lit(0).cast("bigint").alias("v"),
        F.lit(0).cast("bigint").alias("Trans"), F.col("_day_t").alias("t"), F.col("_last.vwap").alias("vwap"), "trade_date")


def carry_forward(bars: DataFrame, dim: DataFrame, seed: DataFrame | None = None,
                  days: DataFrame | None = None) -> DataFrame:
    """Last-observation-carried-forward fact for every known symbol and every
    trading day (a day some file exists for) from the symbol's first trade on.

    ``seed`` (optional) holds fact rows of one earlier day (the stored fact's
    nearest day before ``bars``); they start the carry and are not re-emitted.
    ``days`` (optional, ``trade_date, t``) adds trading days that have no bar of a
    known symbol (a loaded day being recomputed).

    Bars pass through as they are, without a shuffle. What is carried is one bar per symbol
    and day, found by an aggregate that combines within tasks, so neither copies nor
    distinct bars of a hot symbol meet in one task; the window that looks for gaps sees at most a
    row per trading day of a symbol, which the calendar bounds.
    """
    known = bars.join(dim.select("stock_symbol").distinct(), "stock_symbol", "left_semi")
    rows = known.select("stock_symbol", "trade_date", "o", "h", "l", "c", "v",
                        F.col("trans").cast("bigint").alias("trans"), "t", "vwap")
    all_days = bars.select("trade_date", "t")
    if days is not None:
        all_days = all_days.unionByName(days.select("trade_date", "t"))
    carried = rows
    if seed is not None:
        carried = rows.unionByName(seed.select("stock_symbol", "trade_date", "o", "h", "l", "c", "v",
                                               F.col("Trans").cast("bigint").alias("trans"), "t", "vwap"))
        all_days = all_days.unionByName(seed.select("trade_date", "t"))
    by_day = all_days.groupBy("trade_date").agg(first_stamp().alias("_day_t"))
    filled = fills(last_of_day(carried), by_day)
    return _fact(rows.withColumnRenamed("trans", "Trans"), False).unionByName(_fact(filled, True))
