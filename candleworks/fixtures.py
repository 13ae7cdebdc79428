"""Adapters from the driver's test tables to the market-data shapes.

The test tables hold no stocks or news, so each shape is derived by Spark from
them (and the SQL oracle derives the same rows with the same rules):

* ticks ``events`` -> daily bars per user-as-ticker (``S`` + 6-digit id);
* ``supplier`` x ``nation`` x ``region`` -> exchange screener rows;
* ``orders`` (+ ``lineitem`` x ``part`` as nested arrays) -> news items.

Only this module and :mod:`candleworks.queries` know the test tables.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleworks import session as _session
from candleworks.operators import bars, numbering

# Fixed values of the fixture split (the events span 2024-01-01 .. 2024-01-30).
LOADED_THROUGH = _dt.date(2024, 1, 20)   # candles already in the warehouse
INCOMING_FROM = _dt.date(2024, 1, 15)    # first day of the re-delivered drop
CURRENT_SOURCES_BELOW = "3"              # source names < '3' are already known
CURRENT_TOPICS_BELOW = "Brand#3"         # topic names < 'Brand#3' are already known


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def symbol_of(key_col: str, prefix: str = "S"):
    return F.concat(F.lit(prefix), F.lpad(F.col(key_col).cast("string"), 6, "0"))


# ---- candles ---------------------------------------------------------------------

def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars from ``events``: value is the trade price, ``round(value*100)``
    the traded size (an exact integer, so volumes agree bit for bit everywhere)."""
    ev = table(spark, sf_dir, "events")
    return bars.daily_bars(
        ev, symbol=symbol_of("user_id"), ts="ts", price="value",
        size=F.round(F.col("value") * 100).cast("bigint"), tiebreak="event_id")


CANDLES_SQL = """candles AS (
    SELECT 'S' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS stock_symbol,
           CAST(ts AS DATE) AS trade_date,
           first(value ORDER BY ts, event_id) AS o,
           max(value) AS h,
           min(value) AS l,
           last(value ORDER BY ts, event_id) AS c,
           CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS v,
           count(*) AS trans,
           sum(value * CAST(round(value * 100) AS BIGINT)) / sum(CAST(round(value * 100) AS BIGINT)) AS vwap,
           CAST(((CAST(ts AS DATE) - DATE '1970-01-01') * 86400 + 72000) * 1000 AS VARCHAR) AS t
    FROM events
    GROUP BY 1, 2
)"""


# ---- screener --------------------------------------------------------------------

def screener(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Screener rows: symbol, name, country, sector, industry (null when the
    balance is negative), exchange id 1..3."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (s.join(n, s.s_nationkey == n.n_nationkey, "left")
            .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
            .select(symbol_of("s_suppkey").alias("Symbol"),
                    F.col("s_name").alias("Name"),
                    F.col("n_name").alias("Country"),
                    F.col("r_name").alias("Sector"),
                    F.when(F.col("s_acctbal") >= 0,
                           F.concat(F.lit("IND_"), F.floor(F.col("s_acctbal") / 1000).cast("string")))
                    .alias("Industry"),
                    (F.col("s_suppkey") % 3 + 1).cast("short").alias("exchange")))


SCREENER_SQL = """screener AS (
    SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS Symbol,
           s_name AS Name, n_name AS Country, r_name AS Sector,
           CASE WHEN s_acctbal >= 0 THEN 'IND_' || CAST(CAST(floor(s_acctbal / 1000) AS BIGINT) AS VARCHAR) END AS Industry,
           CAST(s_suppkey % 3 + 1 AS SMALLINT) AS exchange
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
                  LEFT JOIN region ON n_regionkey = r_regionkey
)"""


def current_exchange_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An exchange dimension as found before reseeding, derived from the listed
    suppliers: one member per supplier nation (id = nationkey + 1), so ids 1..3
    are replaced and the rest kept."""
    s = table(spark, sf_dir, "supplier").select("s_nationkey")
    n = table(spark, sf_dir, "nation")
    return (s.join(n, s.s_nationkey == n.n_nationkey, "inner")
            .select((F.col("n_nationkey") + 1).cast("short").alias("exchange_id"),
                    F.col("n_name").alias("exchange_name"))
            .distinct())


# ---- news ------------------------------------------------------------------------

def news_flat(spark: SparkSession, sf_dir: str, numbered: bool = True) -> DataFrame:
    """News items without arrays, numbered 0..n-1 within each file day."""
    o = table(spark, sf_dir, "orders")
    flat = o.select(
        F.to_date("o_orderdate").alias("file_date"),
        F.col("o_orderkey"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.concat(F.lit("http://news.example.com/"), F.col("o_orderkey").cast("string")).alias("url"),
        F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss").alias("time_published"),
        F.col("o_orderpriority").alias("source"),
        F.concat(F.lower("o_orderpriority"), F.lit(".example.com")).alias("source_domain"),
        (F.col("o_totalprice") / 1000000).alias("overall_sentiment_score"))
    if not numbered:
        return flat
    return numbering.number_within(flat, ["file_date"], ["o_orderkey"], "in_date_id")


def news_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-line sentiment entries (flat): topic = brand, ticker = supplier symbol
    (``X…`` for line 1: unknown on purpose)."""
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    return (li.join(p, li.l_partkey == p.p_partkey, "left")
            .select("l_orderkey",
                    F.col("p_brand").alias("topic"),
                    F.col("l_discount").cast("string").alias("relevance_score"),
                    F.concat(F.when(F.col("l_linenumber") == 1, F.lit("X")).otherwise(F.lit("S")),
                             F.lpad(F.col("l_suppkey").cast("string"), 6, "0")).alias("ticker"),
                    F.col("l_tax").cast("string").alias("ticker_sentiment_score")))


def news(spark: SparkSession, sf_dir: str, numbered: bool = True) -> DataFrame:
    """News items in landing form: nested ``topics`` and ``ticker_sentiment``
    arrays (null for an order without lines). An article's arrays are bounded by
    the feed format (here: by the lines of one order)."""
    items = (news_items(spark, sf_dir).groupBy("l_orderkey")
             .agg(F.collect_list(F.struct("topic", "relevance_score")).alias("topics"),
                  F.collect_list(F.struct("ticker", "ticker_sentiment_score")).alias("ticker_sentiment")))
    return (news_flat(spark, sf_dir, numbered=numbered)
            .join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .drop("l_orderkey"))


def news_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vendor feed (no file date, no numbering): flat fields plus arrays."""
    return news(spark, sf_dir, numbered=False).drop("file_date", "o_orderkey")


NEWS_SQL = """news AS (
    SELECT CAST(o_orderdate AS DATE) AS file_date,
           o_orderkey,
           row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey) - 1 AS in_date_id,
           'Order ' || CAST(o_orderkey AS VARCHAR) AS title,
           'http://news.example.com/' || CAST(o_orderkey AS VARCHAR) AS url,
           strftime(o_orderdate, '%Y%m%dT%H%M%S') AS time_published,
           o_orderpriority AS source,
           lower(o_orderpriority) || '.example.com' AS source_domain,
           o_totalprice / 1000000 AS overall_sentiment_score
    FROM orders
)"""

ITEMS_SQL = """items AS (
    SELECT l_orderkey, p_brand AS topic, l_discount AS relevance,
           CASE WHEN l_linenumber = 1 THEN 'X' ELSE 'S' END || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS ticker,
           l_tax AS ticker_score
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
)"""


# ---- a warehouse built once per application and test-data folder ------------------

_BUILT: dict[tuple[str, str], str] = {}
_LOCK = threading.RLock()  # queries may be built from several threads


def stored_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candle bars stored as the fact table (partitioned by trade_date, sorted by
    the fact's sort key), as a nightly load leaves them. Built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _LOCK:
        return spark.read.parquet(_build_candles(spark, sf_dir, key))


def _build_candles(spark: SparkSession, sf_dir: str, key) -> str:
    from candleworks.sinks import tables as sink_tables

    path = _BUILT.get(key)
    if path is None or not _session.path_exists(spark, path):
        path = _session.scratch_path(spark, "fixture-warehouse", spark.sparkContext.applicationId,
                                     _slug(sf_dir), "candles_FACT")
        if not _session.path_exists(spark, path + "/_SUCCESS"):
            # A backfill mixes all days in every task: range-cluster by day first so
            # each day is written by few tasks (few, larger files per partition).
            sink_tables.write_beside_then_swap(
                candles(spark, sf_dir), path, partition_by="trade_date",
                sort_by=["t", "stock_symbol"],
                range_partitions=spark.sparkContext.defaultParallelism)
        _BUILT[key] = path
    return path


def stored_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored fact's days with running row counts, as the load keeps them."""
    from candleworks import schemas
    from candleworks.operators import indicators
    from candleworks.sinks import tables as sink_tables

    bars_ = stored_candles(spark, sf_dir)
    path = _once(spark, sf_dir, "loaded-days", lambda p: sink_tables.typed(
        indicators.running_days(indicators.day_counts(bars_)), schemas.LOADED_DAYS).coalesce(1).write.parquet(p))
    return spark.read.schema(schemas.LOADED_DAYS).parquet(path)


def _slug(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


# ---- dimensions built from the screener -------------------------------------------

def screener_dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    from candleworks.operators import dimensions as dm
    s = dm.clean_screener(screener(spark, sf_dir))
    return {col: dm.load_dimension(s, col, dim) for col, dim in dm.SCREENER_DIMS.items()}


def symbol_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stock_symbol_DIM as the initial load produces it."""
    from candleworks.operators import dimensions as dm
    d = screener_dims(spark, sf_dir)
    return dm.stock_symbols(dm.clean_screener(screener(spark, sf_dir)),
                            d["Country"], d["Sector"], d["Industry"])


def screener_files(spark: SparkSession, sf_dir: str, base: str) -> str:
    """Land the screener as three CSV objects (one per exchange), nulls as ``NA``."""
    from candleworks.sinks import landing
    from candleworks.sources.screener import SCREENER_FILES
    names = spark.createDataFrame([(e, n) for n, e in SCREENER_FILES], "exchange smallint, object string")
    rows = screener(spark, sf_dir).join(F.broadcast(names), "exchange", "inner").drop("exchange")
    landing.write_screener_csv(rows.withColumn("IPO Year", F.lit(None).cast("string"))
                               .select("Symbol", "Name", "Country", "IPO Year", "Sector", "Industry",
                                       "object"), base)
    return base


# ---- landing drops written once per application ------------------------------------

def _once(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    key = (spark.sparkContext.applicationId, sf_dir + "#" + name)
    with _LOCK:
        path = _BUILT.get(key)
        if path is None:
            path = _session.scratch_path(spark, "fixture-landing", spark.sparkContext.applicationId,
                                         _slug(sf_dir), name)
            if not _session.path_exists(spark, path + "/_SUCCESS"):
                tmp = f"{path}.tmp-{uuid.uuid4().hex}"
                write(tmp)
                _session.rename_path(spark, tmp, path)
            _BUILT[key] = path
        return path


def candle_landing(spark: SparkSession, sf_dir: str) -> str:
    """``OHCL_<day>.json`` objects, one per trading day, as the vendor step lands them."""
    from candleworks.sinks import landing
    rows = bars.to_landing_rows(candles(spark, sf_dir))
    return _once(spark, sf_dir, "candles",
                 lambda p: landing.write_daily_json(rows, p, "OHCL", "trade_date"))


def news_landing(spark: SparkSession, sf_dir: str) -> str:
    """``news_<day>.json`` objects, one per file day."""
    from candleworks.sinks import landing
    rows = news(spark, sf_dir).drop("o_orderkey")
    return _once(spark, sf_dir, "news",
                 lambda p: landing.write_daily_json(rows, p, "news", "file_date"))


# ---- landing drops with lines that can't be loaded ---------------------------------------

def candle_lines(spark: SparkSession, sf_dir: str, base: str) -> str:
    """The candle objects as text, with every line of three trades cut short (as by a broken upload)."""
    rows = bars.to_landing_rows(candles(spark, sf_dir))
    cut = F.col("trans") == 3
    return _lines(rows.withColumn("object", _object("OHCL", "trade_date")), [c for c in rows.columns if c != "trade_date"], cut, CUT_AT, base)


def news_lines(spark: SparkSession, sf_dir: str, base: str) -> str:
    """The news objects as text: lines of every eleventh order are cut short, those of the next one have no number."""
    rows = news(spark, sf_dir).withColumn("object", _object("news", "file_date"))
    rows = rows.withColumn("in_date_id", F.when(F.col("o_orderkey") % 11 != 1, F.col("in_date_id")))
    fields = ["title", *[c for c in rows.columns if c not in ("title", "file_date", "o_orderkey", "object")]]
    return _lines(rows, fields, F.col("o_orderkey") % 11 == 0, CUT_AT, base)


#: Characters that are left of a line cut short.
CUT_AT = 15


def _object(prefix: str, day: str):
    from candleworks.functions import times
    return times.object_name(prefix, day)


def _lines(rows: DataFrame, fields: list[str], cut, at: int, base: str) -> str:
    from candleworks.sinks import tables

    text = F.to_json(F.struct(*fields))
    (rows.select(F.when(cut, F.left(text, F.lit(at))).otherwise(text).alias("value"), "object")
     .repartition(tables.writer_tasks(rows.sparkSession), "object").write.partitionBy("object").option("compression", "none").text(base))
    return base
