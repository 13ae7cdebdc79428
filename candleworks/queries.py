"""Registry of named queries over the driver's test tables, with SQL oracles.

Each entry is ``name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle_sql | None)``.
The Spark side calls the library's operators on the fixture adapters; the oracle
is an independent, literal SQL text over the same tables (DuckDB dialect). Both
alias every output column identically and render dates as ``yyyy-MM-dd`` text.
Doubles that come out of an aggregate (whose summation order differs between
engines) are rounded to 6 places in both; per-row arithmetic on the same inputs is
bit-identical IEEE in both engines and is left unrounded (rounding it could split
an exact decimal tie differently).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candleworks import fixtures as fx
from candleworks import schemas
from candleworks import session as _session
from candleworks.fixtures import CANDLES_SQL, ITEMS_SQL, NEWS_SQL, SCREENER_SQL
from candleworks.functions import times, uuid_key_sql
from candleworks.operators import bars, indicators, models, quality
from candleworks.operators import candles as cd
from candleworks.operators import dimensions as dm
from candleworks.operators import news as ns
from candleworks.plans import landing_jobs
from candleworks.plans.warehouse import Warehouse
from candleworks.sinks import tables as sink_tables
from candleworks.sources import landing as landing_src
from candleworks.sources.screener import read_screeners
from candleworks.streaming import incremental

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, sql: str | None):
    """Register ``fn`` under ``name`` with its oracle SQL (None: rows-only check)."""
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            _session.configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = (run, sql)
        return run
    return deco


def r6(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), 6)


def d2s(c: Column | str) -> Column:
    return times.iso_text(c)


def _candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candle fact as the indicator family reads it: stored, partitioned by date."""
    return fx.stored_candles(spark, sf_dir)


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded days of that fact, with running row counts."""
    return fx.stored_days(spark, sf_dir)


# =============================== candles: bars and indicators ===============================

@query("grouped_daily_bars", f"""WITH {CANDLES_SQL}
SELECT stock_symbol AS ticker, CAST(trade_date AS VARCHAR) AS trade_date, o, h, l, c, v,
       round(vwap, 6) AS vwap, t AS time, trans
FROM candles""")
def grouped_daily_bars(spark, sf_dir):
    """One OHLCV bar per ticker and day from tick rows, vendor names."""
    b = bars.to_landing_rows(fx.candles(spark, sf_dir))
    return b.select("ticker", d2s("trade_date").alias("trade_date"), "o", "h", "l", "c",
                    F.col("v").cast("long").alias("v"), r6("vwap").alias("vwap"), "time", "trans")


@query("latest_trade_date", f"""WITH {CANDLES_SQL}
SELECT CAST(max(trade_date) AS VARCHAR) AS max_date FROM candles""")
def latest_trade_date(spark, sf_dir):
    """Max trade date."""
    return indicators.latest_trade_date(_days(spark, sf_dir)).select(
        d2s("max_date").alias("max_date"))


@query("previous_trade_date", f"""WITH {CANDLES_SQL}
SELECT CAST(max(trade_date) AS VARCHAR) AS max_date_2 FROM candles
WHERE trade_date <> (SELECT max(trade_date) FROM candles)""")
def previous_trade_date(spark, sf_dir):
    """Second-largest distinct date via a scalar-subquery filter."""
    return indicators.previous_trade_date(_days(spark, sf_dir)).select(
        d2s("max_date_2").alias("max_date_2"))


@query("latest_day_close", f"""WITH {CANDLES_SQL}
SELECT stock_symbol, c FROM candles WHERE trade_date = (SELECT max(trade_date) FROM candles)""")
def latest_day_close(spark, sf_dir):
    """Closes on the latest date."""
    return indicators.latest_day_close(_candles(spark, sf_dir))


_DELTA_SQL = """by_age AS (SELECT stock_symbol, c, trade_date, dense_rank() OVER (ORDER BY trade_date DESC) AS age FROM candles),
delta AS (SELECT stock_symbol, max(trade_date) AS date, sum(CASE age WHEN 1 THEN c ELSE -c END) AS delta
          FROM by_age WHERE age <= 2 GROUP BY stock_symbol HAVING count(DISTINCT age) = 2)"""


@query("close_delta", f"""WITH {CANDLES_SQL}, {_DELTA_SQL}
SELECT CAST(date AS VARCHAR) AS date, round(delta, 6) AS delta, stock_symbol FROM delta""")
def close_delta(spark, sf_dir):
    """Latest minus previous-date close (inner self-join)."""
    return indicators.close_delta(_candles(spark, sf_dir), _days(spark, sf_dir)).select(
        d2s("date").alias("date"), r6("delta").alias("delta"), "stock_symbol")


@query("first_rows_dates", f"""WITH {CANDLES_SQL}
SELECT 3 AS k, CAST(row_date AS VARCHAR) AS row_date
FROM (SELECT trade_date AS row_date FROM candles ORDER BY trade_date LIMIT 3)
UNION ALL
SELECT 5 AS k, CAST(row_date AS VARCHAR) AS row_date
FROM (SELECT trade_date AS row_date FROM candles ORDER BY trade_date LIMIT 5)""")
def first_rows_dates(spark, sf_dir):
    """G1: dates of the 3 and the 5 earliest rows (duplicates kept)."""
    c, days = _candles(spark, sf_dir), _days(spark, sf_dir)
    return indicators.first_rows_dates(c, 3, days).select(F.lit(3).alias("k"), d2s("row_date").alias("row_date")) \
        .unionByName(indicators.first_rows_dates(c, 5, days).select(F.lit(5).alias("k"),
                                                              d2s("row_date").alias("row_date")))


def _avg_first_sql(k: int) -> str:
    return f"""WITH {CANDLES_SQL},
first_rows AS (SELECT trade_date FROM candles ORDER BY trade_date LIMIT {k})
SELECT stock_symbol, round(avg(c), 6) AS avg_close FROM candles
WHERE trade_date IN (SELECT trade_date FROM first_rows) GROUP BY stock_symbol"""


@query("avg_close_first_3_rows", _avg_first_sql(3))
def avg_close_first_3_rows(spark, sf_dir):
    """Average close over the dates of the 3 earliest rows."""
    return indicators.avg_close_first_rows(_candles(spark, sf_dir), 3, _days(spark, sf_dir)).select(
        "stock_symbol", r6("avg_close").alias("avg_close"))


@query("avg_close_first_5_rows", _avg_first_sql(5))
def avg_close_first_5_rows(spark, sf_dir):
    """Average close over the dates of the 5 earliest rows."""
    return indicators.avg_close_first_rows(_candles(spark, sf_dir), 5, _days(spark, sf_dir)).select(
        "stock_symbol", r6("avg_close").alias("avg_close"))


OHCL_INDICATOR_SQL = f"""WITH {CANDLES_SQL}, {_DELTA_SQL},
rows3 AS (SELECT trade_date FROM candles ORDER BY trade_date LIMIT 3),
rows5 AS (SELECT trade_date FROM candles ORDER BY trade_date LIMIT 5),
short_avg AS (SELECT stock_symbol, avg(c) AS v FROM candles
              WHERE trade_date IN (SELECT trade_date FROM rows3) GROUP BY stock_symbol),
long_avg AS (SELECT stock_symbol, avg(c) AS v FROM candles
             WHERE trade_date IN (SELECT trade_date FROM rows5) GROUP BY stock_symbol)
SELECT delta.stock_symbol, CAST(delta.date AS VARCHAR) AS date, round(delta.delta, 6) AS delta,
       round(short_avg.v, 6) AS sliding_avg_3, round(long_avg.v, 6) AS sliding_avg_5
FROM delta JOIN short_avg ON delta.stock_symbol = short_avg.stock_symbol
           JOIN long_avg ON delta.stock_symbol = long_avg.stock_symbol"""


def ohcl_indicator_df(candles: DataFrame, days: DataFrame) -> DataFrame:
    return indicators.ohcl_indicator(candles, days=days).select(
        "stock_symbol", "date", r6("delta").alias("delta"),
        r6("sliding_avg_3").alias("sliding_avg_3"), r6("sliding_avg_5").alias("sliding_avg_5"))


@query("ohcl_indicator", OHCL_INDICATOR_SQL)
def ohcl_indicator(spark, sf_dir):
    """M5 D4 I6 T1 T2 (flagship): the indicator table exactly as the reference computes it."""
    return ohcl_indicator_df(_candles(spark, sf_dir), _days(spark, sf_dir))


@query("avg_close_last_n_days", f"""WITH {CANDLES_SQL},
d3 AS (SELECT min(d) AS since FROM (SELECT DISTINCT trade_date AS d FROM candles ORDER BY d DESC LIMIT 3)),
d5 AS (SELECT min(d) AS since FROM (SELECT DISTINCT trade_date AS d FROM candles ORDER BY d DESC LIMIT 5))
SELECT stock_symbol,
       round(avg(CASE WHEN trade_date >= (SELECT since FROM d3) THEN c END), 6) AS avg_close_3,
       round(avg(c), 6) AS avg_close_5
FROM candles WHERE trade_date >= (SELECT since FROM d5) GROUP BY stock_symbol""")
def avg_close_last_n_days(spark, sf_dir):
    """Intent of T1: average close over the last 3 / 5 trading dates."""
    return indicators.avg_close_last_n_days(_candles(spark, sf_dir), (3, 5)).select(
        "stock_symbol", r6("avg_close_3").alias("avg_close_3"), r6("avg_close_5").alias("avg_close_5"))


def _ma_sql(n: int) -> str:
    return f"""WITH {CANDLES_SQL}
SELECT stock_symbol, t, round(avg(c) OVER (PARTITION BY stock_symbol ORDER BY trade_date
       ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), 6) AS ma FROM candles"""


@query("short_ma", _ma_sql(3))
def short_ma(spark, sf_dir):
    """3-row trailing moving average of the close per symbol."""
    return indicators.short_ma(_candles(spark, sf_dir), 3).select("stock_symbol", "t", r6("ma").alias("ma"))


@query("long_ma", _ma_sql(5))
def long_ma(spark, sf_dir):
    """5-row trailing moving average of the close per symbol."""
    return indicators.long_ma(_candles(spark, sf_dir), 5).select("stock_symbol", "t", r6("ma").alias("ma"))


@query("avg_volume", f"""WITH {CANDLES_SQL}
SELECT stock_symbol, CAST(trade_date AS VARCHAR) AS date,
       round(avg(v) OVER (PARTITION BY stock_symbol ORDER BY trade_date
             ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS sliding_avg FROM candles""")
def avg_volume(spark, sf_dir):
    """5-row trailing average volume per symbol."""
    return indicators.avg_volume(_candles(spark, sf_dir), 5).select(
        "stock_symbol", d2s("date").alias("date"), r6("sliding_avg").alias("sliding_avg"))


# =============================== dimensions ===============================

def _dim_sql(table: str, name: str, column: str) -> str:
    return f"""WITH {SCREENER_SQL},
cur AS (SELECT DISTINCT coalesce({column}, 'unpredict') AS {name} FROM screener WHERE exchange = 1),
inc AS (SELECT DISTINCT coalesce({column}, 'unpredict') AS {name} FROM screener WHERE exchange <> 1)
SELECT {uuid_key_sql(table, name)} AS {name.replace('_name', '') + '_id' if name != 'sector' else 'sector_id'}, {name}
FROM inc WHERE NOT EXISTS (SELECT 1 FROM cur WHERE cur.{name} = inc.{name})"""


def _dim_query(column: str):
    def run(spark, sf_dir):
        s = dm.clean_screener(fx.screener(spark, sf_dir))
        dim = dm.SCREENER_DIMS[column]
        current = dm.load_dimension(s.where(F.col("exchange") == 1), column, dim)
        return dm.load_dimension(s.where(F.col("exchange") != 1), column, dim, current=current)
    return run


for _col, _dim in (("Country", dm.COUNTRY), ("Sector", dm.SECTOR), ("Industry", dm.INDUSTRY)):
    query("dim_" + _col.lower(), _dim_sql(_dim.table, _dim.name_col, _col))(_dim_query(_col))


@query("exchange_seed", """SELECT exchange_id, exchange_name FROM
  (SELECT DISTINCT CAST(n_nationkey + 1 AS SMALLINT) AS exchange_id, n_name AS exchange_name
   FROM supplier JOIN nation ON s_nationkey = n_nationkey)
WHERE exchange_id >= 4
UNION ALL SELECT CAST(exchange_id AS SMALLINT), exchange_name
          FROM (VALUES (1, 'nasdaq'), (2, 'nyse'), (3, 'amex')) v(exchange_id, exchange_name)""")
def exchange_seed(spark, sf_dir):
    """Reseed the exchange dimension (delete ids < 4, insert the fixed three)."""
    return dm.reseed_exchanges(fx.current_exchange_dim(spark, sf_dir))


STOCK_SYMBOL_SQL = f"""WITH {SCREENER_SQL}
SELECT Symbol AS stock_symbol, Name AS stock_symbol_name,
       {uuid_key_sql('country_DIM', "coalesce(Country, 'unpredict')")} AS country_id,
       {uuid_key_sql('sector_DIM', "coalesce(Sector, 'unpredict')")} AS sector_id,
       {uuid_key_sql('industry_DIM', "coalesce(Industry, 'unpredict')")} AS industry_id,
       exchange
FROM screener"""


@query("symbol_repair", f"""WITH {SCREENER_SQL},
listed AS (SELECT CASE WHEN Industry IS NULL THEN NULL ELSE Symbol END AS Symbol, Name, Industry FROM screener)
SELECT CASE WHEN Industry IS NULL THEN 'NA' ELSE Symbol END AS symbol, count(*) AS n, count(DISTINCT Name) AS names FROM listed GROUP BY 1""")
def symbol_repair(spark, sf_dir):
    """The symbol of a company whose symbol a reader takes for a missing value is set again by its
    name; the rows without an industry are listed under that company's name and without a symbol."""
    scr = fx.screener(spark, sf_dir)
    broken = F.col("Industry").isNull()
    listed = scr.select(F.when(~broken, F.col("Symbol")).alias("Symbol"), F.when(broken, F.lit(next(iter(dm.SYMBOL_REPAIRS)))).otherwise(F.col("Name")).alias("Name"),
                        F.col("Name").alias("as_listed"))
    return dm.repair_symbols(listed).groupBy(F.col("Symbol").alias("symbol")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("as_listed").alias("names"))


@query("stock_symbol_dim", STOCK_SYMBOL_SQL)
def stock_symbol_dim(spark, sf_dir):
    """Symbols with their country/sector/industry ids."""
    return fx.symbol_dim(spark, sf_dir)


@query("na_words_to_null", f"""WITH {SCREENER_SQL}
SELECT Symbol, Name, Country, Sector, Industry, exchange FROM screener""")
def na_words_to_null(spark, sf_dir):
    """Screener CSVs (nulls landed as the word NA) read in one scan,
    exchange id from the file name, missing-value words -> null."""
    base = _session.scratch_path(spark, "screener", unique=True)
    fx.screener_files(spark, sf_dir, base)
    return read_screeners(spark, base)


# =============================== candle loads ===============================

_DIM_SYMBOLS_SQL = "dim AS (SELECT DISTINCT Symbol AS stock_symbol FROM screener)"
_DAY_SQL = """dd AS (SELECT max(trade_date) AS d FROM candles),
today AS (SELECT * FROM candles WHERE trade_date = (SELECT d FROM dd))"""


@query("candles_right_join_dim", f"""WITH {CANDLES_SQL}, {SCREENER_SQL}, {_DIM_SYMBOLS_SQL}, {_DAY_SQL}
SELECT dim.stock_symbol, today.o, today.h, today.l, today.c, today.v, today.trans,
       round(today.vwap, 6) AS vwap
FROM dim LEFT JOIN today ON today.stock_symbol = dim.stock_symbol""")
def candles_right_join_dim(spark, sf_dir):
    """The newest day's bars against every symbol of the dimension."""
    bars_ = _candles(spark, sf_dir)
    day = bars_.where(F.col("trade_date") == indicators._max_date(bars_))
    return cd.right_join_dim(day, fx.symbol_dim(spark, sf_dir)).select(
        "stock_symbol", "o", "h", "l", "c", "v", "trans", r6("vwap").alias("vwap"))


@query("untraded_symbols", f"""WITH {CANDLES_SQL}, {SCREENER_SQL}, {_DIM_SYMBOLS_SQL}, {_DAY_SQL}
SELECT dim.stock_symbol FROM dim LEFT JOIN today ON today.stock_symbol = dim.stock_symbol
WHERE today.stock_symbol IS NULL""")
def untraded_symbols(spark, sf_dir):
    """Symbols of the dimension without a bar on the newest day."""
    bars_ = _candles(spark, sf_dir)
    day = bars_.where(F.col("trade_date") == indicators._max_date(bars_))
    return cd.untraded(day, fx.symbol_dim(spark, sf_dir))


def _fact_out(df: DataFrame) -> DataFrame:
    return df.select("stock_symbol", "o", "h", "c", "l", F.col("v").cast("long").alias("v"),
                     F.col("Trans").cast("long").alias("Trans"), "t", r6("vwap").alias("vwap"),
                     d2s("trade_date").alias("trade_date"))


_FACT_OUT_SQL = """stock_symbol, o, h, c, l, CAST(v AS BIGINT) AS v, CAST(Trans AS BIGINT) AS Trans, t,
       round(vwap, 6) AS vwap, CAST(trade_date AS VARCHAR) AS trade_date"""


_FACT_OUT_REAL_SQL = """stock_symbol, round(CAST(CAST(o AS REAL) AS DOUBLE), 6) AS o, round(CAST(CAST(h AS REAL) AS DOUBLE), 6) AS h,
       round(CAST(CAST(c AS REAL) AS DOUBLE), 6) AS c, round(CAST(CAST(l AS REAL) AS DOUBLE), 6) AS l,
       CAST(v AS BIGINT) AS v, CAST(Trans AS BIGINT) AS Trans, t,
       round(CAST(CAST(vwap AS REAL) AS DOUBLE), 6) AS vwap, CAST(trade_date AS VARCHAR) AS trade_date"""


def _fact_out_real(fact: DataFrame) -> DataFrame:
    """The stored fact, whose prices are single precision."""
    return fact.select("stock_symbol", *[r6(c).alias(c) for c in ("o", "h", "c", "l")],
                       F.col("v").cast("long").alias("v"), F.col("Trans").cast("long").alias("Trans"), "t",
                       r6("vwap").alias("vwap"), d2s("trade_date").alias("trade_date"))


def _warehouse(spark: SparkSession, sf_dir: str, name: str) -> Warehouse:
    """A warehouse of its own with the schema, dimensions and symbols loaded."""
    wh = Warehouse(spark, _session.scratch_path(spark, name, unique=True))
    wh.init_schema()
    scr = fx.screener(spark, sf_dir)
    wh.load_dimensions(scr)
    wh.load_stock_symbols(scr)
    return wh


@query("carry_forward_last_day", f"""WITH {CANDLES_SQL}, {SCREENER_SQL}, {_DIM_SYMBOLS_SQL}, {_DAY_SQL},
nd AS (SELECT max(trade_date) AS d FROM candles WHERE trade_date < (SELECT d FROM dd)),
nearest AS (SELECT * FROM candles WHERE trade_date = (SELECT d FROM nd)),
rows AS (
  SELECT stock_symbol, o, h, c, l, v, trans AS Trans, t, vwap, trade_date FROM today
  WHERE stock_symbol IN (SELECT stock_symbol FROM dim)
  UNION ALL
  SELECT dim.stock_symbol, n.c, n.c, n.c, n.c, 0, 0, (SELECT min(t) FROM today), n.vwap, (SELECT d FROM dd)
  FROM dim JOIN nearest n ON n.stock_symbol = dim.stock_symbol
  WHERE dim.stock_symbol NOT IN (SELECT stock_symbol FROM today))
SELECT {_FACT_OUT_SQL} FROM rows""")
def carry_forward_last_day(spark, sf_dir):
    """Load the newest day; untraded symbols repeat their close
    of the nearest earlier date in history (the reference's daily step)."""
    bars_ = _candles(spark, sf_dir)
    return _fact_out(cd.load_latest_day(bars_, fx.symbol_dim(spark, sf_dir), bars_))


CARRY_FORWARD_SQL = f"""WITH {CANDLES_SQL}, {SCREENER_SQL}, {_DIM_SYMBOLS_SQL},
known AS (SELECT * FROM candles WHERE stock_symbol IN (SELECT stock_symbol FROM dim)),
days AS (SELECT trade_date, min(t) AS day_t FROM candles GROUP BY trade_date),
firsts AS (SELECT stock_symbol, min(trade_date) AS first_date FROM known GROUP BY stock_symbol),
gaps AS (SELECT f.stock_symbol, d.trade_date, d.day_t FROM firsts f JOIN days d ON d.trade_date > f.first_date
         WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.stock_symbol = f.stock_symbol AND k.trade_date = d.trade_date)),
prior AS (SELECT g.stock_symbol, g.trade_date, g.day_t, k.c, k.vwap,
                 row_number() OVER (PARTITION BY g.stock_symbol, g.trade_date ORDER BY k.trade_date DESC) AS rn
          FROM gaps g JOIN known k ON k.stock_symbol = g.stock_symbol AND k.trade_date < g.trade_date),
rows AS (
  SELECT stock_symbol, o, h, c, l, v, trans AS Trans, t, vwap, trade_date FROM known
  UNION ALL
  SELECT stock_symbol, c, c, c, c, 0, 0, day_t, vwap, trade_date FROM prior WHERE rn = 1)
SELECT {_FACT_OUT_SQL} FROM rows"""


@query("carry_forward_history", CARRY_FORWARD_SQL)
def carry_forward_history(spark, sf_dir):
    """The whole fact with every gap filled (backfill == day-by-day loads)."""
    return _fact_out(cd.carry_forward(_candles(spark, sf_dir), fx.symbol_dim(spark, sf_dir)))


@query("load_candles", f"""WITH {CANDLES_SQL}, {SCREENER_SQL}, {_DIM_SYMBOLS_SQL}, {_DAY_SQL},
known AS (SELECT * FROM candles WHERE stock_symbol IN (SELECT stock_symbol FROM dim)),
last_before AS (SELECT * FROM known WHERE trade_date < (SELECT d FROM dd)
                QUALIFY row_number() OVER (PARTITION BY stock_symbol ORDER BY trade_date DESC) = 1),
rows AS (
  SELECT stock_symbol, o, h, c, l, v, trans AS Trans, t, vwap, trade_date FROM today
  WHERE stock_symbol IN (SELECT stock_symbol FROM dim)
  UNION ALL
  SELECT lb.stock_symbol, lb.c, lb.c, lb.c, lb.c, 0, 0, (SELECT min(t) FROM today), lb.vwap, (SELECT d FROM dd)
  FROM last_before lb WHERE lb.stock_symbol NOT IN (SELECT stock_symbol FROM today))
SELECT {_FACT_OUT_REAL_SQL} FROM rows""")
def load_candles(spark, sf_dir):
    """M4: the job itself - the landed objects of the earlier days are loaded, then the newest
    day's on top (the fill is the last close); the newest day as it is stored."""
    wh = _warehouse(spark, sf_dir, "load-candles")
    landed = landing_src.read_candles(spark, fx.candle_landing(spark, sf_dir))
    newest = landed.agg(F.max("file_date")).first()[0]
    wh.load_candles(landed.where(F.col("file_date") < F.lit(newest)))
    wh.load_candles(landed.where(F.col("file_date") == F.lit(newest)))
    return _fact_out_real(wh.read("candles_FACT").where(F.col("trade_date") == F.lit(newest)))


@query("unknown_tickers", f"""WITH {CANDLES_SQL}, {SCREENER_SQL}, {_DIM_SYMBOLS_SQL}
SELECT stock_symbol, CAST(trade_date AS VARCHAR) AS trade_date, o, h, l, c, v, trans, t
FROM candles WHERE stock_symbol NOT IN (SELECT stock_symbol FROM dim)""")
def unknown_tickers(spark, sf_dir):
    """Bars of tickers missing from the dimension (quarantine)."""
    return cd.unknown_tickers(_candles(spark, sf_dir), fx.symbol_dim(spark, sf_dir)).select(
        "stock_symbol", d2s("trade_date").alias("trade_date"), "o", "h", "l", "c", "v", "trans", "t")


@query("load_guard_new_dates", f"""WITH {CANDLES_SQL},
loaded AS (SELECT * FROM candles WHERE trade_date <= DATE '{fx.LOADED_THROUGH}'),
incoming AS (SELECT * FROM candles WHERE trade_date >= DATE '{fx.INCOMING_FROM}')
SELECT stock_symbol, CAST(trade_date AS VARCHAR) AS trade_date, c FROM incoming
WHERE trade_date NOT IN (SELECT trade_date FROM loaded)""")
def load_guard_new_dates(spark, sf_dir):
    """A re-delivered drop keeps only the dates not loaded yet."""
    bars_ = _candles(spark, sf_dir)
    loaded = bars_.where(F.col("trade_date") <= F.lit(fx.LOADED_THROUGH))
    incoming = bars_.where(F.col("trade_date") >= F.lit(fx.INCOMING_FROM))
    return cd.new_dates_only(incoming, loaded).select(
        "stock_symbol", d2s("trade_date").alias("trade_date"), "c")


@query("epoch_text_to_date", f"""WITH {CANDLES_SQL}
SELECT stock_symbol, t, left(t, 10) AS t_seconds, TRY_CAST(t AS BIGINT) AS t_millis,
       CAST(DATE '1970-01-01' + CAST(floor(TRY_CAST(left(t, 10) AS BIGINT) / 86400) AS INTEGER) AS VARCHAR) AS date_from_seconds,
       CAST(DATE '1970-01-01' + CAST(floor(TRY_CAST(t AS BIGINT) / 86400000) AS INTEGER) AS VARCHAR) AS date_from_millis
FROM candles""")
def epoch_text_to_date(spark, sf_dir):
    """Epoch-ms text -> seconds text -> number -> date, both ways."""
    c = _candles(spark, sf_dir)
    return c.select("stock_symbol", "t",
                    times.epoch_seconds_text("t").alias("t_seconds"),
                    times.text_to_long("t").alias("t_millis"),
                    d2s(times.date_from_epoch_seconds_text("t")).alias("date_from_seconds"),
                    d2s(times.date_from_epoch_millis_text("t")).alias("date_from_millis"))


# =============================== news ===============================

_SRC_KEY_SQL = uuid_key_sql("source_DIM", "source_name")
_TOPIC_KEY_SQL = uuid_key_sql("topic_DIM", "topic")
_SRC_SQL = f"""src AS (SELECT source AS source_name, min(source_domain) AS source_domain FROM news GROUP BY source),
src_dim AS (SELECT {_SRC_KEY_SQL} AS source_id, source_name, source_domain FROM src)"""
_LINES_SQL = "lines AS (SELECT i.* FROM items i WHERE i.l_orderkey IN (SELECT o_orderkey FROM orders))"


def _news_flat(spark, sf_dir, numbered=True):
    return fx.news_flat(spark, sf_dir, numbered=numbered)


@query("new_sources", f"""WITH {NEWS_SQL}, {_SRC_SQL}
SELECT source_id, source_name, source_domain FROM src_dim
WHERE source_name NOT IN (SELECT source_name FROM src_dim WHERE source_name < '{fx.CURRENT_SOURCES_BELOW}')""")
def new_sources(spark, sf_dir):
    """Sources of the feed not in source_DIM yet (anti join on the name)."""
    flat = _news_flat(spark, sf_dir, numbered=False)
    current = ns.sources(flat).where(F.col("source_name") < fx.CURRENT_SOURCES_BELOW)
    return ns.new_sources(flat, current)


@query("new_topics", f"""WITH {ITEMS_SQL}, {_LINES_SQL}
SELECT DISTINCT {_TOPIC_KEY_SQL} AS topic_id, topic AS topic_name FROM lines
WHERE topic IS NOT NULL AND topic NOT IN (SELECT DISTINCT topic FROM lines WHERE topic < '{fx.CURRENT_TOPICS_BELOW}')""")
def new_topics(spark, sf_dir):
    """Topics exploded from the nested arrays, distinct, not yet known."""
    n = fx.news(spark, sf_dir)
    current = ns.topics(n).where(F.col("topic_name") < fx.CURRENT_TOPICS_BELOW)
    return ns.new_topics(n, current)


@query("news_numbered", f"""WITH {NEWS_SQL}
SELECT CAST(file_date AS VARCHAR) AS file_date, in_date_id, title, url FROM news""")
def news_numbered(spark, sf_dir):
    """Items numbered 0..n-1 within their file day, in a declared total order."""
    return _news_flat(spark, sf_dir).select(d2s("file_date").alias("file_date"), "in_date_id", "title", "url")


@query("news_day_slice", f"""WITH {NEWS_SQL}
SELECT CAST(file_date + 2 AS VARCHAR) AS run_date, CAST(file_date AS VARCHAR) AS extract_day,
       strftime(file_date, '%Y%m%d') || 'T0000' AS time_from, strftime(file_date, '%Y%m%d') || 'T2359' AS time_to,
       title, url
FROM news""")
def news_day_slice(spark, sf_dir):
    """Each run's extraction window (published on run date - 2)."""
    sl = ns.day_slice(_news_flat(spark, sf_dir, numbered=False), lag_days=2)
    return sl.select(d2s("run_date").alias("run_date"), d2s("extract_day").alias("extract_day"),
                     "time_from", "time_to", "title", "url")


@query("news_run_slices", f"""WITH {NEWS_SQL}
SELECT CAST(file_date + 2 AS VARCHAR) AS run_date, CAST(file_date AS VARCHAR) AS extract_day,
       strftime(file_date, '%Y%m%d') || 'T0000' AS time_from, strftime(file_date, '%Y%m%d') || 'T2359' AS time_to,
       title, url
FROM news WHERE day(file_date + 2) IN (1, 15)""")
def news_run_slices(spark, sf_dir):
    """The extraction windows of given run dates (the first and fifteenth of each month with orders)."""
    flat = _news_flat(spark, sf_dir, numbered=False)
    runs = flat.select(ns.insert_date().alias("run_date")).distinct().where(F.dayofmonth("run_date").isin(1, 15))
    sl = ns.day_slice(flat, lag_days=2, run_dates=runs)
    return sl.select(d2s("run_date").alias("run_date"), d2s("extract_day").alias("extract_day"),
                     "time_from", "time_to", "title", "url")


@query("news_publish_date", f"""WITH {NEWS_SQL}
SELECT title, time_published,
       CAST(CAST(strptime(left(time_published, 8), '%Y%m%d') AS DATE) AS VARCHAR) AS time_publish_id,
       CAST(file_date + 2 AS VARCHAR) AS insert_date,
       CAST(file_date - 2 AS VARCHAR) AS lag_date,
       strftime(file_date, '%Y%m%d') || 'T0000' AS time_from,
       'news_' || CAST(file_date AS VARCHAR) || '.json' AS object,
       CAST(CAST(substr('news_' || CAST(file_date AS VARCHAR) || '.json', 6, 10) AS DATE) AS VARCHAR) AS object_date
FROM news""")
def news_publish_date(spark, sf_dir):
    """Publish text -> date, insert date = file date + 2, lag, vendor
    time_from text, object name and the date read back out of it."""
    f = _news_flat(spark, sf_dir, numbered=False)
    obj = times.object_name("news", "file_date")
    return f.select("title", "time_published",
                    d2s(times.publish_date("time_published")).alias("time_publish_id"),
                    d2s(ns.insert_date("file_date")).alias("insert_date"),
                    d2s(F.date_sub("file_date", 2)).alias("lag_date"),
                    times.compact_day_text("file_date", "T0000").alias("time_from"),
                    obj.alias("object"),
                    d2s(times.object_date(obj)).alias("object_date"))


NEWS_DIM_SQL = f"""WITH {NEWS_SQL}, {_SRC_SQL}
SELECT CAST(n.file_date + 2 AS VARCHAR) AS insert_date, n.in_date_id, n.title, n.url,
       CAST(CAST(strptime(left(n.time_published, 8), '%Y%m%d') AS DATE) AS VARCHAR) AS time_publish_id,
       s.source_id, n.overall_sentiment_score
FROM news n LEFT JOIN src_dim s ON n.source = s.source_name"""


def _news_dim_out(df):
    return df.select(d2s("insert_date").alias("insert_date"), "in_date_id", "title", "url",
                     d2s("time_publish_id").alias("time_publish_id"), "source_id",
                     F.col("overall_sentiment_score").cast("double").alias("overall_sentiment_score"))


@query("news_dim", NEWS_DIM_SQL)
def news_dim(spark, sf_dir):
    """news_DIM rows with the source id looked up by name."""
    flat = _news_flat(spark, sf_dir)
    return _news_dim_out(ns.news_rows(flat, ns.sources(flat)))


@query("source_fanout", f"""WITH {NEWS_SQL},
fan AS (SELECT DISTINCT o_orderpriority AS source_name, o_orderstatus AS source_domain FROM orders)
SELECT CAST(n.file_date + 2 AS VARCHAR) AS insert_date, n.in_date_id, n.title,
       {uuid_key_sql("source_DIM", "fan.source_name")} AS source_id, fan.source_domain
FROM news n LEFT JOIN fan ON n.source = fan.source_name""")
def source_fanout(spark, sf_dir):
    """T5: deduplicating sources on (name, domain) but looking them up by name
    multiplies a news item by the number of domains of its source."""
    flat = _news_flat(spark, sf_dir)
    orders = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("source"), F.col("o_orderstatus").alias("source_domain"))
    fan = ns.sources(orders, one_per_name=False)
    src = fan.select("source_id", "source_name", F.col("source_domain").alias("fan_domain"))
    return (flat.join(src, F.col("source") == F.col("source_name"), "left")
            .select(d2s(ns.insert_date("file_date")).alias("insert_date"), "in_date_id", "title",
                    "source_id", F.col("fan_domain").alias("source_domain")))


TOPIC_FACT_SQL = f"""WITH {NEWS_SQL}, {ITEMS_SQL}
SELECT CAST(n.file_date + 2 AS VARCHAR) AS insert_date, n.in_date_id, {_TOPIC_KEY_SQL} AS topic_id,
       round(i.relevance, 6) AS sentiment_score
FROM news n JOIN items i ON i.l_orderkey = n.o_orderkey"""


def _fact_scores(df, key):
    return df.select(d2s("insert_date").alias("insert_date"), "in_date_id", key,
                     r6("sentiment_score").alias("sentiment_score"))


@query("topic_sentiment_fact", TOPIC_FACT_SQL)
def topic_sentiment_fact(spark, sf_dir):
    """One fact per topic element; the score is the relevance."""
    n = fx.news(spark, sf_dir)
    return _fact_scores(ns.topic_facts(n, ns.topics(n)), "topic_id")


STOCK_FACT_SQL = f"""WITH {NEWS_SQL}, {ITEMS_SQL}, {SCREENER_SQL}
SELECT CAST(n.file_date + 2 AS VARCHAR) AS insert_date, n.in_date_id, i.ticker AS stock_symbol,
       round(i.ticker_score, 6) AS sentiment_score
FROM news n JOIN items i ON i.l_orderkey = n.o_orderkey
WHERE i.ticker IN (SELECT Symbol FROM screener)"""


@query("stock_sentiment_fact", STOCK_FACT_SQL)
def stock_sentiment_fact(spark, sf_dir):
    """One fact per ticker element of a known symbol."""
    n = fx.news(spark, sf_dir)
    return _fact_scores(ns.stock_facts(n, fx.symbol_dim(spark, sf_dir)), "stock_symbol")


_ROUNDTRIP_SQL = f"""WITH {NEWS_SQL}, {ITEMS_SQL},
agg AS (SELECT l_orderkey, count(*) AS n, sum(relevance) AS rs, sum(ticker_score) AS ts FROM items GROUP BY l_orderkey)
SELECT n.in_date_id, n.title, n.url, n.time_published, n.source, n.source_domain,
       n.overall_sentiment_score,
       agg.n AS n_topics, agg.n AS n_tickers, round(agg.rs, 6) AS relevance_sum, round(agg.ts, 6) AS ticker_score_sum
FROM news n LEFT JOIN agg ON agg.l_orderkey = n.o_orderkey"""


def _nested_summary(df):
    def total(arr, field):
        return F.aggregate(F.col(arr), F.lit(0.0).cast("double"),
                           lambda acc, x: acc + x[field].try_cast("double"))
    return df.select(
        "in_date_id", "title", "url", "time_published", "source", "source_domain",
        "overall_sentiment_score",
        F.when(F.col("topics").isNotNull(), F.size("topics")).cast("long").alias("n_topics"),
        F.when(F.col("ticker_sentiment").isNotNull(), F.size("ticker_sentiment")).cast("long").alias("n_tickers"),
        r6(total("topics", "relevance_score")).alias("relevance_sum"),
        r6(total("ticker_sentiment", "ticker_sentiment_score")).alias("ticker_score_sum"))


@query("news_json_roundtrip", _ROUNDTRIP_SQL)
def news_json_roundtrip(spark, sf_dir):
    """News rows -> JSON text -> typed columns with the declared schema."""
    n = fx.news(spark, sf_dir)
    fields = [f.name for f in schemas.NEWS_RAW.fields if f.name != schemas.CORRUPT]
    text = n.select(F.to_json(F.struct(*fields)).alias("value"))
    back = text.select(F.from_json("value", schemas.NEWS_RAW).alias("j")).select("j.*")
    return _nested_summary(back)


@query("land_news", f"""WITH {NEWS_SQL}, {ITEMS_SQL},
agg AS (SELECT l_orderkey, count(*) AS n FROM items GROUP BY l_orderkey),
ranked AS (SELECT *, row_number() OVER (PARTITION BY file_date ORDER BY time_published, url, title) AS rk FROM news)
SELECT CAST(n.file_date AS VARCHAR) AS file_date, 'news_' || CAST(n.file_date AS VARCHAR) || '.json' AS object,
       n.rk - 1 AS in_date_id, n.title, agg.n AS n_topics, agg.n AS n_tickers
FROM ranked n LEFT JOIN agg ON agg.l_orderkey = n.o_orderkey""")
def land_news(spark, sf_dir):
    """Each day's extraction slice,
    numbered in the feed order, landed as one NDJSON object per day, read back."""
    base = _session.scratch_path(spark, "land-news", unique=True)
    landing_jobs.land_news(fx.news_feed(spark, sf_dir), base)
    back = landing_src.read_news(spark, base)
    return back.select(d2s("file_date").alias("file_date"), "object", "in_date_id", "title",
                       F.when(F.col("topics").isNotNull(), F.size("topics")).cast("long").alias("n_topics"),
                       F.when(F.col("ticker_sentiment").isNotNull(), F.size("ticker_sentiment"))
                       .cast("long").alias("n_tickers"))


@query("land_candles", f"""WITH {CANDLES_SQL}
SELECT stock_symbol AS ticker, CAST(trade_date AS VARCHAR) AS file_date, 'OHCL_' || CAST(trade_date AS VARCHAR) || '.json' AS object,
       o, h, l, c, CAST(v AS DOUBLE) AS v, round(vwap, 6) AS vwap, t AS time, trans
FROM candles""")
def land_candles(spark, sf_dir):
    """Land daily bars as one NDJSON object per day, read back."""
    base = _session.scratch_path(spark, "land-candles", unique=True)
    landing_jobs.land_candles(fx.table(spark, sf_dir, "events"), base, symbol=fx.symbol_of("user_id"),
                              ts="ts", price="value", size=F.round(F.col("value") * 100).cast("bigint"),
                              tiebreak="event_id")
    back = landing_src.read_candles(spark, base)
    return back.select("ticker", d2s("file_date").alias("file_date"), "object", "o", "h", "l", "c", "v",
                       r6("vwap").alias("vwap"), "time", "trans")


@query("candle_scan_projection", f"""WITH {CANDLES_SQL}, {SCREENER_SQL}
SELECT c.stock_symbol, c.o, c.h, c.c, c.l, CAST(c.v AS BIGINT) AS v, c.trans AS Trans, c.t,
       round(c.vwap, 6) AS vwap, s.Name AS stock_symbol_name
FROM candles c LEFT JOIN screener s ON s.Symbol = c.stock_symbol""")
def candle_scan_projection(spark, sf_dir):
    """Scan the landed candle objects with the declared schema, rename to
    the fact's names, and look up the name in a two-column projection of the dimension."""
    raw = landing_src.read_candles(spark, fx.candle_landing(spark, sf_dir))
    dim2 = fx.symbol_dim(spark, sf_dir).select("stock_symbol", "stock_symbol_name")
    return (raw.select(F.col("ticker").alias("stock_symbol"), "o", "h", "c", "l",
                       F.col("v").try_cast("bigint").alias("v"), F.col("trans").alias("Trans"),
                       F.col("time").alias("t"), r6("vwap").alias("vwap"))
            .join(dim2, "stock_symbol", "left"))


# =============================== composite jobs ===============================

_LOAD_NEWS_SQL = f"""WITH {NEWS_SQL}, {ITEMS_SQL}, {SCREENER_SQL}, {_LINES_SQL},
src AS (SELECT source AS source_name, min(source_domain) AS source_domain FROM news GROUP BY source),
topics AS (SELECT DISTINCT topic FROM lines WHERE topic IS NOT NULL)
SELECT 'source_DIM' AS output, CAST(NULL AS VARCHAR) AS insert_date, CAST(NULL AS BIGINT) AS in_date_id,
       {_SRC_KEY_SQL} AS key, source_name AS name, CAST(NULL AS DOUBLE) AS score
FROM src WHERE source_name >= '{fx.CURRENT_SOURCES_BELOW}'
UNION ALL
SELECT 'topic_DIM', NULL, NULL, {_TOPIC_KEY_SQL}, topic, NULL FROM topics WHERE topic >= '{fx.CURRENT_TOPICS_BELOW}'
UNION ALL
SELECT 'news_DIM', CAST(n.file_date + 2 AS VARCHAR), n.in_date_id,
       {uuid_key_sql("source_DIM", "n.source")}, n.title, n.overall_sentiment_score FROM news n
UNION ALL
SELECT 'new_sentiment_industry_FACT', CAST(n.file_date + 2 AS VARCHAR), n.in_date_id, {_TOPIC_KEY_SQL},
       NULL, round(i.relevance, 6) FROM news n JOIN items i ON i.l_orderkey = n.o_orderkey
UNION ALL
SELECT 'new_sentiment_stock_FACT', CAST(n.file_date + 2 AS VARCHAR), n.in_date_id, i.ticker, NULL,
       round(i.ticker_score, 6) FROM news n JOIN items i ON i.l_orderkey = n.o_orderkey
WHERE i.ticker IN (SELECT Symbol FROM screener)"""


@query("load_news", _LOAD_NEWS_SQL)
def load_news(spark, sf_dir):
    """M6: the job itself, every landed day at once - new sources, new topics, news items, topic
    facts and stock facts, tagged by output table and unioned."""
    n = fx.news(spark, sf_dir).drop("o_orderkey")
    wh = _warehouse(spark, sf_dir, "load-news")
    known_sources = ns.sources(_news_flat(spark, sf_dir, numbered=False)).where(F.col("source_name") < fx.CURRENT_SOURCES_BELOW).checkpoint()
    known_topics = ns.topics(n).where(F.col("topic_name") < fx.CURRENT_TOPICS_BELOW).checkpoint()
    wh.append("source_DIM", known_sources)
    wh.append("topic_DIM", known_topics)
    wh.load_news(n)
    return _news_tables(wh, known_sources, known_topics)


def _news_tables(wh: Warehouse, known_sources: DataFrame | None = None, known_topics: DataFrame | None = None) -> DataFrame:
    """The five news tables, tagged by name and unioned, without members that were known before."""
    def tag(df, out, insert_date, in_date_id, key, name, score):
        return df.select(F.lit(out).alias("output"), insert_date.alias("insert_date"),
                         in_date_id.cast("long").alias("in_date_id"), key.alias("key"),
                         name.alias("name"), score.alias("score"))
    none_s, none_l, none_d = F.lit(None).cast("string"), F.lit(None).cast("long"), F.lit(None).cast("double")
    sources, topics = wh.read("source_DIM"), wh.read("topic_DIM")
    if known_sources is not None:
        sources, topics = sources.join(known_sources, "source_id", "left_anti"), topics.join(known_topics, "topic_id", "left_anti")
    day, number = d2s("insert_date"), F.col("in_date_id")
    parts = [
        tag(sources, "source_DIM", none_s, none_l, F.col("source_id"), F.col("source_name"), none_d),
        tag(topics, "topic_DIM", none_s, none_l, F.col("topic_id"), F.col("topic_name"), none_d),
        tag(wh.read("news_DIM"), "news_DIM", day, number, F.col("source_id"), F.col("title"), F.col("overall_sentiment_score")),
        tag(wh.read("new_sentiment_industry_FACT"), "new_sentiment_industry_FACT", day, number, F.col("topic_id"), none_s, r6("sentiment_score")),
        tag(wh.read("new_sentiment_stock_FACT"), "new_sentiment_stock_FACT", day, number, F.col("stock_symbol"), none_s, r6("sentiment_score")),
    ]
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


@query("union_all_literals", f"""WITH {CANDLES_SQL},
id_model AS (SELECT trans AS id FROM candles UNION ALL SELECT NULL AS id)
SELECT 'id_equals_one' AS model, id FROM id_model WHERE id = 1
UNION ALL
SELECT 'id_not_null' AS model, id FROM id_model WHERE id IS NOT NULL""")
def union_all_literals(spark, sf_dir):
    """A model made of a relation UNION ALL a literal
    null row, materialised as a view, and models that refer to it by name
    (``select * ... where id = 1`` / ``where id is not null``)."""
    first = _candles(spark, sf_dir).select(F.col("trans").cast("long").alias("id")).unionByName(
        spark.sql("SELECT CAST(NULL AS BIGINT) AS id"))
    models.materialize_view(first, "id_model")
    equals_one = models.filtered_model(spark, "id_model", "id = 1")
    not_null = models.filtered_model(spark, "id_model", "id IS NOT NULL")
    return (equals_one.select(F.lit("id_equals_one").alias("model"), "id")
            .unionByName(not_null.select(F.lit("id_not_null").alias("model"), "id")))


_UNIQUE_CANDLE = "stock_symbol || '@' || CAST(trade_date AS STRING)"
_UNIQUE_NEWS = "CAST(insert_date AS STRING) || '#' || CAST(in_date_id AS STRING)"


def _unique_sql(model, column, rel, expr):
    return (f"SELECT '{model}' AS model, '{column}' AS column_name, 'unique' AS test, count(*) AS failures "
            f"FROM (SELECT {expr} AS v FROM {rel} WHERE {expr} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")


@query("data_test_unique", f"""WITH {CANDLES_SQL}, {SCREENER_SQL}, {NEWS_SQL}
{_unique_sql('stock_symbol_DIM', 'stock_symbol', 'screener', 'Symbol')}
UNION ALL {_unique_sql('candles_FACT', 'stock_symbol', 'candles', 'stock_symbol')}
UNION ALL {_unique_sql('candles_FACT', _UNIQUE_CANDLE.replace("'", "''"), 'candles', "stock_symbol || '@' || CAST(trade_date AS VARCHAR)")}
UNION ALL {_unique_sql('news_DIM', _UNIQUE_NEWS.replace("'", "''"), 'news', "CAST(file_date + 2 AS VARCHAR) || '#' || CAST(in_date_id AS VARCHAR)")}
UNION ALL {_unique_sql('news_DIM', 'source', 'news', 'source')}""")
def data_test_unique(spark, sf_dir):
    """``unique`` tests on warehouse keys (failures = duplicated values)."""
    flat = _news_flat(spark, sf_dir)
    news_dim_rows = ns.news_rows(flat, ns.sources(flat))
    return quality.run_data_tests([
        ("stock_symbol_DIM", fx.symbol_dim(spark, sf_dir), "unique", ["stock_symbol"]),
        ("candles_FACT", _candles(spark, sf_dir), "unique", ["stock_symbol", _UNIQUE_CANDLE]),
        ("news_DIM", news_dim_rows, "unique", [_UNIQUE_NEWS]),
        ("news_DIM", flat, "unique", ["source"]),
    ])


def _not_null_sql(model, rel, cols):
    return " UNION ALL ".join(
        f"SELECT '{model}' AS model, '{c}' AS column_name, 'not_null' AS test, "
        f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS failures FROM {rel}" for c in cols)


@query("data_test_not_null", f"""WITH {CANDLES_SQL}, {SCREENER_SQL},
ids AS (SELECT {uuid_key_sql('country_DIM', "coalesce(Country, 'unpredict')")} AS country_id,
               {uuid_key_sql('sector_DIM', "coalesce(Sector, 'unpredict')")} AS sector_id,
               {uuid_key_sql('industry_DIM', "coalesce(Industry, 'unpredict')")} AS industry_id FROM screener)
{_not_null_sql('candles_FACT', 'candles', ['o', 'h', 'l', 'c', 'v', 'vwap', 't'])}
UNION ALL {_not_null_sql('screener', 'screener', ['Symbol', 'Country', 'Sector', 'Industry'])}
UNION ALL {_not_null_sql('stock_symbol_DIM', 'ids', ['country_id', 'sector_id', 'industry_id'])}""")
def data_test_not_null(spark, sf_dir):
    """``not_null`` tests, of the fact from the null counts that its load keeps, of other
    relations all columns in one scan (a member id left null by a failed lookup is reported, never written as text)."""
    return quality.not_null_from_days("candles_FACT", _days(spark, sf_dir), ["o", "h", "l", "c", "v", "vwap", "t"]).unionByName(quality.run_data_tests([
        ("screener", fx.screener(spark, sf_dir), "not_null", ["Symbol", "Country", "Sector", "Industry"]),
        ("stock_symbol_DIM", fx.symbol_dim(spark, sf_dir), "not_null",
         ["country_id", "sector_id", "industry_id"]),
    ]))


_PASSTHROUGH = """SELECT f.stock_symbol, d.stock_symbol_name, count(*) AS n_days,
       round(avg(CAST({c} AS DOUBLE)), 6) AS avg_c, round(CAST(max({h}) AS DOUBLE), 6) AS max_h,
       sum(CASE WHEN {from_millis} = f.trade_date AND {from_seconds} = f.trade_date THEN 1 ELSE 0 END) AS n_dated
FROM candles_FACT f JOIN stock_symbol_DIM d ON d.stock_symbol = f.stock_symbol
GROUP BY f.stock_symbol, d.stock_symbol_name"""


@query("sql_passthrough", f"""WITH {CANDLES_SQL}, {SCREENER_SQL},
candles_FACT AS (SELECT * FROM candles),
stock_symbol_DIM AS (SELECT Symbol AS stock_symbol, Name AS stock_symbol_name FROM screener)
""" + _PASSTHROUGH.format(c="CAST(f.c AS REAL)", h="CAST(f.h AS REAL)",
                          from_millis="(DATE '1970-01-01' + CAST(floor(TRY_CAST(f.t AS BIGINT) / 86400000) AS INTEGER))",
                          from_seconds="(DATE '1970-01-01' + CAST(floor(TRY_CAST(left(f.t, 10) AS BIGINT) / 86400) AS INTEGER))"))
def sql_passthrough(spark, sf_dir):
    """Arbitrary SQL text over the warehouse tables under their names, with the
    date rules as SQL functions."""
    wh = _warehouse(spark, sf_dir, "sql-passthrough")
    wh.replace_partitions("candles_FACT", _candles(spark, sf_dir).withColumnRenamed("trans", "Trans").withColumn("filled", F.lit(False)))
    return wh.sql(_PASSTHROUGH.format(c="f.c", h="f.h", from_millis="date_from_epoch_millis(f.t)", from_seconds="date_from_epoch_seconds(f.t)"))


@query("co_located_join", f"""WITH {CANDLES_SQL}, {SCREENER_SQL}
SELECT c.stock_symbol, s.Name AS stock_symbol_name, count(*) AS n_days, sum(c.v)::BIGINT AS volume, CAST(max(c.trade_date) AS VARCHAR) AS last_date
FROM candles c JOIN screener s ON s.Symbol = c.stock_symbol GROUP BY c.stock_symbol, s.Name""")
def co_located_join(spark, sf_dir):
    """Facts and symbols written in buckets of the symbol, joined and grouped by it without a shuffle."""
    wh = Warehouse(spark, _session.scratch_path(spark, "co-located", unique=True))
    stored = wh.co_located({"candles": _candles(spark, sf_dir).select("stock_symbol", "v", "trade_date"),
                            "symbols": fx.symbol_dim(spark, sf_dir).select("stock_symbol", "stock_symbol_name")}, buckets=8,
                           prefix="co_located_" + wh.root.rsplit("/", 1)[-1] + "_")
    joined = stored["candles"].hint("merge").join(stored["symbols"], "stock_symbol")
    return joined.groupBy("stock_symbol", "stock_symbol_name").agg(
        F.count(F.lit(1)).alias("n_days"), F.sum("v").cast("long").alias("volume"), d2s(F.max("trade_date")).alias("last_date"))


@query("date_dim", f"""WITH {CANDLES_SQL}
SELECT strftime(d, '%Y%m%d') AS date_id, CAST(CAST(d AS DATE) AS VARCHAR) AS date
FROM (SELECT unnest(generate_series(min(trade_date), max(trade_date), INTERVAL 1 DAY)) AS d FROM candles)""")
def date_dim(spark, sf_dir):
    """The calendar dimension over the loaded trade dates."""
    return dm.calendar(_candles(spark, sf_dir)).select("date_id", d2s("date").alias("date"))


@query("landing_audit", f"""WITH {CANDLES_SQL}, {NEWS_SQL},
o AS (SELECT 'candles' AS bucket, 'OHCL_' AS prefix, trade_date AS d, count(*) AS n FROM candles GROUP BY trade_date
      UNION ALL SELECT 'news', 'news_', file_date, count(*) FROM news GROUP BY file_date)
SELECT bucket, prefix || CAST(d AS VARCHAR) || '.json' AS object, CAST(d AS VARCHAR) AS file_date, 1 AS files, TRUE AS has_bytes, n AS rows,
       d = max(d) OVER (PARTITION BY bucket) AS is_newest FROM o""")
def landing_audit(spark, sf_dir):
    """Per landing object its date, files, whether it has bytes, rows, and which object
    is the newest (the drops carry the time of their day)."""
    parts = []
    for bucket, path in (("candles", fx.candle_landing(spark, sf_dir)),
                         ("news", fx.news_landing(spark, sf_dir))):
        incremental.order_landing_by_day(spark, path)
        listing = landing_src.objects(spark, path)
        newest = landing_src.newest_object(listing).select(F.col("object").alias("_newest"))
        parts.append(listing.join(F.broadcast(newest), F.col("object") == F.col("_newest"), "left")
                     .select(F.lit(bucket).alias("bucket"), "object", d2s("file_date").alias("file_date"),
                             "files", (F.col("bytes") > 0).alias("has_bytes"), "rows", F.col("_newest").isNotNull().alias("is_newest")))
    return parts[0].unionByName(parts[1])


@query("insert_select", OHCL_INDICATOR_SQL)
def insert_select(spark, sf_dir):
    """Write the indicator to its table by column name
    (partitioned by date, sorted by the sort key), twice - a re-run replaces its
    date partition; skip the write when there is nothing to write; expose the
    table as a model (view) and insert-select it into another table; read back."""
    wh = Warehouse(spark, _session.scratch_path(spark, "insert-select", unique=True))
    sink_tables.create_if_missing(spark, wh.path("ohcl_indicator"), "ohcl_indicator")
    rows = indicators.ohcl_indicator(_candles(spark, sf_dir), days=_days(spark, sf_dir))
    for _ in range(2):
        if not rows.isEmpty():
            wh.replace_partitions("ohcl_indicator", rows)
    back = wh.read("ohcl_indicator")
    models.materialize_view(back, "ohcl_indicator_model")
    models.insert_select(spark, wh.path("ohcl_indicator_copy"), "ohcl_indicator_model")
    copy = spark.read.parquet(wh.path("ohcl_indicator_copy"))
    return copy.select("stock_symbol", "date", r6("delta").alias("delta"),
                       r6("sliding_avg_3").alias("sliding_avg_3"), r6("sliding_avg_5").alias("sliding_avg_5"))


def _init_schema_sql() -> str:
    counts = {
        "industry_DIM": "(SELECT count(DISTINCT coalesce(Industry, 'unpredict')) FROM screener)",
        "exchange_DIM": "3",
        "country_DIM": "(SELECT count(DISTINCT coalesce(Country, 'unpredict')) FROM screener)",
        "sector_DIM": "(SELECT count(DISTINCT coalesce(Sector, 'unpredict')) FROM screener)",
        "stock_symbol_DIM": "(SELECT count(DISTINCT Symbol) FROM screener)",
    }
    rows = [f"SELECT '{t}' AS table_name, CAST({len(m['schema'].fields)} AS BIGINT) AS n_columns, "
            f"CAST({counts.get(t, '0')} AS BIGINT) AS n_rows" for t, m in schemas.TABLES.items()]
    return f"WITH {SCREENER_SQL}\n" + "\nUNION ALL ".join(rows)


@query("init_schema", _init_schema_sql())
def init_schema(spark, sf_dir):
    """Create the 16 tables, reseed exchanges, append unseen
    dimension members (column subset + generated key) and symbols from the
    screener - twice, the loads are re-runnable; list the catalog with row counts."""
    wh = Warehouse(spark, _session.scratch_path(spark, "init-schema", unique=True))
    scr = fx.screener(spark, sf_dir)
    for _ in range(2):
        wh.init_schema()
        wh.load_dimensions(scr)
        wh.load_stock_symbols(scr)
    return wh.catalog()


@query("incremental_candles", CARRY_FORWARD_SQL.replace(f"SELECT {_FACT_OUT_SQL} FROM rows",
                                                        f"SELECT {_FACT_OUT_REAL_SQL} FROM rows"))
def incremental_candles(spark, sf_dir):
    """K1 K3 K4 M4: stream the daily candle objects (8 days per micro-batch, availableNow)
    into the warehouse; the final fact equals the one-shot carry-forward."""
    wh = _warehouse(spark, sf_dir, "incremental-candles")
    landing = fx.candle_landing(spark, sf_dir)
    incremental.order_landing_by_day(spark, landing)
    incremental.ingest_candles(spark, wh, landing, checkpoint=wh.root + "/_checkpoints/candles",
                               quarantine_dir=wh.root + "/_quarantine", max_files=8)
    return _fact_out_real(wh.read("candles_FACT"))


@query("incremental_news", _LOAD_NEWS_SQL.replace(f" WHERE source_name >= '{fx.CURRENT_SOURCES_BELOW}'", "")
       .replace(f"\nFROM src WHERE source_name >= '{fx.CURRENT_SOURCES_BELOW}'", "\nFROM src")
       .replace(f" WHERE topic >= '{fx.CURRENT_TOPICS_BELOW}'", ""))
def incremental_news(spark, sf_dir):
    """K2 M6: stream the daily news objects into the warehouse; the five tables equal
    the one-shot load."""
    wh = _warehouse(spark, sf_dir, "incremental-news")
    landing = fx.news_landing(spark, sf_dir)
    incremental.ingest_news(spark, wh, landing, checkpoint=wh.root + "/_checkpoints/news", max_files=1024)
    return _news_tables(wh)


@query("moving_average_tables", CARRY_FORWARD_SQL.replace(f"SELECT {_FACT_OUT_SQL} FROM rows", """, f AS (
  SELECT stock_symbol, t, trade_date, CAST(CAST(c AS REAL) AS DOUBLE) AS c, CAST(v AS DOUBLE) AS v FROM rows),
m AS (SELECT stock_symbol, t, trade_date,
             avg(c) OVER (PARTITION BY stock_symbol ORDER BY trade_date ROWS 2 PRECEDING) AS short_ma,
             avg(c) OVER (PARTITION BY stock_symbol ORDER BY trade_date ROWS 4 PRECEDING) AS long_ma,
             avg(v) OVER (PARTITION BY stock_symbol ORDER BY trade_date ROWS 4 PRECEDING) AS volume FROM f)
SELECT 'shot_MA' AS output, stock_symbol, t, CAST(trade_date AS VARCHAR) AS date, round(short_ma, 6) AS value FROM m
UNION ALL SELECT 'long_MA', stock_symbol, t, CAST(trade_date AS VARCHAR), round(long_ma, 6) FROM m
UNION ALL SELECT 'avg_volume', stock_symbol, NULL, CAST(trade_date AS VARCHAR), round(CAST(CAST(volume AS REAL) AS DOUBLE), 6) FROM m"""))
def moving_average_tables(spark, sf_dir):
    """The three tables as the job fills them - all days, and then again the days from the
    middle one on, with the days before them as the windows need."""
    wh = _warehouse(spark, sf_dir, "moving-averages")
    wh.load_candles(landing_src.read_candles(spark, fx.candle_landing(spark, sf_dir)))
    wh.compute_moving_averages()
    middle = wh.days().agg(F.percentile_approx(F.unix_date("trade_date"), 0.5)).first()[0]
    wh.compute_moving_averages(since=times.date_of_day_number(middle))
    none = F.lit(None).cast("string")
    parts = [wh.read(t).select(F.lit(t).alias("output"), "stock_symbol", stamp.alias("t"), d2s(day).alias("date"), r6(value).alias("value"))
             for t, stamp, day, value in (("shot_MA", F.col("t"), "trade_date", "ma"), ("long_MA", F.col("t"), "trade_date", "ma"),
                                          ("avg_volume", none, "date", "sliding_avg"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("object_ledger", f"""WITH {CANDLES_SQL}, {SCREENER_SQL},
d AS (SELECT trade_date, count(*) AS n, count(*) FILTER (WHERE stock_symbol IN (SELECT Symbol FROM screener)) AS known FROM candles GROUP BY trade_date)
SELECT 'OHCL_' || CAST(trade_date AS VARCHAR) || '.json' AS object, 1 AS delivery, n AS rows_in, known AS loaded, n - known AS quarantined, 0 AS equal FROM d
UNION ALL
SELECT 'OHCL_' || CAST(trade_date AS VARCHAR) || '.json', 2, n, 0, n - known, known FROM d WHERE trade_date >= DATE '{fx.INCOMING_FROM}'""")
def object_ledger(spark, sf_dir):
    """Every landed object is read once; objects delivered again are read again, and found
    equal; what became of each one's rows. A third run finds nothing to read."""
    from candleworks.plans import ledger
    from candleworks.sinks import landing as landing_sink

    wh = _warehouse(spark, sf_dir, "object-ledger")
    base = wh.root + "/_drop"
    landed = bars.to_landing_rows(fx.candles(spark, sf_dir))
    landing_sink.write_daily_json(landed, base, "OHCL", "trade_date")
    ledger.ingest(wh, "candles", base, wh.root + "/_quarantine")
    landing_sink.write_daily_json(landed.where(F.col("trade_date") >= F.lit(fx.INCOMING_FROM)), base, "OHCL", "trade_date")
    ledger.ingest(wh, "candles", base, wh.root + "/_quarantine")
    if ledger.ingest(wh, "candles", base, wh.root + "/_quarantine"):
        raise RuntimeError("an unchanged object was read again")
    per_object = ledger.entries(wh).groupBy("object", "file").agg(F.max("modified").alias("modified"), *[F.sum(c).alias(c) for c in ("rows_in", "loaded", "quarantined", "equal")])
    turn = F.row_number().over(Window.partitionBy("object").orderBy("modified", "file"))
    return per_object.select("object", turn.alias("delivery"), "rows_in", "loaded", "quarantined", "equal")


@query("quarantine_candles", f"""WITH {CANDLES_SQL}, {SCREENER_SQL}
SELECT 'OHCL_' || CAST(trade_date AS VARCHAR) || '.json' AS object, 'malformed' AS reason, NULL AS ticker, NULL AS time,
       left('{{"ticker":"' || stock_symbol || '"', {fx.CUT_AT}) AS raw FROM candles WHERE trans = 3
UNION ALL
SELECT 'OHCL_' || CAST(trade_date AS VARCHAR) || '.json', 'unknown_ticker', stock_symbol, t, NULL FROM candles
WHERE trans <> 3 AND stock_symbol NOT IN (SELECT Symbol FROM screener)""")
def quarantine_candles(spark, sf_dir):
    """What the load wrote to quarantine - lines that can't be parsed, as their text, and
    rows of unknown tickers - read back."""
    wh = _warehouse(spark, sf_dir, "quarantine-candles")
    landed = landing_src.read_candles(spark, fx.candle_lines(spark, sf_dir, wh.root + "/_drop"))
    wh.load_candles(landed, wh.root + "/_quarantine", "drop")
    back = spark.read.schema("ticker string, time string, reason string, raw string, landed_as string").json(wh.root + "/_quarantine")
    return back.select(F.col("landed_as").alias("object"), "reason", "ticker", "time", "raw")


@query("quarantine_news", f"""WITH {NEWS_SQL}
SELECT 'news_' || CAST(file_date AS VARCHAR) || '.json' AS object, 'malformed' AS reason, NULL AS title, left('{{"title":"' || title || '"', {fx.CUT_AT}) AS raw
FROM news WHERE o_orderkey % 11 = 0
UNION ALL
SELECT 'news_' || CAST(file_date AS VARCHAR) || '.json', 'no_identity', title, NULL FROM news WHERE o_orderkey % 11 = 1""")
def quarantine_news(spark, sf_dir):
    """News lines that can't be parsed (as their text) or have no number, as the load wrote
    them to quarantine, read back."""
    wh = _warehouse(spark, sf_dir, "quarantine-news")
    landed = landing_src.read_news(spark, fx.news_lines(spark, sf_dir, wh.root + "/_drop"))
    wh.load_news(landed, wh.root + "/_quarantine", "drop")
    back = spark.read.schema("object string, reason string, title string, raw string").json(wh.root + "/_quarantine")
    return back.select("object", "reason", "title", "raw")


@query("model_table_preview", f"""WITH {CANDLES_SQL},
m AS (SELECT stock_symbol, count(*) AS n_days, sum(v)::BIGINT AS volume FROM candles GROUP BY stock_symbol)
SELECT count(*) AS n_rows, least(count(*), 10) AS n_shown, sum(n_days)::BIGINT AS n_days, sum(volume)::BIGINT AS volume, TRUE AS shown_are_rows FROM m""")
def model_table_preview(spark, sf_dir):
    """A model written as a table and referred to by name, and the preview of its first ten rows
    (each of which is a row of the table; a limit implies no order)."""
    model = _candles(spark, sf_dir).groupBy("stock_symbol").agg(F.count(F.lit(1)).alias("n_days"), F.sum("v").cast("long").alias("volume"))
    made = models.materialize_table(model, _session.scratch_path(spark, "model-table", unique=True), "symbol_model")
    shown = models.preview(made).checkpoint()
    found = shown.join(models.ref(spark, "symbol_model"), ["stock_symbol", "n_days", "volume"], "left_semi")
    return made.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_days").alias("n_days"), F.sum("volume").alias("volume")).crossJoin(
        shown.agg(F.count(F.lit(1)).alias("n_shown"))).crossJoin(found.agg(F.count(F.lit(1)).alias("n_found"))).select(
        "n_rows", "n_shown", "n_days", "volume", (F.col("n_found") == F.col("n_shown")).alias("shown_are_rows"))


def queries() -> dict[str, QueryFn]:
    return {k: fn for k, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in REGISTRY.items() if sql is not None}
