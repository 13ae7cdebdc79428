"""Table contracts: the 16 warehouse tables and the three raw landing shapes.

Unsigned integer types become the next wider signed type; UUID columns are
strings holding a deterministic key (see :mod:`candleworks.functions.keys`).
Float32 columns are kept as ``float`` only at the table edge; operators compute
in ``double``.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, F32, F64 = T.StringType(), T.DateType(), T.FloatType(), T.DoubleType()
U8, U32 = T.ShortType(), T.LongType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---- raw landing shapes ---------------------------------------------------------

#: Where a permissive read keeps the text of a line that it can't parse.
CORRUPT = "_corrupt_record"

# One grouped daily bar per ticker, NDJSON, object ``OHCL_<yyyy-MM-dd>.json``.
CANDLE_RAW = _schema(
    ("ticker", S), ("o", F64), ("c", F64), ("h", F64), ("l", F64), ("v", F64),
    ("vwap", F64), ("time", S), ("trans", T.LongType()), (CORRUPT, S),
)

# One news item per line, object ``news_<yyyy-MM-dd>.json``. Scores inside the
# arrays are read as text and converted with try_cast, so either JSON encoding works.
TOPIC = _schema(("topic", S), ("relevance_score", S))
TICKER_SENTIMENT = _schema(("ticker", S), ("ticker_sentiment_score", S))
NEWS_RAW = _schema(
    ("in_date_id", T.LongType()), ("title", S), ("url", S), ("time_published", S),
    ("source", S), ("source_domain", S), ("overall_sentiment_score", F64),
    ("topics", T.ArrayType(TOPIC)), ("ticker_sentiment", T.ArrayType(TICKER_SENTIMENT)), (CORRUPT, S),
)

# Exchange screener CSV (header row). ``IPO Year`` is never used, so never read.
SCREENER_RAW = _schema(
    ("Symbol", S), ("Name", S), ("Country", S), ("IPO Year", S), ("Sector", S), ("Industry", S),
)

# ---- warehouse tables (name -> schema, sort key, partition column) --------------

TABLES: dict[str, dict] = {
    "industry_DIM": dict(schema=_schema(("industry_id", S), ("industry_name", S)),
                         sort=["industry_id"]),
    "exchange_DIM": dict(schema=_schema(("exchange_id", U8), ("exchange_name", S)),
                         sort=["exchange_id"]),
    "country_DIM": dict(schema=_schema(("country_id", S), ("country_name", S)),
                        sort=["country_id"]),
    "sector_DIM": dict(schema=_schema(("sector_id", S), ("sector", S)), sort=["sector_id"]),
    "stock_symbol_DIM": dict(schema=_schema(
        ("stock_symbol", S), ("stock_symbol_name", S), ("country_id", S), ("sector_id", S),
        ("industry_id", S), ("exchange", U8)), sort=["stock_symbol"]),
    "source_DIM": dict(schema=_schema(("source_id", S), ("source_name", S), ("source_domain", S)),
                       sort=["source_id"]),
    "topic_DIM": dict(schema=_schema(("topic_id", S), ("topic_name", S)), sort=["topic_id"]),
    "news_DIM": dict(schema=_schema(
        ("insert_date", D), ("in_date_id", U32), ("title", S), ("url", S),
        ("time_publish_id", D), ("source_id", S), ("overall_sentiment_score", F64)),
        sort=["insert_date", "in_date_id"], partition="insert_date"),
    "date_DIM": dict(schema=_schema(("date_id", S), ("date", D)), sort=["date_id"]),
    # trade_date is derived once at ingest from t and is the partition column; filled marks
    # rows that carry an earlier close forward.
    "candles_FACT": dict(schema=_schema(
        ("stock_symbol", S), ("o", F32), ("h", F32), ("c", F32), ("l", F32), ("v", U32),
        ("Trans", U32), ("t", S), ("vwap", F32), ("filled", T.BooleanType()), ("trade_date", D)),
        sort=["t", "stock_symbol"], partition="trade_date"),
    "new_sentiment_stock_FACT": dict(schema=_schema(
        ("insert_date", D), ("in_date_id", U32), ("stock_symbol", S), ("sentiment_score", F32)),
        sort=["insert_date", "in_date_id", "stock_symbol"], partition="insert_date"),
    "new_sentiment_industry_FACT": dict(schema=_schema(
        ("insert_date", D), ("in_date_id", U32), ("topic_id", S), ("sentiment_score", F32)),
        sort=["insert_date", "in_date_id", "topic_id"], partition="insert_date"),
    # The moving-average tables carry the fact's trade_date as partition column so
    # that a daily run replaces only the days it computes.
    "shot_MA": dict(schema=_schema(("stock_symbol", S), ("t", S), ("ma", F64), ("trade_date", D)),
                    sort=["stock_symbol", "t"], partition="trade_date"),
    "long_MA": dict(schema=_schema(("stock_symbol", S), ("t", S), ("ma", F64), ("trade_date", D)),
                    sort=["stock_symbol", "t"], partition="trade_date"),
    "avg_volume": dict(schema=_schema(("stock_symbol", S), ("date", D), ("sliding_avg", F32)),
                       sort=["stock_symbol", "date"], partition="date"),
    "ohcl_indicator": dict(schema=_schema(
        ("stock_symbol", S), ("date", S), ("delta", F64), ("sliding_avg_3", F64),
        ("sliding_avg_5", F64)), sort=["date"], partition="date"),
}


# ---- kept beside the contract (same folder, not part of the 16 tables) ----------------

# What a stored news item is and which version of it is stored, in the files of news_DIM;
# readers of the contract's columns don't see them. The facts carry ``item``.
NEWS_ITEM = _schema(("item", S), ("want", U32), ("first_seen", T.LongType()), ("modified", T.LongType()), ("tie", S))
# Rows of candles_FACT per trading day, and of all days up to it; and the nulls of each column that day.
LOADED_DAYS = _schema(("trade_date", D), ("rows", T.LongType()), ("upto", T.LongType()), ("nulls", T.MapType(S, T.LongType())))


def schema_of(table: str) -> T.StructType:
    return TABLES[table]["schema"]
