"""candleworks: a PySpark market-data warehouse (candles, news sentiment, indicators)."""

__version__ = "0.1.0"
