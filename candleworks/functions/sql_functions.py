"""The date rules as SQL functions, so that SQL texts over the warehouse use the same rules as the
DataFrame side (:mod:`candleworks.functions.times`). Temporary functions of the session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from candleworks.functions.times import EPOCH_MILLIS

#: Name: (parameter, result type, body). All give null for text that can't be read.
FUNCTIONS = {
    "epoch_seconds_text": ("t STRING", "STRING", "left(t, 10)"),
    "text_to_long": ("t STRING", "BIGINT", "try_cast(t AS BIGINT)"),
    "date_from_epoch_seconds": ("t STRING", "DATE", "to_date(timestamp_seconds(try_cast(left(t, 10) AS BIGINT)))"),
    "date_from_epoch_millis": ("t STRING", "DATE", "to_date(timestamp_millis(CASE WHEN try_cast(t AS BIGINT) BETWEEN "
                               f"{EPOCH_MILLIS[0]} AND {EPOCH_MILLIS[1]} THEN try_cast(t AS BIGINT) END))"),
    "publish_date": ("t STRING", "DATE", "to_date(try_to_timestamp(left(t, 8), 'yyyyMMdd'))"),
}


def register(spark: SparkSession) -> None:
    """Create (or replace) the functions in the session."""
    for name, (parameter, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameter}) RETURNS {result} RETURN {body}")
