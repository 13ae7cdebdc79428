"""Exchange screener CSV files (one per exchange), read in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleworks import schemas
from candleworks.operators.dimensions import clean_screener

# Screener object name -> exchange id.
SCREENER_FILES = [("nasdaq_screener_nasdaq.csv", 1), ("nasdaq_screener_nyse.csv", 2),
                  ("nasdaq_screener_amex.csv", 3)]

# The object a row came from: a file name, or the directory a Spark writer made
# under that name (``name.csv/part-…`` or ``object=name.csv/part-…``). It is taken from every
# row, so only the path's last two names are searched, each tried from its first character and read once.
_OBJECT = r"(?<![^/=])([^/=]++)(?<=[^/=]\.(?:csv|json))(?:/part-[^/]*+)?$"


def object_name(path_col: str = "_metadata.file_path"):
    return F.regexp_extract(F.substring_index(F.col(path_col), "/", -2), _OBJECT, 1)


def read_screeners(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """All screener files in one scan; the exchange id comes from the file name by
    a join with the fixed 3-row map (broadcast: its size is fixed). Missing-value
    words become null on the descriptive columns; Symbol is kept verbatim."""
    raw = (spark.read.option("header", True).option("nullValue", "\u0000")
           .option("mode", "PERMISSIVE")
           .schema(schemas.SCREENER_RAW).csv(paths)
           .select("Symbol", "Name", "Country", "Sector", "Industry",
                   object_name().alias("_object")))
    exchange_map = spark.createDataFrame(SCREENER_FILES, "_object string, exchange smallint")
    return clean_screener(raw.join(F.broadcast(exchange_map), "_object", "inner").drop("_object"))
