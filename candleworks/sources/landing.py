"""Landing objects (NDJSON, one object per day) and their file metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candleworks import schemas
from candleworks.functions import times
from candleworks.sources import landing_source
from candleworks.sources.screener import object_name


def read_ndjson(spark: SparkSession, path: str | list[str], schema) -> DataFrame:
    """Declared schema, permissive: a malformed line becomes a row with nulls (and its
    text in ``_corrupt_record`` when that column is part of the schema), never a
    failed load."""
    return with_object(spark.read.schema(schema).option("mode", "PERMISSIVE").json(path))


def with_object(lines: DataFrame) -> DataFrame:
    """Adds what a line's landing object is called, its date, path and modification time (microseconds)."""
    return (lines.withColumn("object", object_name()).withColumn("file_date", times.object_date("object"))
            .withColumn("file", F.col("_metadata.file_path"))
            .withColumn("modified", F.unix_micros(F.col("_metadata.file_modification_time"))))


def same_path(a: Column, b: Column) -> Column:
    """Whether two forms of a file's path (with or without an authority, encoded or not) name one file."""
    def plain(c: Column) -> Column:
        return F.regexp_replace(F.url_decode(F.regexp_replace(c, r"\+", "%2B")), "^file:/+", "file:/")
    return plain(a) == plain(b)


def read_candles(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Candle landing rows (ticker, o, c, h, l, v, vwap, time, trans) + object, file_date."""
    return read_ndjson(spark, path, schemas.CANDLE_RAW)


def read_news(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """News landing rows with their nested arrays + object, file_date."""
    return read_ndjson(spark, path, schemas.NEWS_RAW)


def read_day(spark: SparkSession, base: str, prefix: str, day: str, schema) -> DataFrame:
    """The landing object of one given date (``<prefix>_<yyyy-MM-dd>.json``): only its folder is listed
    and read. A day without an object gives no rows."""
    name = f"{prefix}_{day}.json"
    files = [r[0] for r in landing_source.listed(spark, base).where(F.col("object") == name).select("file").collect()]  # of one object
    rows = read_ndjson(spark, files, schema) if files else read_ndjson(spark, base, schema).where("false")
    return rows.where(F.col("object") == name)


def objects(spark: SparkSession, path: str, with_rows: bool = True) -> DataFrame:
    """Per landing object: name, date in the name, files, bytes, modification time
    and (``with_rows``) line count; an object without a line has 0.

    The files are listed by the ``landing`` data source, which reads none of them (the daily step
    uses this). With row counts, a text scan counts the lines of each file beside it."""
    per_file = landing_source.listed(spark, path).select("object", F.col("length").alias("bytes"), F.timestamp_micros("modified").alias("modified"))
    aggs = [F.sum("bytes").alias("bytes"), F.max("modified").alias("modified"),
            F.count(F.lit(1)).alias("files")]
    listed = per_file.groupBy("object").agg(*aggs)
    if with_rows:
        lines = spark.read.text(path).select(object_name().alias("_object")).groupBy("_object").agg(F.count(F.lit(1)).alias("_rows"))
        listed = listed.join(lines, F.col("object") == F.col("_object"), "left").withColumn("rows", F.coalesce("_rows", F.lit(0))).drop("_object", "_rows")
    return listed.withColumn("file_date", times.object_date("object"))


def newest_object(listing: DataFrame) -> DataFrame:
    """The most recently modified object; on a tie the first in listing (name) order."""
    return listing.agg(F.min_by("object", F.struct(
        (-F.unix_micros(F.col("modified").cast("timestamp"))).alias("m"), F.col("object"))).alias("object"))
