"""Incremental ingest of the daily landing drops with Structured Streaming.

A file-source stream over the landing folder picks up every object not seen
before, exactly once per checkpoint; ``foreachBatch`` hands each micro-batch to
the warehouse jobs, which are repeatable (a retried batch rewrites the same
partitions and appends no dimension member twice). ``trigger(availableNow)``
processes what has landed and stops, which is how a daily schedule runs it; a
long-running deployment uses a processing-time trigger instead.

State between batches is the warehouse itself: the candle fact's newest day
before a batch holds one row per known symbol (the carry-forward seed). Prices are
read with partition filters, and days are looked up in the loaded days. The tables don't depend on
how many files a batch holds: of several versions of a news item the one of the object modified last
stays (of one time, the one of the greatest digest), and numbers in a day follow from the day's items.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from candleworks import schemas
from candleworks.plans.warehouse import Warehouse
from candleworks.sources.landing import with_object


def _stream(spark: SparkSession, landing_dir: str, schema, max_files: int) -> DataFrame:
    raw = (spark.readStream.schema(schema)
           .option("maxFilesPerTrigger", max_files)
           .option("mode", "PERMISSIVE")
           .json(landing_dir))
    return with_object(raw)


def _batch_name(checkpoint: str, epoch_id: int) -> str:
    """The same for every retry of a batch of one stream, and of no other batch."""
    return f"{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}-{epoch_id}"


def ingest_candles(spark: SparkSession, warehouse: Warehouse, landing_dir: str, checkpoint: str,
                   quarantine_dir: str | None = None, max_files: int = 1,
                   available_now: bool = True):
    """Stream candle landing objects into ``candles_FACT`` (with carry-forward)."""
    def batch(df: DataFrame, epoch_id: int) -> None:
        rows = df.persist()
        try:
            warehouse.load_candles(rows, quarantine_dir, _batch_name(checkpoint, epoch_id))
        finally:
            rows.unpersist()

    writer = (_stream(spark, landing_dir, schemas.CANDLE_RAW, max_files)
              .writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def ingest_news(spark: SparkSession, warehouse: Warehouse, landing_dir: str, checkpoint: str,
                max_files: int = 64, available_now: bool = True, quarantine_dir: str | None = None):
    """Stream news landing objects into the source/topic dimensions, news_DIM and
    both sentiment facts."""
    def batch(df: DataFrame, epoch_id: int) -> None:
        warehouse.load_news(df, quarantine_dir, _batch_name(checkpoint, epoch_id))  # keeps the rows it reads itself

    writer = (_stream(spark, landing_dir, schemas.NEWS_RAW, max_files)
              .writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def order_landing_by_day(spark: SparkSession, landing_dir: str) -> int:
    """Give each landing file the modification time of its day (objects of a daily
    drop arrive one day apart; a bulk-written copy does not), so that the stream
    takes the days in calendar order. Correctness never depends on it: a late day
    triggers a recompute of the later days. Uses the file system listing only."""
    import re

    from candleworks import session as _session

    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(landing_dir)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    it = fs.listFiles(base, True)
    n = 0
    while it.hasNext():
        st = it.next()
        path = st.getPath().toString()
        m = re.search(r"_(\d{4}-\d{2}-\d{2})\.json/part-", path)
        if m:
            _session.set_mtime(spark, path, _day_millis(m.group(1)))
            n += 1
    return n


def _day_millis(iso_day: str) -> int:
    import datetime as dt
    d = dt.date.fromisoformat(iso_day)
    return int(dt.datetime(d.year, d.month, d.day, tzinfo=dt.timezone.utc).timestamp() * 1000)
