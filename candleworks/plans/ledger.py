"""Ledger of landing objects: what was read, when, and what became of its rows.

Before anything is read, the listing of the landing folder (file metadata only) is joined
against the ledger: a file is read if its path, length and modification time aren't there
yet, so an object is read once, and one that has changed under its name is read again. A
read file gets a row with its counts: rows in = loaded + quarantined + equal to what is
stored (or landed twice).

A file's row is written after its rows are loaded. If the run ends between the two, the file is
read again, and its rows are found equal to the stored ones; no row is lost or doubled. Files are read
in batches of ``max_files``, in the order of their modification times (then paths); the
driver sees the paths of one batch.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candleworks import schemas
from candleworks import session as _session
from candleworks.plans.warehouse import Warehouse
from candleworks.sources import landing, landing_source

TABLE = "_landing_objects"
COLUMNS = ("bucket string, file string, object string, file_date date, length bigint, modified bigint, "
           "rows_in bigint, loaded bigint, quarantined bigint, equal bigint")
#: Bucket: landing schema, and the job that loads its rows and counts them by file.
BUCKETS = {"candles": (schemas.CANDLE_RAW, Warehouse.load_candle_objects), "news": (schemas.NEWS_RAW, Warehouse.load_news_objects)}


def entries(wh: Warehouse) -> DataFrame:
    """The ledger; empty before the first run."""
    path = wh.path(TABLE)
    if not _session.path_exists(wh.spark, path):
        wh.spark.createDataFrame([], COLUMNS).write.mode("ignore").parquet(path)
    return wh.spark.read.schema(T.StructType.fromDDL(COLUMNS)).parquet(path)


def pending(wh: Warehouse, bucket: str, landing_dir: str) -> DataFrame:
    """Files that the ledger doesn't have as they are now."""
    had = entries(wh).where(F.col("bucket") == bucket).select("file", "length", "modified")
    return landing_source.listed(wh.spark, landing_dir).join(had, ["file", "length", "modified"], "left_anti")


def ingest(wh: Warehouse, bucket: str, landing_dir: str, quarantine_dir: str | None = None, max_files: int = 64) -> int:
    """Load every pending file of a bucket; returns how many were read."""
    schema, load = BUCKETS[bucket]
    read = 0
    while True:
        batch = pending(wh, bucket, landing_dir).orderBy("modified", "file").limit(max_files).checkpoint(eager=True)
        files = [r[0] for r in batch.select("file").collect()]  # at most max_files
        if not files:
            return read
        rows = landing.read_ndjson(wh.spark, files, schema)
        name = hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()[:16]
        counts = load(wh, rows, quarantine_dir, f"{bucket}-{name}").withColumnRenamed("file", "_file")
        seen = batch.join(counts, landing.same_path(F.col("file"), F.col("_file")), "left")
        number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)  # noqa: E731 (a file without lines has none)
        seen.select(F.lit(bucket).alias("bucket"), "file", "object", "file_date", "length", "modified",
                    *[number(c) for c in ("rows_in", "loaded", "quarantined", "equal")]).coalesce(1).write.mode("append").parquet(wh.path(TABLE))
        read += len(files)
