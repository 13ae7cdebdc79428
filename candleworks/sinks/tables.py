"""Table writes: by column name, re-runnable, laid out by the table's sort key.

* Writes bind by name: the frame is projected onto the contract's columns and
  types first (a positional insert would swap prices and volumes).
* Repeating a load is safe: partitioned tables are written with dynamic partition
  overwrite, so a re-run replaces the days it writes and nothing else.
* Layout: rows are sorted within each task by (partition column, sort key), so a
  task keeps one file open at a time and parquet row-group min/max statistics skip
  data for filters on the sort key. No shuffle is added by default: a daily load
  holds one day, and landing splits hold one day each. A backfill whose splits mix
  many days passes ``range_partitions`` to range-partition on the same keys first
  (a hot day then spreads over several writer tasks instead of one), or ``deal_by``:
  rows that agree in these columns are written by one task, so where they are the day
  and a number's piece of it, a day has a file a piece, and not one of every task.
* A path that is being read is never overwritten in place: write beside, then swap.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from candleworks import schemas
from candleworks import session as _session


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto ``schema``, by name."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def conform(df: DataFrame, table: str, extra: Sequence[StructField] = ()) -> DataFrame:
    """Project ``df`` onto the contract of ``table`` (and ``extra`` columns that its files hold
    beside it): by name, contract types."""
    fields = [*schemas.schema_of(table).fields, *extra]
    missing = [f.name for f in fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def clustered(df: DataFrame, partition_by: str | None, sort_by: list[str] | None,
              range_partitions: int | None = None, deal_by: Sequence[Column] = ()) -> DataFrame:
    keys = ([partition_by] if partition_by else []) + list(sort_by or [])
    if deal_by:
        df = df.repartition(writer_tasks(df.sparkSession), *deal_by)
    if not keys:
        return df
    if range_partitions:
        df = df.repartitionByRange(range_partitions, *keys)
    return df.sortWithinPartitions(*keys)


def writer_tasks(spark: SparkSession) -> int:
    """How many tasks rows are dealt to before a write: said outright, as adaptive execution would fold a
    small write into one task, and no fewer than a shuffle has, as a task's rows are sorted."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def write_table(df: DataFrame, path: str, table: str | None = None, mode: str = "append",
                partition_by: str | None = None, sort_by: list[str] | None = None,
                range_partitions: int | None = None, extra: Sequence[StructField] = (),
                deal_by: Sequence[Column] = ()) -> None:
    """Append (``mode='append'``) or replace the written partitions (``'overwrite'``,
    dynamic partition overwrite) of the table at ``path``."""
    if table:
        meta = schemas.TABLES[table]
        df = conform(df, table, extra)
        partition_by = partition_by or meta.get("partition")
        sort_by = sort_by or meta.get("sort")
    out = clustered(df, partition_by, sort_by, range_partitions, deal_by).write.mode(mode)
    if partition_by:
        out = out.partitionBy(partition_by)
    out.parquet(path)


def write_beside_then_swap(df: DataFrame, path: str, partition_by: str | None = None,
                           sort_by: list[str] | None = None, range_partitions: int | None = None) -> None:
    """Write the whole table next to ``path`` and move it into place when complete,
    so readers never see a half-written table. If the move fails, the old table is put
    back and the error is raised; the old table's folder (``.old-…``) is kept."""
    spark = df.sparkSession
    tmp = f"{path}.tmp-{uuid.uuid4().hex}"
    out = clustered(df, partition_by, sort_by, range_partitions).write.mode("overwrite")
    if partition_by:
        out = out.partitionBy(partition_by)
    out.parquet(tmp)
    old = f"{path}.old-{uuid.uuid4().hex}" if _session.path_exists(spark, path) else None
    if old and not _session.rename_path(spark, path, old):
        raise OSError(f"could not move {path} aside; the new table is at {tmp}")
    if not _session.rename_path(spark, tmp, path):
        if old:
            _session.rename_path(spark, old, path)
        raise OSError(f"could not move {tmp} to {path}")


def create_if_missing(spark: SparkSession, path: str, table: str) -> bool:
    """``CREATE TABLE IF NOT EXISTS``: an empty table with the contract schema."""
    if _session.path_exists(spark, path):
        return False
    empty = spark.createDataFrame([], schemas.schema_of(table))
    write_table(empty, path, table, mode="ignore")
    return True


def read_table(spark: SparkSession, path: str, table: str, extra: Sequence[StructField] = ()) -> DataFrame:
    """Read a table with its contract schema (no inference, empty tables too); ``extra``
    columns are null in files that don't hold them."""
    return spark.read.schema(StructType([*schemas.schema_of(table).fields, *extra])).parquet(path)
