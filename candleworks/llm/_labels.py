"""Labelled rows for the classifiers: which are learned from, and which are held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: Column, folds: int) -> Column:
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds))


def training(labels: DataFrame, id_col: str, label_col: str, folds: int, held_out: int) -> DataFrame:
    """``_id`` and ``_y`` (0 or 1) of the rows to learn from. Null ids and labels are left
    out; an id that is labelled several times counts by its smallest label."""
    rows = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).where(
        F.col("_id").isNotNull() & F.col("_y").isin(0, 1))
    return rows.where(fold(F.col("_id"), folds) != held_out).groupBy("_id").agg(F.min("_y").alias("_y"))
