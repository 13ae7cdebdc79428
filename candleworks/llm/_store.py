"""Tables that an operator writes to the shared folder between two of its steps.

A written table cuts the lineage: if an executor is lost, later steps reread the
table instead of recomputing what led to it. Everything lies below the folder that
the session names in ``spark.checkpoint.dir`` (see :func:`candleworks.session.scratch_path`).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candleworks.session import scratch_path


#: Rows that travel to and from Python workers at a time; documents have kilobytes each.
ROWS_A_BATCH = 2_000


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if they run
    where that folder exists (one machine, a shared mount); else it is installed there. Also bounds
    the batches that they get, whose buffers the workers and the executor hold several times."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_A_BATCH))
    import candleworks

    root = os.path.dirname(os.path.dirname(os.path.abspath(candleworks.__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared store and return it read back. The folder is
    removed when the application ends: until then, what is returned may be read again."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name, unique=True)
    df.write.parquet(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def empty(spark: SparkSession, schema: str | StructType) -> DataFrame:
    """A DataFrame without rows. No Python list is behind it, for which every executor would start (and keep)
    Python workers of another kind than those of the operators."""
    fields = schema.fields if isinstance(schema, StructType) else StructType.fromDDL(schema).fields
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def plain(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns of ``docs``, under an alias of their own, so that extra
    columns of the input (whatever their names) can't clash with an operator's."""
    return docs.select(*[F.col(n) for n in names])


def same_class_small(df: DataFrame, most_rows: int) -> bool:
    """Whether ``df`` has at most ``most_rows`` rows, found without reading it all."""
    return df.limit(most_rows + 1).count() <= most_rows


def one_each(rows: DataFrame, *keys: str) -> DataFrame:
    """One row of each that agree in ``keys`` (nulls agree); rows are only combined if any do."""
    if rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return rows
    return rows.dropDuplicates(list(keys))


def text_key(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """What tells rows of one id and different texts apart: a hash of the text, or 0 for every row
    where no id repeats."""
    if docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return F.lit(0).cast("long")
    return F.xxhash64(text_col)
