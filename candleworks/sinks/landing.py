"""Landing drops: one NDJSON object per day, one CSV per exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleworks.functions import times
from candleworks.sinks.tables import writer_tasks


def write_daily_json(rows: DataFrame, base: str, prefix: str, date_col: str,
                     mode: str = "overwrite", rows_a_file: int | None = None, dealt: bool = False) -> None:
    """Write ``rows`` as NDJSON, one object per day named ``<prefix>_<yyyy-MM-dd>.json``
    (a partition directory of that name; one file, unless ``rows_a_file`` spreads a day of
    more rows over several files, written by as many tasks: ``maxRecordsPerFile`` bounds each
    file, and rows are dealt by day and a salt that follows from the day's rows). With ``dealt`` rows are written where they
    lie already, a file a day and task. Re-writing a day replaces only that day."""
    tasks = writer_tasks(rows.sparkSession)
    named = rows.withColumn("object", times.object_name(prefix, date_col)).drop(date_col)
    if dealt:
        dealt_rows = named
    elif rows_a_file:
        sizes = named.groupBy("object").agg(F.ceil(F.count(F.lit(1)) / rows_a_file).cast("int").alias("_files"))
        named = named.join(sizes.withColumnRenamed("object", "_of"), F.col("object").eqNullSafe(F.col("_of"))).withColumn(
            "_salt", F.floor(F.rand(0) * F.col("_files")).cast("int"))
        dealt_rows = named.repartition(tasks, "object", "_salt").drop("_of", "_files", "_salt")
    else:
        dealt_rows = named.repartition(tasks, "object")
    out = (dealt_rows.write.mode(mode)
           .option("maxRecordsPerFile", rows_a_file or 0)
           .option("compression", "none")
           .option("ignoreNullFields", "false"))
    if mode == "overwrite":
        out = out.option("partitionOverwriteMode", "dynamic")
    out.partitionBy("object").json(base)


def write_screener_csv(screener: DataFrame, base: str, file_col: str = "object",
                       null_word: str = "NA", writers: int = 4) -> None:
    """A folder of CSV parts (with header) per exchange file name, each written by up to ``writers`` tasks;
    nulls are written as ``null_word`` the way exported screeners carry them."""
    salt = F.pmod(F.xxhash64(*screener.columns), F.lit(writers))
    (screener.repartition(file_col, salt).write.mode("overwrite")
     .option("header", True).option("nullValue", null_word)
     .partitionBy(file_col).csv(base))

