"""Model relations: a literal relation, a union of relations, a model that refers
to another model by name, materialised as a view or as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def starter_model(spark: SparkSession) -> DataFrame:
    """``select 1 as id union all select null as id`` (one valid and one null id)."""
    return spark.sql("SELECT 1 AS id UNION ALL SELECT CAST(NULL AS INT) AS id")


def ref(spark: SparkSession, name: str) -> DataFrame:
    """Reference another model by name."""
    return spark.table(name)


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return ref(df.sparkSession, name)


def materialize_table(df: DataFrame, path: str, name: str) -> DataFrame:
    """Write the model's rows and expose the written table under ``name``."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(path)
    spark.read.parquet(path).createOrReplaceTempView(name)
    return ref(spark, name)


def filtered_model(spark: SparkSession, parent: str, predicate: str) -> DataFrame:
    """``select * from {{ ref(parent) }} where <predicate>``."""
    return spark.sql(f"SELECT * FROM {parent} WHERE {predicate}")


def insert_select(spark: SparkSession, target_path: str, source: str) -> None:
    """``INSERT INTO target SELECT * FROM {{ ref(source) }}`` (append)."""
    ref(spark, source).write.mode("append").parquet(target_path)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows to look at (a limit; no order is implied)."""
    return df.limit(n)
