"""Generic data tests: ``unique`` and ``not_null`` (the dbt semantics).

* unique: values (nulls ignored) that occur more than once; failures = number of
  such values. Partial aggregation makes a hot value cost one row per task.
* not_null: rows where the column is null; all columns of a relation in one pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _expr(c: str | Column) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def unique_failures(df: DataFrame, column: str | Column) -> DataFrame:
    """The duplicated values and how often each occurs."""
    v = _expr(column).alias("value")
    return (df.select(v).where(F.col("value").isNotNull())
            .groupBy("value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def unique_test(model: str, df: DataFrame, column: str) -> DataFrame:
    return unique_failures(df, column).agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"),
        F.lit("unique").alias("test"), F.col("failures").cast("long").alias("failures"))


def not_null_tests(model: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """One scan counting nulls of every column, then one row per column."""
    counts = df.agg(*[F.sum(F.when(_expr(c).isNull(), 1).otherwise(0)).cast("long").alias(f"_{i}")
                      for i, c in enumerate(columns)])
    stacked = ", ".join(f"'{c}', _{i}" for i, c in enumerate(columns))
    return counts.select(F.expr(f"stack({len(columns)}, {stacked}) as (column_name, failures)")) \
        .select(F.lit(model).alias("model"), "column_name", F.lit("not_null").alias("test"),
                F.coalesce(F.col("failures"), F.lit(0)).cast("long").alias("failures"))


def not_null_from_days(model: str, days: DataFrame, columns: list[str]) -> DataFrame:
    """``not_null`` of a fact from the null counts that its loads keep per day; the fact isn't read."""
    return days.select(F.explode("nulls").alias("column_name", "n")).where(F.col("column_name").isin(columns)).groupBy("column_name").agg(
        F.sum("n").cast("long").alias("failures")).select(F.lit(model).alias("model"), "column_name", F.lit("not_null").alias("test"), "failures")


def run_data_tests(spec: list[tuple[str, DataFrame, str, list[str]]]) -> DataFrame:
    """``spec``: (model name, relation, test, columns). One result row per test."""
    parts = []
    for model, df, test, cols in spec:
        if test == "unique":
            parts.extend(unique_test(model, df, c) for c in cols)
        elif test == "not_null":
            parts.append(not_null_tests(model, df, cols))
        else:
            raise ValueError(f"unknown test {test}")
    return reduce(DataFrame.unionByName, parts)


def tests_from_spec(spark, spec: dict | str) -> DataFrame:
    """Run the generic tests declared in a models spec - the nested shape
    ``{"models": [{"name": m, "columns": [{"name": c, "data_tests": ["unique",
    "not_null"]}]}]}`` - against the relations registered under the model names.
    ``spec`` may also be the YAML text of such a file (needs PyYAML)."""
    if isinstance(spec, str):
        import yaml  # optional dependency, only for YAML text
        spec = yaml.safe_load(spec)
    plan = []
    for model in spec.get("models", []):
        rel = spark.table(model["name"])
        for column in model.get("columns", []):
            for test in column.get("data_tests", column.get("tests", [])):
                plan.append((model["name"], rel, test, [column["name"]]))
    return run_data_tests(plan)
