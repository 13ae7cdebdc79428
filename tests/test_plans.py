"""Plan checks: no Python in the hot path, no unpartitioned window, partition
pruning on the stored fact, top-k instead of a full sort."""

import re

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF_SMALL

SKIP = {"incremental_candles", "incremental_news", "land_news", "land_candles", "landing_audit",
        "insert_select", "init_schema", "na_words_to_null", "load_candles", "load_news", "moving_average_tables",
        "object_ledger", "quarantine_candles", "quarantine_news", "sql_passthrough", "co_located_join"}  # these run jobs that write
KEYS = sorted(k for k in entry_mod._registry.queries() if k not in SKIP)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString() + \
        df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_no_python_udf_and_no_global_window(spark, key):
    df = entry_mod.queries()[key](spark, SF_SMALL)
    text = plan_text(df)
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
                 "MapInPandas"):
        assert node not in text, f"{key}: {node}"
    # a Window operator with an empty partition spec runs in one task
    assert not re.search(r"Window \[.*\], \[\], \[", text), key


def test_indicator_prunes_partitions(spark):
    df = entry_mod.queries()["ohcl_indicator"](spark, SF_SMALL)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_date" in text or "trade_date" in text
    formatted = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert re.search(r"PartitionFilters: \[isnotnull\(trade_date#\d+\), \(trade_date#\d+ = ", formatted)
    # Dates come from the loaded days, so no top-k runs over the fact's rows.
    assert "TakeOrderedAndProject" not in formatted and "upto" in formatted
    assert "ReadSchema: struct<stock_symbol:string,c:double>" in formatted


def test_co_located_tables_join_without_a_shuffle(spark):
    df = entry_mod.queries()["co_located_join"](spark, SF_SMALL)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_every_survey_id_is_run_by_a_key_with_an_oracle():
    oracles = entry_mod._registry.oracle_sql()
    text = " ".join(fn.__doc__ or "" for key, fn in entry_mod._registry.queries().items() if key in oracles)
    ids = {f"{p}{i}" for p, n in [("A", 16), ("B", 13), ("C", 17), ("D", 13), ("E", 8), ("F", 5),
                                  ("G", 3), ("H", 3), ("I", 15), ("J", 3), ("K", 4), ("M", 10)]
           for i in range(1, n + 1)}
    named = set(re.findall(r"\b[A-M]\d+\b", text))
    for p, a, b in re.findall(r"\b([A-M])(\d+)-[A-M]?(\d+)\b", text):
        named |= {f"{p}{i}" for i in range(int(a), int(b) + 1)}
    assert ids - named == set()
