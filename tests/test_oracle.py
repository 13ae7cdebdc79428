"""Every registered query against its SQL oracle (DuckDB) on the smallest scale."""

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF_SMALL
from tests.helpers import multiset, rows

SLOW = {"incremental_candles", "incremental_news", "land_news", "landing_audit"}
KEYS = sorted(entry_mod._registry.queries())


def test_every_query_has_an_oracle_or_is_rows_only():
    missing = set(entry_mod.queries()) - set(entry_mod.oracle_sql())
    assert {k for k in missing if k in entry_mod._registry.queries()} == set()


@pytest.mark.parametrize("key", [k for k in KEYS if k not in SLOW])
def test_query_matches_oracle(spark, duck, key):
    df = entry_mod.queries()[key](spark, SF_SMALL)
    got = rows(df)
    sql = entry_mod.oracle_sql().get(key)
    if sql is None:
        assert len(got) > 0
        return
    cur = duck.execute(sql)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert multiset(df.columns, got) == multiset(cols, want)


@pytest.mark.parametrize("key", sorted(SLOW))
def test_slow_query_matches_oracle(spark, duck, key):
    test_query_matches_oracle(spark, duck, key)


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["stock_symbol", "date", "delta", "sliding_avg_3", "sliding_avg_5"]
    assert df.count() == 13
