"""The command line drives the whole daily cycle on landed files."""

from candleworks import fixtures as fx
from candleworks import session as S
from candleworks.__main__ import main
from candleworks.plans.warehouse import Warehouse
from tests.conftest import SF_SMALL


def test_cli_daily_cycle(spark, tmp_path, capsys):
    wh_dir = S.scratch_path(spark, "t-cli", unique=True)
    scr_dir = fx.screener_files(spark, SF_SMALL, S.scratch_path(spark, "t-cli-scr", unique=True))
    candles = fx.candle_landing(spark, SF_SMALL)
    news = fx.news_landing(spark, SF_SMALL)
    spec = tmp_path / "schema.yml"
    spec.write_text("models:\n  - name: stock_symbol_DIM\n    columns:\n      - name: stock_symbol\n"
                    "        data_tests: [unique, not_null]\n")
    assert main(["init", "--warehouse", wh_dir]) == 0
    assert main(["load-screeners", "--warehouse", wh_dir, scr_dir]) == 0
    assert main(["candles", "--warehouse", wh_dir, "--landing", candles,
                 "--stream", wh_dir + "/_ck_c", "--quarantine", wh_dir + "/_q"]) == 0
    assert main(["indicators", "--warehouse", wh_dir]) == 0
    assert main(["news", "--warehouse", wh_dir, "--landing", news]) == 0   # newest object only
    assert main(["data-tests", "--warehouse", wh_dir, "--spec", str(spec)]) == 0
    wh = Warehouse(spark, wh_dir)
    assert wh.read("stock_symbol_DIM").count() == 10
    assert wh.read("ohcl_indicator").count() > 0
    assert wh.read("shot_MA").count() == wh.read("candles_FACT").count()
    newest = wh.read("news_DIM").select("insert_date").distinct().collect()
    assert len(newest) == 1 and wh.read("news_DIM").count() > 0
    out = capsys.readouterr().out
    assert "unique" in out and "not_null" in out


def test_bench_prints_one_json_line():
    import json
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_QUERIES="latest_trade_date,epoch_text_to_date")
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py")], env=env, cwd=root,
                         capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, out.stdout
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"latest_trade_date", "epoch_text_to_date"}
    assert d["value"] == round(sum(d["queries"].values()), 3)
