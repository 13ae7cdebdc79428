"""Hand-made frames for the semantic traps (expected rows written by hand)."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from candleworks import session as S
from candleworks.functions import times
from candleworks.operators import candles as cd
from candleworks.operators import dimensions as dm
from candleworks.operators import indicators, models, numbering, quality
from candleworks.operators import news as ns
from candleworks.plans.warehouse import Warehouse

D = dt.date


def bars(spark, rows):
    """rows: (symbol, date, close[, trans]) -> fact-shaped bars."""
    out = []
    for r in rows:
        sym, day, c = r[:3]
        trans = r[3] if len(r) > 3 else 1
        t = str((dt.datetime(day.year, day.month, day.day, 20, tzinfo=dt.timezone.utc).timestamp()) * 1000)[:-2]
        out.append((sym, day, float(c), float(c) + 1, float(c) - 1, float(c), 10, trans, t, float(c)))
    return spark.createDataFrame(
        out, "stock_symbol string, trade_date date, o double, h double, l double, c double, "
             "v bigint, trans bigint, t string, vwap double")


def test_t1_first_rows_span_two_dates(spark):
    b = bars(spark, [("A", D(2024, 1, 1), 1), ("B", D(2024, 1, 1), 2),
                     ("A", D(2024, 1, 2), 3), ("B", D(2024, 1, 2), 4), ("C", D(2024, 1, 2), 5),
                     ("A", D(2024, 1, 3), 6), ("B", D(2024, 1, 3), 7), ("C", D(2024, 1, 3), 8)])
    got = {r.stock_symbol: (r.date, r.delta, r.sliding_avg_3, r.sliding_avg_5)
           for r in indicators.ohcl_indicator(b).collect()}
    assert got == {"A": ("2024-01-03", 3.0, 2.0, 2.0), "B": ("2024-01-03", 3.0, 3.0, 3.0),
                   "C": ("2024-01-03", 3.0, 5.0, 5.0)}


def test_t1_wide_first_day_means_first_close(spark):
    b = bars(spark, [(s, D(2024, 1, 1), i) for i, s in enumerate("ABCDEF")] +
             [(s, D(2024, 1, 2), 10 + i) for i, s in enumerate("ABCDEF")])
    for r in indicators.ohcl_indicator(b).collect():
        assert r.sliding_avg_3 == r.sliding_avg_5 == "ABCDEF".index(r.stock_symbol)


def test_t2_symbol_missing_a_day_disappears(spark):
    b = bars(spark, [("A", D(2024, 1, 1), 1), ("B", D(2024, 1, 1), 2), ("C", D(2024, 1, 1), 2),
                     ("A", D(2024, 1, 2), 2), ("A", D(2024, 1, 3), 4), ("B", D(2024, 1, 3), 4)])
    assert [r.stock_symbol for r in indicators.ohcl_indicator(b).collect()] == ["A"]


def test_t5_two_domains_fan_out(spark):
    news = spark.createDataFrame(
        [(D(2024, 1, 1), 0, "t0", "u0", "20240101T100000", "Wire", "a.com", 0.1),
         (D(2024, 1, 1), 1, "t1", "u1", "20240101T110000", "Wire", "b.com", 0.2)],
        "file_date date, in_date_id long, title string, url string, time_published string, "
        "source string, source_domain string, overall_sentiment_score double")
    pairs = ns.sources(news, one_per_name=False)
    assert pairs.count() == 2
    assert ns.news_rows(news, pairs).count() == 4
    one = ns.sources(news)
    assert [(r.source_name, r.source_domain) for r in one.collect()] == [("Wire", "a.com")]
    assert ns.news_rows(news, one).count() == 2


def test_t13_null_source_gets_null_id(spark):
    news = spark.createDataFrame(
        [(D(2024, 1, 1), 0, "t0", "u0", "20240101T100000", None, None, 0.1)],
        "file_date date, in_date_id long, title string, url string, time_published string, "
        "source string, source_domain string, overall_sentiment_score double")
    assert ns.sources(news).count() == 0
    assert ns.news_rows(news, ns.sources(news)).collect()[0].source_id is None


def test_j1_empty_null_and_null_elements(spark):
    news = spark.createDataFrame(
        [(D(2024, 1, 1), 0, []), (D(2024, 1, 1), 1, None), (D(2024, 1, 1), 2, [None]),
         (D(2024, 1, 1), 3, [(None, "0.5")]), (D(2024, 1, 1), 4, [("Tech", "0.25"), ("Tech", "x")])],
        "file_date date, in_date_id long, topics array<struct<topic:string,relevance_score:string>>")
    entries = ns.topic_entries(news).orderBy("in_date_id", "relevance_score").collect()
    assert [(r.in_date_id, r.topic, r.relevance_score) for r in entries] == [
        (3, None, "0.5"), (4, "Tech", "0.25"), (4, "Tech", "x")]
    facts = ns.topic_facts(news, ns.topics(news)).orderBy("in_date_id", "sentiment_score").collect()
    assert [(r.in_date_id, r.topic_id is None, r.sentiment_score) for r in facts] == [
        (3, True, 0.5), (4, False, None), (4, False, 0.25)]
    assert facts[0].insert_date == D(2024, 1, 3)


def test_i2_epoch_text_junk(spark):
    df = spark.createDataFrame([("1743451200000",), ("abc",), ("",), ("1743451200",)], "t string")
    got = df.select(times.date_from_epoch_seconds_text("t").alias("s"),
                    times.date_from_epoch_millis_text("t").alias("m")).collect()
    assert got[0].s == got[0].m == D(2025, 3, 31)
    assert got[1].s is None and got[1].m is None
    assert got[2].s is None and got[2].m is None
    assert got[3].s == D(2025, 3, 31) and got[3].m == D(1970, 1, 21)


def test_t12_na_words_and_symbol_na(spark):
    raw = spark.createDataFrame(
        [("NA", "Nano Labs Ltd Class A Ordinary Shares", "N/A", "null", "None"),
         ("ABC", "NA", "United States", "", "Software")],
        "Symbol string, Name string, Country string, Sector string, Industry string")
    got = dm.clean_screener(raw).orderBy("Symbol").collect()
    assert (got[0].Symbol, got[0].Name, got[0].Country, got[0].Sector, got[0].Industry) == \
        ("ABC", None, "United States", None, "Software")
    assert (got[1].Symbol, got[1].Country, got[1].Sector, got[1].Industry) == ("NA", None, None, None)
    fixed = dm.repair_symbols(raw.withColumn("Symbol", F.lit(None).cast("string"))).collect()
    assert fixed[0].Symbol == "NA" and fixed[1].Symbol is None


def test_dimension_load_default_distinct_unseen(spark):
    raw = spark.createDataFrame([("US",), ("US",), (None,), ("DE",)], "Country string")
    current = spark.createDataFrame([("k", "US")], "country_id string, country_name string")
    got = dm.load_dimension(raw, "Country", dm.COUNTRY, current).orderBy("country_name").collect()
    assert [r.country_name for r in got] == ["DE", "unpredict"]
    assert all(len(r.country_id) == 36 for r in got)


def _landing(spark, rows):
    """rows: (ticker, iso day of the object, close, time text)."""
    return spark.createDataFrame(
        [(t, c, c, c, c, 100.0, c, tm, 1, D.fromisoformat(d)) for t, d, c, tm in rows],
        "ticker string, o double, c double, h double, l double, v double, vwap double, "
        "time string, trans long, file_date date")


def _ms(day):
    return str(int(dt.datetime.fromisoformat(day + "T20:00:00+00:00").timestamp() * 1000))


def _symbols(spark, wh, syms):
    scr = spark.createDataFrame([(s, s + " Inc", "US", "Tech", "Software", 1) for s in syms],
                                "Symbol string, Name string, Country string, Sector string, "
                                "Industry string, exchange smallint")
    wh.init_schema()
    wh.load_dimensions(scr)
    wh.load_stock_symbols(scr)


def _fact_rows(wh):
    return sorted((r.stock_symbol, str(r.trade_date), r.c, r.v, r.Trans)
                  for r in wh.read("candles_FACT").collect())


@pytest.fixture()
def days():
    d = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    return [
        [("A", d[0], 1.0, _ms(d[0])), ("B", d[0], 2.0, _ms(d[0]))],
        [("A", d[1], 3.0, _ms(d[1])), ("ZZZ", d[1], 9.0, _ms(d[1]))],   # B gap, unknown ZZZ
        [("C", d[2], 5.0, _ms(d[2]))],                                  # A, B gaps; C starts
        [("B", d[3], 6.0, _ms(d[3])), ("A", d[3], 7.0, _ms(d[2]))],     # A's row has the wrong day
    ]


def test_t7_day_by_day_equals_backfill_and_t3_rerun(spark, days):
    wh = Warehouse(spark, S.scratch_path(spark, "t-daily", unique=True))
    _symbols(spark, wh, ["A", "B", "C", "D"])   # D never trades
    for day in days:
        wh.load_candles(_landing(spark, day), quarantine_dir=wh.root + "/_q")
    daily = _fact_rows(wh)
    wh.load_candles(_landing(spark, days[1]))   # re-delivered day: skipped
    assert _fact_rows(wh) == daily
    assert daily == [
        ("A", "2024-01-01", 1.0, 100, 1), ("A", "2024-01-02", 3.0, 100, 1), ("A", "2024-01-03", 3.0, 0, 0),
        ("A", "2024-01-04", 3.0, 0, 0),
        ("B", "2024-01-01", 2.0, 100, 1), ("B", "2024-01-02", 2.0, 0, 0), ("B", "2024-01-03", 2.0, 0, 0),
        ("B", "2024-01-04", 6.0, 100, 1),
        ("C", "2024-01-03", 5.0, 100, 1), ("C", "2024-01-04", 5.0, 0, 0)]
    q = spark.read.json(wh.root + "/_q")
    assert sorted((r.ticker, r.reason) for r in q.collect()) == [
        ("A", "file_date_mismatch"), ("ZZZ", "unknown_ticker")]

    # one-shot backfill over the accepted rows gives the same fact
    wh2 = Warehouse(spark, S.scratch_path(spark, "t-backfill", unique=True))
    _symbols(spark, wh2, ["A", "B", "C", "D"])
    wh2.load_candles(_landing(spark, [r for d in days for r in d]))
    assert _fact_rows(wh2) == daily


def test_t7_late_day_recomputes_later_fills(spark, days):
    wh = Warehouse(spark, S.scratch_path(spark, "t-late", unique=True))
    _symbols(spark, wh, ["A", "B", "C", "D"])
    for i in (0, 2, 3, 1):   # day 2 arrives last
        wh.load_candles(_landing(spark, days[i]))
    wh2 = Warehouse(spark, S.scratch_path(spark, "t-inorder", unique=True))
    _symbols(spark, wh2, ["A", "B", "C", "D"])
    for i in (0, 1, 2, 3):
        wh2.load_candles(_landing(spark, days[i]))
    assert _fact_rows(wh) == _fact_rows(wh2)


def test_t8_filled_rows_take_the_days_first_stamp(spark):
    b = bars(spark, [("A", D(2024, 1, 1), 1), ("B", D(2024, 1, 1), 2), ("A", D(2024, 1, 2), 3)])
    b = b.withColumn("t", F.when((F.col("stock_symbol") == "A") & (F.col("trade_date") == D(2024, 1, 2)),
                                 F.lit("1704200000000")).otherwise(F.col("t")))
    dim = spark.createDataFrame([("A",), ("B",)], "stock_symbol string")
    filled = cd.carry_forward(b, dim).where("stock_symbol = 'B' AND trade_date = '2024-01-02'").collect()
    assert filled[0].t == "1704200000000" and filled[0].c == 2.0 and filled[0].Trans == 0


def test_news_load_twice_is_once(spark):
    wh = Warehouse(spark, S.scratch_path(spark, "t-news", unique=True))
    _symbols(spark, wh, ["S000001"])
    news = spark.createDataFrame(
        [(D(2024, 1, 1), 0, "t0", "u0", "20240101T100000", "Wire", "a.com", 0.1,
          [("Tech", "0.5")], [("S000001", "0.3"), ("XXX", "0.1")])],
        "file_date date, in_date_id long, title string, url string, time_published string, "
        "source string, source_domain string, overall_sentiment_score double, "
        "topics array<struct<topic:string,relevance_score:string>>, "
        "ticker_sentiment array<struct<ticker:string,ticker_sentiment_score:string>>")
    for _ in range(2):
        wh.load_news(news)
    counts = {t: wh.read(t).count() for t in ("source_DIM", "topic_DIM", "news_DIM",
                                               "new_sentiment_industry_FACT", "new_sentiment_stock_FACT")}
    assert counts == {"source_DIM": 1, "topic_DIM": 1, "news_DIM": 1,
                      "new_sentiment_industry_FACT": 1, "new_sentiment_stock_FACT": 1}
    assert wh.read("news_DIM").collect()[0].insert_date == D(2024, 1, 3)


def test_e7_e8_starter_model(spark):
    m = models.starter_model(spark)
    res = {(r.test, r.failures) for r in quality.run_data_tests(
        [("starter_model", m, "unique", ["id"]), ("starter_model", m, "not_null", ["id"])]).collect()}
    assert res == {("unique", 0), ("not_null", 1)}
    dup = spark.sql("SELECT 1 AS id UNION ALL SELECT 1 AS id")
    assert quality.run_data_tests([("m", dup, "unique", ["id"])]).collect()[0].failures == 1
    models.materialize_view(m, "starter_model")
    assert [r.id for r in models.filtered_model(spark, "starter_model", "id = 1").collect()] == [1]


def test_exchange_reseed_is_repeatable(spark):
    cur = spark.createDataFrame([(1, "x"), (7, "other")], "exchange_id smallint, exchange_name string")
    once = dm.reseed_exchanges(cur)
    twice = dm.reseed_exchanges(once)
    assert sorted(once.collect()) == sorted(twice.collect()) == sorted(
        [(1, "nasdaq"), (2, "nyse"), (3, "amex"), (7, "other")])


def test_numbering_equals_window_with_ties_and_nulls(spark):
    df = spark.range(0, 600).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 2).alias("g"), (F.col("id") * 31 % 601).alias("k"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 11).cast("string")).alias("s"), F.array("id").alias("nested"))
    w = Window.partitionBy("g").orderBy("k")
    want = sorted(map(str, df.withColumn("n", (F.row_number().over(w) - 1).cast("long")).collect()))
    for slices in (1, 7):
        assert sorted(map(str, numbering.number_within(df, ["g"], ["k"], "n", slices=slices).collect())) == want
    # ties: every number once in a group, smaller keys first
    rows = numbering.number_within(df, ["g"], ["s"], "n", slices=5).collect()
    assert len(rows) == 600
    for g in (None, 0, 1):
        of_group = sorted(((r.n, r.s) for r in rows if r.g == g), key=lambda x: x[0])
        assert [n for n, _ in of_group] == list(range(len(of_group)))
        assert [s or "" for _, s in of_group] == sorted(s or "" for _, s in of_group)
    assert numbering.number_within(df.where("false"), ["g"], ["k"], "n").collect() == []


def test_top_k_within_equals_rank(spark):
    df = spark.range(0, 3000).select((F.col("id") % 2).alias("g"), (F.col("id") * 31 % 3001).alias("k"))
    got = numbering.top_k_within(df.repartition(40), ["g"], [F.col("k")], 5)
    want = {(g, k) for g in (0, 1) for k in sorted(r.k for r in df.where(F.col("g") == g).collect())[:5]}
    assert {(r.g, r.k) for r in got.collect()} == want


def test_a_hot_day_is_landed_in_several_files(spark):
    from candleworks.sinks import landing as landing_sink
    from candleworks.sources import landing as landing_src

    base = S.scratch_path(spark, "t-hot-day", unique=True)
    rows = spark.range(0, 1000).select(F.concat(F.lit("S"), F.col("id")).alias("ticker"), F.lit(1.0).alias("o"),
                                       F.when(F.col("id") < 950, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02")).cast("date").alias("day"))
    landing_sink.write_daily_json(rows, base, "OHCL", "day", rows_a_file=100)
    assert landing_src.read_candles(spark, base).select("ticker").distinct().count() == 1000
    got = {r.object: (r.files, r.rows) for r in landing_src.objects(spark, base).collect()}
    assert got["OHCL_2024-01-01.json"][1] == 950 and got["OHCL_2024-01-01.json"][0] >= 10 and got["OHCL_2024-01-02.json"] == (1, 50)


def test_sql_functions_are_the_dataframe_rules(spark):
    from candleworks.functions import sql_functions

    sql_functions.register(spark)
    texts = ["1704153600000", "1704153600", "abc", "", None, "-1", "9" * 25, "253402300800000", "20240102T101010", "20241399", "2024"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    df.createOrReplaceTempView("t_texts")
    got = spark.sql("SELECT t, epoch_seconds_text(t) AS a, text_to_long(t) AS b, date_from_epoch_millis(t) AS c, publish_date(t) AS d FROM t_texts").collect()
    want = df.select("t", times.epoch_seconds_text("t").alias("a"), times.text_to_long("t").alias("b"),
                     times.date_from_epoch_millis_text("t").alias("c"), times.publish_date("t").alias("d")).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    ok = "t IN ('1704153600000', 'abc', '', '-1') OR t IS NULL"
    assert sorted(map(str, spark.sql(f"SELECT t, date_from_epoch_seconds(t) AS c FROM t_texts WHERE {ok}").collect())) == sorted(
        map(str, df.where(ok).select("t", times.date_from_epoch_seconds_text("t").alias("c")).collect()))


def test_landing_source_lists_empty_files_and_plans_one_day(spark):
    import os

    from candleworks.sinks import landing as landing_sink
    from candleworks.sources import landing as landing_src
    from candleworks.sources import landing_source

    base = S.scratch_path(spark, "t-source", unique=True)
    rows = spark.range(0, 200).select(F.concat(F.lit("S"), F.col("id")).alias("ticker"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    landing_sink.write_daily_json(rows, base, "OHCL", "day")
    os.makedirs(base.replace("file:", "") + "/object=OHCL_2024-12-31.json")
    open(base.replace("file:", "") + "/object=OHCL_2024-12-31.json/part-0.json", "w").close()
    files = landing_source.listed(spark, base)
    assert files.count() == 201 and files.rdd.getNumPartitions() == 4
    one = files.where(F.col("file_date") == F.lit(D(2024, 1, 5)))
    assert one.rdd.getNumPartitions() == 1 and [r.object for r in one.collect()] == ["OHCL_2024-01-05.json"]
    assert files.where(F.col("object").isin("OHCL_2024-01-05.json", "OHCL_2024-01-06.json", "none")).count() == 2
    assert files.where((F.col("file_date") >= F.lit(D(2024, 7, 1))) & (F.col("length") == 0)).count() == 1
    got = {r.object: (r.files, r.bytes > 0, r.rows) for r in landing_src.objects(spark, base).collect()}
    assert got["OHCL_2024-12-31.json"] == (1, False, 0) and got["OHCL_2024-01-05.json"] == (1, True, 1) and len(got) == 201
    assert [r.ticker for r in landing_src.read_day(spark, base, "OHCL", "2024-01-05", landing_src.schemas.CANDLE_RAW).collect()] == ["S4"]
    assert landing_src.read_day(spark, base, "OHCL", "2023-01-05", landing_src.schemas.CANDLE_RAW).collect() == []


def test_ledger_reads_an_object_once_and_a_changed_one_again(spark):
    """Rows in = loaded + quarantined + equal to stored, per file; an empty file and a malformed line are counted too."""
    import os

    from candleworks.plans import ledger
    from candleworks.sinks import landing as landing_sink

    base = S.scratch_path(spark, "t-ledger", unique=True)
    d = ["2024-01-01", "2024-01-02"]
    land = lambda rows: landing_sink.write_daily_json(_landing(spark, rows).withColumnRenamed("file_date", "day").coalesce(1), base, "OHCL", "day")
    land([("A", d[0], 1.0, _ms(d[0])), ("A", d[0], 1.0, _ms(d[0])), ("ZZZ", d[0], 2.0, _ms(d[0])), ("A", d[1], 3.0, _ms(d[1]))])
    folder = base.replace("file:", "") + f"/object=OHCL_{d[0]}.json"
    with open(os.path.join(folder, "part-junk.json"), "w") as fh:
        fh.write('{"ticker": "B", "o": 1.0, "time": \n')
    open(os.path.join(folder, "part-empty.json"), "w").close()
    wh = Warehouse(spark, S.scratch_path(spark, "t-ledger-wh", unique=True))
    _symbols(spark, wh, ["A", "B"])
    assert ledger.ingest(wh, "candles", base, wh.root + "/_q", max_files=3) == 4
    assert ledger.ingest(wh, "candles", base, wh.root + "/_q") == 0
    counts = lambda: sorted((r.object, r.rows_in, r.loaded, r.quarantined, r.equal) for r in ledger.entries(wh).collect())
    first = [(f"OHCL_{d[0]}.json", 0, 0, 0, 0), (f"OHCL_{d[0]}.json", 1, 0, 1, 0), (f"OHCL_{d[0]}.json", 4 - 1, 1, 1, 1), (f"OHCL_{d[1]}.json", 1, 1, 0, 0)]
    assert counts() == first
    assert [(r.reason, r.raw) for r in spark.read.json(wh.root + "/_q").where("raw is not null").collect()] == [("malformed", '{"ticker": "B", "o": 1.0, "time": ')]
    land([("A", d[1], 3.0, _ms(d[1])), ("B", d[1], 4.0, _ms(d[1]))])  # the object of the second day has changed
    assert ledger.ingest(wh, "candles", base, wh.root + "/_q") == 1
    assert counts() == sorted([*first, (f"OHCL_{d[1]}.json", 2, 1, 0, 1)])
    assert _fact_rows(wh) == [("A", d[0], 1.0, 100, 1), ("A", d[1], 3.0, 100, 1), ("B", d[1], 4.0, 100, 1)]


def test_carry_forward_plan_has_one_wide_shuffle(spark):
    b = bars(spark, [("A", D(2024, 1, 1), 1), ("A", D(2024, 1, 3), 2)])
    dim = spark.createDataFrame([("A",)], "stock_symbol string")
    rows = cd.carry_forward(b, dim).collect()
    assert [(str(r.trade_date), r.c) for r in sorted(rows, key=lambda r: r.trade_date)] == [
        ("2024-01-01", 1.0), ("2024-01-03", 2.0)]


def test_daily_step_takes_the_newest_object_once(spark, days):
    from candleworks.plans import daily
    from candleworks.sinks import landing as landing_sink
    from candleworks.streaming import incremental

    base = S.scratch_path(spark, "t-land", unique=True)
    land = _landing(spark, [r for d in days[:3] for r in d]).withColumnRenamed("file_date", "day")
    landing_sink.write_daily_json(land, base, "OHCL", "day")
    incremental.order_landing_by_day(spark, base)
    wh = Warehouse(spark, S.scratch_path(spark, "t-dailywh", unique=True))
    _symbols(spark, wh, ["A", "B", "C"])
    assert daily.load_newest_candles(wh, base) == D(2024, 1, 3)
    assert daily.load_newest_candles(wh, base) is None          # loaded already
    assert sorted((r.stock_symbol, r.c) for r in wh.read("candles_FACT").collect()) == [("C", 5.0)]


def test_stream_late_file_and_malformed_line(spark, days):
    """Days 1, 2, 4 are streamed; day 3 lands later (plus a malformed line). The
    stream's second run recomputes day 4's fills; the fact equals the backfill."""
    import os

    from candleworks.sinks import landing as landing_sink
    from candleworks.streaming import incremental

    base = S.scratch_path(spark, "t-stream-land", unique=True)

    def land(rows):
        df = _landing(spark, rows).withColumnRenamed("file_date", "day")
        landing_sink.write_daily_json(df, base, "OHCL", "day", mode="append")

    first = [r for i in (0, 1, 3) for r in days[i] if r[0] != "A" or i != 3]
    land(first)
    wh = Warehouse(spark, S.scratch_path(spark, "t-stream-wh", unique=True))
    _symbols(spark, wh, ["A", "B", "C", "D"])
    ckpt = wh.root + "/_ckpt"
    incremental.ingest_candles(spark, wh, base, ckpt, quarantine_dir=wh.root + "/_q", max_files=1)
    land(days[2])
    junk_dir = base.replace("file:", "") + "/object=OHCL_2024-01-03.json"
    with open(os.path.join(junk_dir, "part-99999-junk.json"), "w") as fh:
        fh.write('{"ticker": "B", "o": 1.0, "time": \n')
    incremental.ingest_candles(spark, wh, base, ckpt, quarantine_dir=wh.root + "/_q", max_files=1)

    ref = Warehouse(spark, S.scratch_path(spark, "t-stream-ref", unique=True))
    _symbols(spark, ref, ["A", "B", "C", "D"])
    ref.load_candles(_landing(spark, first + days[2]))
    assert _fact_rows(wh) == _fact_rows(ref)
    assert ("A", "2024-01-04", 3.0, 0, 0) in _fact_rows(wh)


@pytest.mark.parametrize("max_files", [1, 64])
def test_second_file_of_a_day_is_merged(spark, max_files):
    """A day in two files, whatever the batches: no row is lost, and rows in = loaded
    + quarantined."""
    from candleworks.sinks import landing as landing_sink
    from candleworks.streaming import incremental

    base = S.scratch_path(spark, "t-two-files", unique=True)
    d = ["2024-01-01", "2024-01-02"]
    files = [[("A", d[0], 1.0, _ms(d[0])), ("A", d[0], 1.0, "junk")], [("B", d[0], 2.0, _ms(d[0])), ("B", d[0], 2.0, "junk too")],
             [("A", d[1], 3.0, _ms(d[1]))], [("ZZZ", d[1], 9.0, _ms(d[1]))]]
    for rows in files:
        landing_sink.write_daily_json(_landing(spark, rows).withColumnRenamed("file_date", "day").coalesce(1), base, "OHCL", "day", mode="append")
    wh = Warehouse(spark, S.scratch_path(spark, "t-two-files-wh", unique=True))
    _symbols(spark, wh, ["A", "B"])
    incremental.ingest_candles(spark, wh, base, wh.root + "/_ckpt", quarantine_dir=wh.root + "/_q", max_files=max_files)
    assert _fact_rows(wh) == [("A", d[0], 1.0, 100, 1), ("A", d[1], 3.0, 100, 1), ("B", d[0], 2.0, 100, 1), ("B", d[1], 2.0, 0, 0)]
    assert sorted((r.time, r.reason) for r in spark.read.json(wh.root + "/_q").collect()) == [
        (_ms(d[1]), "unknown_ticker"), ("junk", "bad_time"), ("junk too", "bad_time")]


def test_news_of_a_day_in_two_loads_and_lines_without_identity(spark):
    def item(n, domain, topic):
        return (D(2024, 1, 1), n, f"t{n}", f"u{n}", "20240101T100000", "Wire", domain, 0.1, [(topic, "0.5")], [("A", "0.3")])

    wh = Warehouse(spark, S.scratch_path(spark, "t-news-two", unique=True))
    _symbols(spark, wh, ["A"])
    kind = ("file_date date, in_date_id long, title string, url string, time_published string, "
            "source string, source_domain string, overall_sentiment_score double, "
            "topics array<struct<topic:string,relevance_score:string>>, "
            "ticker_sentiment array<struct<ticker:string,ticker_sentiment_score:string>>")
    for rows in ([item(0, "b.com", "Tech"), item(1, "b.com", "Tech")], [item(1, "b.com", "Art"), item(2, "a.com", "Tech"), item(None, "c.com", "Tech")]):
        wh.load_news(spark.createDataFrame(rows, kind), wh.root + "/_q")
    assert sorted((r.in_date_id, r.title) for r in wh.read("news_DIM").collect()) == [(0, "t0"), (1, "t1"), (2, "t2")]
    names = {r.topic_id: r.topic_name for r in wh.read("topic_DIM").collect()}
    assert sorted((r.in_date_id, names[r.topic_id]) for r in wh.read("new_sentiment_industry_FACT").collect()) == [(0, "Tech"), (1, "Art"), (2, "Tech")]
    assert sorted(r.in_date_id for r in wh.read("new_sentiment_stock_FACT").collect()) == [0, 1, 2]
    assert [(r.source_name, r.source_domain) for r in wh.read("source_DIM").collect()] == [("Wire", "a.com")]
    assert [(r.title, r.reason) for r in spark.read.json(wh.root + "/_q").collect()] == [("tNone", "no_identity")]


def test_news_files_of_a_day_numbered_alike_at_any_batch_size(spark):
    from candleworks.sinks import landing as landing_sink
    from candleworks.streaming import incremental

    kind = ("file_date date, in_date_id long, title string, url string, time_published string, "
            "source string, source_domain string, overall_sentiment_score double, "
            "topics array<struct<topic:string,relevance_score:string>>, "
            "ticker_sentiment array<struct<ticker:string,ticker_sentiment_score:string>>")

    def item(n, name):
        return (D(2024, 1, 1), n, f"t{name}", f"u{name}", "20240101T100000", "Wire", "a.com", 0.1, [(f"T{name}", "0.5")], [("A", f"0.{name}")])

    files = [[item(0, 1), item(1, 2)], [item(0, 3), item(1, 4), item(2, 1)], [item(0, 1), item(1, 2)]]
    base = S.scratch_path(spark, "t-news-alike", unique=True)
    for rows in files:
        landing_sink.write_daily_json(spark.createDataFrame(rows, kind).coalesce(1), base, "news", "file_date", mode="append")
    got = []
    for size in (1, 64):
        wh = Warehouse(spark, S.scratch_path(spark, f"t-news-alike-{size}", unique=True))
        _symbols(spark, wh, ["A"])
        incremental.ingest_news(spark, wh, base, S.scratch_path(spark, "t-news-alike-ckpt", unique=True), max_files=size)
        titles = {r.in_date_id: r.title for r in wh.read("news_DIM").collect()}
        assert wh.read("news_DIM").count() == len(titles) == 4
        names = {r.topic_id: r.topic_name for r in wh.read("topic_DIM").collect()}
        got.append((sorted((titles[r.in_date_id], names[r.topic_id]) for r in wh.read("new_sentiment_industry_FACT").collect()),
                    sorted((titles[r.in_date_id], round(r.sentiment_score, 3)) for r in wh.read("new_sentiment_stock_FACT").collect())))
    assert got[0] == got[1] == ([(f"t{k}", f"T{k}") for k in range(1, 5)], [(f"t{k}", k / 10) for k in range(1, 5)])


def test_negative_volume_is_rejected_and_a_listed_twice_symbol_is_one(spark):
    wh = Warehouse(spark, S.scratch_path(spark, "t-range", unique=True))
    scr = spark.createDataFrame([("A", "A Inc", "US", "Tech", "Software", 2), ("A", "A Inc", "US", "Tech", "Software", 1)],
                                "Symbol string, Name string, Country string, Sector string, Industry string, exchange smallint")
    wh.init_schema()
    wh.load_dimensions(scr)
    wh.load_stock_symbols(scr)
    assert [(r.stock_symbol, r.exchange) for r in wh.read("stock_symbol_DIM").collect()] == [("A", 1)]
    rows = _landing(spark, [("A", "2024-01-01", 1.0, _ms("2024-01-01"))])
    wh.load_candles(rows.withColumn("v", F.lit(-5.0)), wh.root + "/_q")
    assert _fact_rows(wh) == []
    assert [r.reason for r in spark.read.json(wh.root + "/_q").collect()] == ["out_of_range"]


def test_moving_average_tables_incremental_equal_full(spark, days):
    wh = Warehouse(spark, S.scratch_path(spark, "t-ma", unique=True))
    _symbols(spark, wh, ["A", "B", "C", "D"])
    for d in days[:2]:
        wh.load_candles(_landing(spark, d))
    wh.compute_moving_averages()
    for d in days[2:]:
        wh.load_candles(_landing(spark, d))
    wh.compute_moving_averages(since=D(2024, 1, 3))
    fact = wh.read("candles_FACT")
    for table, n, col in (("shot_MA", 3, "c"), ("long_MA", 5, "c")):
        want = sorted((r.stock_symbol, r.t, round(r.ma, 6))
                      for r in indicators.moving_average(fact, col, n).collect())
        got = sorted((r.stock_symbol, r.t, round(r.ma, 6)) for r in wh.read(table).collect())
        assert got == want, table
    vol = sorted((r.stock_symbol, r.date, round(r.sliding_avg, 3)) for r in wh.read("avg_volume").collect())
    assert vol == sorted((r.stock_symbol, r.date, round(r.sliding_avg, 3))
                         for r in indicators.avg_volume(fact, 5).collect())
    wh.build_calendar()
    assert [r.date_id for r in wh.read("date_DIM").orderBy("date_id").collect()] == [
        "20240101", "20240102", "20240103", "20240104"]


def test_t19_empty_fact_gives_empty_indicator(spark):
    empty = bars(spark, [("A", D(2024, 1, 1), 1)]).where("false")
    assert indicators.ohcl_indicator(empty).collect() == []
    assert indicators.latest_trade_date(empty).collect()[0].max_date is None


def test_tests_from_spec_matches_starter_expectations(spark):
    models.materialize_view(models.starter_model(spark), "starter_model")
    models.materialize_view(models.filtered_model(spark, "starter_model", "id = 1"),
                            "starter_filtered")
    spec = {"models": [
        {"name": "starter_model", "columns": [{"name": "id", "data_tests": ["unique", "not_null"]}]},
        {"name": "starter_filtered", "columns": [{"name": "id", "data_tests": ["unique", "not_null"]}]}]}
    got = sorted((r.model, r.test, r.failures) for r in quality.tests_from_spec(spark, spec).collect())
    assert got == [("starter_filtered", "not_null", 0), ("starter_filtered", "unique", 0),
                   ("starter_model", "not_null", 1), ("starter_model", "unique", 0)]


def test_day_with_only_unknown_tickers_still_fills(spark):
    wh = Warehouse(spark, S.scratch_path(spark, "t-unknown-day", unique=True))
    _symbols(spark, wh, ["A"])
    wh.load_candles(_landing(spark, [("A", "2024-01-01", 1.0, _ms("2024-01-01"))]))
    wh.load_candles(_landing(spark, [("ZZZ", "2024-01-02", 9.0, _ms("2024-01-02"))]))
    assert _fact_rows(wh) == [("A", "2024-01-01", 1.0, 100, 1), ("A", "2024-01-02", 1.0, 0, 0)]


def test_indicator_sql_text_equals_dataframe(spark):
    from candleworks import fixtures as fx
    from candleworks.plans.sql import OHCL_INDICATOR

    fx.stored_candles(spark, "/root/testdata/sf0.001").createOrReplaceTempView("candles_FACT")
    via_sql = spark.sql(OHCL_INDICATOR)
    via_df = indicators.ohcl_indicator(fx.stored_candles(spark, "/root/testdata/sf0.001"))
    norm = lambda df: sorted((r.stock_symbol, r.date, round(r.delta, 6), round(r.sliding_avg_3, 6),
                              round(r.sliding_avg_5, 6)) for r in df.collect())
    assert norm(via_sql) == norm(via_df) and len(norm(via_df)) == 13
    plan = via_sql._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_date" in plan


def test_a4_newest_object_tie_goes_to_first_listed(spark):
    from candleworks.sinks import landing as landing_sink
    from candleworks.sources import landing as landing_src

    base = S.scratch_path(spark, "t-newest", unique=True)
    rows = _landing(spark, [("A", d, 1.0, _ms(d)) for d in ("2024-01-01", "2024-01-02", "2024-01-03")])
    landing_sink.write_daily_json(rows.withColumnRenamed("file_date", "day"), base, "OHCL", "day")
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    it = fs.listFiles(jvm.org.apache.hadoop.fs.Path(base), True)
    while it.hasNext():
        p = it.next().getPath().toString()
        if p.endswith(".json"):
            S.set_mtime(spark, p, 1_000_000 if "2024-01-01" in p else 2_000_000)  # 01-02, 01-03 tie
    listing = landing_src.objects(spark, base)
    assert landing_src.newest_object(listing).first()["object"] == "OHCL_2024-01-02.json"
    got = {r.object: (r.rows, str(r.file_date)) for r in listing.collect()}
    assert got["OHCL_2024-01-03.json"] == (1, "2024-01-03")


def test_carry_forward_of_a_hot_symbol_day_keeps_every_bar(spark):
    """Copies and distinct bars of one symbol and day pass as they are; what is carried is
    one row per symbol and day, so that is all a window sees."""
    rows = [("A", D(2024, 1, 1), 1)] * 50 + [("A", D(2024, 1, 1), 2 + i / 1000) for i in range(500)] + [("B", D(2024, 1, 3), 3)]
    b = bars(spark, rows)
    dim = spark.createDataFrame([("A",), ("B",)], "stock_symbol string")
    got = cd.carry_forward(b, dim).collect()
    assert len([r for r in got if not r.filled]) == 551
    assert [(r.stock_symbol, str(r.trade_date), r.c, r.v, r.Trans) for r in got if r.filled] == [("A", "2024-01-03", 2.499, 0, 0)]
    assert cd.last_of_day(b).count() == 2
    plan = cd.carry_forward(b, dim)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") >= 1 and "partial_max" in plan


def test_a_flat_bar_without_volume_is_no_fill(spark):
    """A traded bar of one price, no volume and no trades survives the recompute after a late day."""
    wh = Warehouse(spark, S.scratch_path(spark, "t-flat", unique=True))
    _symbols(spark, wh, ["A"])
    flat = _landing(spark, [("A", "2024-01-03", 7.0, _ms("2024-01-03"))]).withColumn("v", F.lit(0.0)).withColumn("trans", F.lit(0).cast("long"))
    for c in ("o", "h", "l", "c", "vwap"):
        flat = flat.withColumn(c, F.lit(7.0))
    wh.load_candles(_landing(spark, [("A", "2024-01-01", 1.0, _ms("2024-01-01"))]))
    wh.load_candles(flat)
    wh.load_candles(_landing(spark, [("A", "2024-01-02", 2.0, _ms("2024-01-02"))]))
    got = {str(r.trade_date): (r.c, r.filled) for r in wh.read("candles_FACT").collect()}
    assert got == {"2024-01-01": (1.0, False), "2024-01-02": (2.0, False), "2024-01-03": (7.0, False)}
    assert [(str(r.trade_date), r.rows, r.upto) for r in wh.days().orderBy("trade_date").collect()] == [
        ("2024-01-01", 1, 1), ("2024-01-02", 1, 2), ("2024-01-03", 1, 3)]


@pytest.mark.parametrize("n_days", [30, 300])
def test_indicator_reads_as_many_files_whatever_the_history(spark, n_days):
    wh = Warehouse(spark, S.scratch_path(spark, "t-days", unique=True))
    wh.init_schema()
    first = D(2023, 1, 1)
    b = bars(spark, [(s, first + dt.timedelta(days=i), i + 1) for i in range(n_days) for s in "AB"])
    rows = b.withColumnRenamed("trans", "Trans").withColumn("filled", F.lit(False)).repartition(4, "trade_date")
    wh.replace_partitions("candles_FACT", rows)
    plain = sorted(map(tuple, indicators.ohcl_indicator(wh.read("candles_FACT")).collect()))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = indicators.ohcl_indicator(wh.read("candles_FACT"), days=wh.days())
        assert sorted(map(tuple, df.collect())) == plain
        scans = _scans(df._jdf.queryExecution().executedPlan())
        files = {c.metrics().apply("numFiles").value() for c in scans if "stock_symbol" in c.toString()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert files and max(files) <= 3  # days of a side: the latest, the one before, the first rows' three


def _scans(plan):
    leaves = plan.collectLeaves()
    return [leaves.apply(i) for i in range(leaves.size()) if "numFiles" in leaves.apply(i).metrics().keySet().mkString(" ")]


NEWS_KIND = ("file_date date, in_date_id long, title string, url string, time_published string, "
             "source string, source_domain string, overall_sentiment_score double, "
             "topics array<struct<topic:string,relevance_score:string>>, "
             "ticker_sentiment array<struct<ticker:string,ticker_sentiment_score:string>>")
NEWS_TABLES = ("source_DIM", "topic_DIM", "news_DIM", "new_sentiment_industry_FACT", "new_sentiment_stock_FACT")


def _news_tables(wh):
    return {t: sorted(map(str, wh.read(t).collect())) for t in NEWS_TABLES}


def _land_news_files(spark, files, base):
    from candleworks.sinks import landing as landing_sink

    for i, rows in enumerate(files):
        landing_sink.write_daily_json(spark.createDataFrame(rows, NEWS_KIND).coalesce(1), base, "news", "file_date", mode="append")
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    it = fs.listFiles(jvm.org.apache.hadoop.fs.Path(base), True)
    found = []
    while it.hasNext():
        st = it.next()
        if st.getPath().getName().endswith(".json"):
            found.append((st.getModificationTime(), st.getPath().toString()))
    for i, (_, path) in enumerate(sorted(found)):  # a second apart, in the order they came
        S.set_mtime(spark, path, 1_700_000_000_000 + 1000 * i)


def test_news_tables_do_not_depend_on_batches(spark):
    """Items without url and title, versions of one item, items under one number, items of one
    title at different times, re-delivery: all five tables are equal for any batch size."""
    from candleworks.streaming import incremental

    day = D(2024, 1, 1)

    def item(n, name, score, time="20240101T100000", topic="T", source="Wire", file_date=day):
        known = name is not None
        return (file_date, n, f"t{name}" if known else None, f"u{name}" if known else None, time if known else None, source, "a.com", score,
                [(topic, str(score))], [("A", str(score))])

    files = [[item(0, None, 0.01), item(1, None, 0.02), item(2, None, 0.03), item(3, 1, 0.1)],
             [item(3, 2, 0.2), item(4, 1, 0.9, topic="New")],                       # a newer version of 1, and 2 under 1's number
             [item(0, 3, 0.3, source="Other"), item(5, 1, 0.5, time="20240101T110000")],  # 3 under a nameless item's number, 1's title at another time
             [item(0, None, 0.01), item(3, 2, 0.2)],                                    # re-delivery
             [item(0, 4, 0.4, file_date=D(2024, 1, 2))]]
    base = S.scratch_path(spark, "t-news-batches", unique=True)
    _land_news_files(spark, files, base)
    got = []
    for size in (1, 2, 64):
        wh = Warehouse(spark, S.scratch_path(spark, f"t-news-batches-{size}", unique=True))
        _symbols(spark, wh, ["A"])
        incremental.ingest_news(spark, wh, base, S.scratch_path(spark, "t-news-batches-ckpt", unique=True), max_files=size)
        got.append(_news_tables(wh))
    assert got[0] == got[1] == got[2]
    rows = {(str(r.insert_date), r.in_date_id): (r.title, r.overall_sentiment_score) for r in wh.read("news_DIM").collect()}
    assert wh.read("news_DIM").count() == len(rows) == 8
    scores = sorted(s for _, s in rows.values())
    assert scores == [0.01, 0.02, 0.03, 0.2, 0.3, 0.4, 0.5, 0.9]
    assert rows["2024-01-03", 0] == (None, 0.01) and rows["2024-01-03", 3] == ("t1", 0.9) and rows["2024-01-04", 0] == ("t4", 0.4)
    facts = {(str(r.insert_date), r.in_date_id): round(r.sentiment_score, 3) for r in wh.read("new_sentiment_stock_FACT").collect()}
    assert facts == {k: s for k, (_, s) in rows.items()}


def test_copies_in_landing_are_one_fact(spark):
    wh = Warehouse(spark, S.scratch_path(spark, "t-copies", unique=True))
    _symbols(spark, wh, ["A"])
    day = [("A", "2024-01-01", 1.0, _ms("2024-01-01"))] * 3
    wh.load_candles(_landing(spark, day))
    assert _fact_rows(wh) == [("A", "2024-01-01", 1.0, 100, 1)]


def test_read_day_and_daily_news_step(spark):
    from candleworks import schemas
    from candleworks.plans import daily
    from candleworks.sinks import landing as landing_sink
    from candleworks.sources import landing as landing_src
    from candleworks.streaming import incremental

    base = S.scratch_path(spark, "t-news-land", unique=True)
    items = spark.createDataFrame(
        [(D(2024, 1, d), 0, f"t{d}", f"u{d}", f"202401{d:02d}T100000", "Wire", "a.com", 0.1,
          [("Tech", "0.5")], [("A", "0.3")]) for d in (1, 2)],
        "file_date date, in_date_id long, title string, url string, time_published string, "
        "source string, source_domain string, overall_sentiment_score double, "
        "topics array<struct<topic:string,relevance_score:string>>, "
        "ticker_sentiment array<struct<ticker:string,ticker_sentiment_score:string>>")
    landing_sink.write_daily_json(items, base, "news", "file_date")
    incremental.order_landing_by_day(spark, base)
    assert landing_src.read_day(spark, base, "news", "2024-01-05", schemas.NEWS_RAW).count() == 0
    assert [r.title for r in landing_src.read_day(spark, base, "news", "2024-01-02",
                                                  schemas.NEWS_RAW).collect()] == ["t2"]
    wh = Warehouse(spark, S.scratch_path(spark, "t-news-daily", unique=True))
    _symbols(spark, wh, ["A"])
    assert daily.load_newest_news(wh, base) == D(2024, 1, 2)
    got = [(r.insert_date, r.title) for r in wh.read("news_DIM").collect()]
    assert got == [(D(2024, 1, 4), "t2")]
    assert [r.sentiment_score for r in wh.read("new_sentiment_stock_FACT").collect()] == [pytest.approx(0.3)]
    assert models.preview(wh.read("news_DIM"), 5).count() == 1


@pytest.mark.parametrize("name", ["grouped_daily_bars", "land_candles", "latest_day_close", "avg_volume"])
def test_bars_without_volume_equal_the_sql(spark, tmp_path, name):
    """Ticks of price 0 have size 0: a day of nothing else divides 0 by 0; a missing price is no volume at all."""
    import duckdb

    import __spark_entry__ as entry_mod

    at = dt.datetime
    ticks = [(1, at(2024, 1, 1, 10), 1, 0.0), (2, at(2024, 1, 1, 11), 1, 0.0), (3, at(2024, 1, 2, 10), 1, 2.5),
             (4, at(2024, 1, 2, 10), 2, 0.0), (5, at(2024, 1, 2, 11), 2, 4.0), (6, at(2024, 1, 2, 10), 3, 0.004), (7, at(2024, 1, 2, 10), 4, None)]
    events = tmp_path / "events.parquet"
    spark.createDataFrame(ticks, "event_id long, ts timestamp_ntz, user_id long, value double").coalesce(1).write.parquet(str(events))
    got = entry_mod.queries()[name](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{events}/*.parquet')")
    want = con.execute(entry_mod.oracle_sql()[name])
    order = [c[0] for c in want.description]
    assert sorted(map(str, (tuple(r) for r in got.select(*order).collect()))) == sorted(map(str, want.fetchall()))


@pytest.fixture(scope="module")
def no_volume(spark, tmp_path_factory):
    """Eight days of six symbols, of which some trade at price 0 only, on the first and the last day too; companies and news."""
    base = tmp_path_factory.mktemp("no-volume")
    ticks = [(100 * d + 10 * u + n, dt.datetime(2024, 1, 10 + d, 9 + n), u, 0.0 if (u + d) % 4 == 0 or u == 6 else 1.25 * u + d + n)
             for d in range(8) for u in range(1, 7) for n in range(1 + (u + d) % 3) if (u, d) not in ((3, 7), (5, 0), (2, 4))]
    made = {"events": (ticks, "event_id long, ts timestamp_ntz, user_id long, value double"),
            "supplier": ([(i, f"Company {i}", i % 3, 150.0 * i - 300) for i in range(1, 9)], "s_suppkey long, s_name string, s_nationkey long, s_acctbal double"),
            "nation": ([(0, "A", 0), (1, "B", 0), (2, "C", 1)], "n_nationkey long, n_name string, n_regionkey long"),
            "region": ([(0, "North"), (1, "South")], "r_regionkey long, r_name string"),
            "orders": ([(k, dt.datetime(2024, 1, 1 + k % 2), "1-URGENT", 100.0 * k) for k in range(1, 5)], "o_orderkey long, o_orderdate timestamp_ntz, o_orderpriority string, o_totalprice double"),
            "lineitem": ([(k, 1, k, n, 0.05, 0.02 * n) for k in range(1, 4) for n in (1, 2)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_discount double, l_tax double"),
            "part": ([(1, "Brand#11")], "p_partkey long, p_brand string")}
    for name, (table, schema) in made.items():
        spark.createDataFrame(table, schema).coalesce(1).write.parquet(str(base / f"{name}.parquet"))
    return base


@pytest.mark.parametrize("name", ["avg_close_first_5_rows", "avg_close_last_n_days", "candle_scan_projection", "candles_right_join_dim", "carry_forward_history",
                                  "carry_forward_last_day", "close_delta", "co_located_join", "data_test_not_null", "date_dim", "data_test_unique",
                                  "epoch_text_to_date", "first_rows_dates", "incremental_candles", "insert_select", "landing_audit", "latest_trade_date",
                                  "load_candles"])
def test_queries_over_bars_without_volume_equal_the_sql(spark, no_volume, name):
    import duckdb

    import __spark_entry__ as entry_mod

    con = duckdb.connect()
    for table in ("events", "supplier", "nation", "region", "orders", "lineitem", "part"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{no_volume}/{table}.parquet/*.parquet')")
    want = con.execute(entry_mod.oracle_sql()[name])
    order = [c[0] for c in want.description]
    want = sorted(map(str, want.fetchall()))
    assert want and sorted(map(str, (tuple(r) for r in entry_mod.queries()[name](spark, str(no_volume)).select(*order).collect()))) == want


def test_vwap_without_volume_is_the_ieee_quotient(spark):
    from candleworks.operators import bars as bars_op

    ticks = spark.createDataFrame([("A", 0.0, 0), ("B", 2.0, 3), ("B", 4.0, 1), ("C", 3.0, 2), ("C", 1.0, -2), ("D", None, None)], "s string, p double, n long").withColumn(
        "ts", F.lit(dt.datetime(2024, 1, 2, 9)))
    got = {r.stock_symbol: r.vwap for r in bars_op.daily_bars(ticks, F.col("s"), "ts", "p", F.col("n")).collect()}
    assert str(got.pop("A")) == "nan"
    assert got == {"B": 2.5, "C": float("inf"), "D": None}


def test_object_names_are_found_in_long_paths(spark):
    """The name comes from the path's last two names; the time it takes follows the path's length, not its square."""
    import time

    from candleworks.sources.screener import object_name

    far = "file:/shared/" + "a" * 8000
    want = {f"{far}/object=OHCL_2024-01-02.json/part-00000-x.c000.json": "OHCL_2024-01-02.json", f"{far}/nyse.csv/part-1": "nyse.csv",
            f"{far}/day=1/news_2024-01-02.json": "news_2024-01-02.json", f"{far}/part-00000.json": "part-00000.json", f"{far}.json/x=y.json": "y.json",
            f"{far}.json/deeper/part-0": "", f"{far}/.json": "", f"{far}/a.json/b": "", "nasdaq.csv": "nasdaq.csv"}
    paths = spark.createDataFrame([(p,) for p in want], "path string").crossJoin(spark.range(25)).coalesce(1)
    began = time.monotonic()
    got = paths.select("path", object_name("path").alias("name")).groupBy("path", "name").count().collect()
    assert time.monotonic() - began < 15
    assert {r.path: r["name"] for r in got} == want
    assert [r["count"] for r in got] == [25] * len(want)


# ---- news tables and objects: a file a day --------------------------------------------

def _news_days(spark, days, items, parts):
    """``items`` items on each of ``days`` days, every day in every one of ``parts`` splits; the last item of a day has no number."""
    rows = [(D(2024, 1, 1) + dt.timedelta(days=d), n if n < items else None, f"t{n}", f"u{n:03}", f"202401{d + 1:02}T1000{n:02}", "Wire", "a.com", n / 100,
             [("T", "0.5"), ("U", "0.25")], [("A", str(n / 100)), ("B", "0.5")]) for d in range(days) for n in range(items + 1)]
    return spark.createDataFrame(rows, NEWS_KIND).repartition(parts, "in_date_id")


def _files_a_day(spark, path, day):
    return {r[0]: r[1] for r in spark.read.option("basePath", path).load(path, format="binaryFile", recursiveFileLookup=True, pathGlobFilter="part-*")
            .select(F.regexp_extract("path", f"{day}=([^/]+)/", 1).alias("day")).groupBy("day").count().collect()}


@pytest.mark.parametrize("way", ["load_news", "quarantine_news", "incremental_news"])
def test_news_tables_have_a_file_a_day_and_piece(spark, way, monkeypatch):
    """Not one of every task that has rows of the day; a hot day has a file for every so many items."""
    from candleworks.plans import warehouse
    from candleworks.streaming import incremental

    items, usable = _news_days(spark, 3, 6, 5), F.col("in_date_id").isNotNull()
    wh = Warehouse(spark, S.scratch_path(spark, f"t-files-{way}", unique=True))
    _symbols(spark, wh, ["A"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small tables are otherwise one task's
    try:
        if way == "load_news":
            wh.load_news(items.where(usable).withColumn("overall_sentiment_score", F.col("overall_sentiment_score") + 1))
        elif way == "quarantine_news":
            wh.load_news(items, wh.root + "/_q", "b")
            back = spark.read.json(wh.root + "/_q")
            assert sorted((str(r.file_date), r.title, r.reason) for r in back.collect()) == [(f"2024-01-0{d}", "t6", "no_identity") for d in (1, 2, 3)]
            assert not {*warehouse.KEYED} & {*back.columns}
        else:
            base = S.scratch_path(spark, "t-files-land", unique=True)
            from candleworks.sinks import landing as landing_sink
            landing_sink.write_daily_json(items.where(usable), base, "news", "file_date")
            incremental.ingest_news(spark, wh, base, S.scratch_path(spark, "t-files-ckpt", unique=True))
        facts = {"news_DIM": 18, "new_sentiment_stock_FACT": 18, "new_sentiment_industry_FACT": 36}
        for t, n in facts.items():
            assert wh.read(t).count() == n
            assert _files_a_day(spark, wh.path(t), "insert_date") == {f"2024-01-0{d}": 1 for d in (3, 4, 5)}
        assert sorted((r.in_date_id, r.title) for r in wh.read("news_DIM").where("insert_date = '2024-01-03'").collect()) == [(n, f"t{n}") for n in range(6)]
        if way == "load_news":  # newer versions of a hot day
            before = _news_tables(wh)
            monkeypatch.setattr(warehouse, "ITEMS_A_FILE", 1)
            wh.load_news(items.where(usable))
            assert all(k > 1 for k in _files_a_day(spark, wh.path("new_sentiment_industry_FACT"), "insert_date").values())
            after = _news_tables(wh)
            assert {t: after[t] == before[t] for t in NEWS_TABLES} == {t: t != "news_DIM" for t in NEWS_TABLES}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_versions_of_news_are_chosen_with_one_move_of_the_rows(spark):
    """The join with the winning versions and the dropping of copies need nested rows dealt once."""
    from candleworks.plans import warehouse

    wh = Warehouse(spark, S.scratch_path(spark, "t-moves", unique=True))
    _symbols(spark, wh, ["A"])
    rows = _news_days(spark, 2, 4, 3).where("in_date_id is not null").withColumn("modified", F.lit(5))
    keyed = warehouse._keyed(rows.unionByName(rows).unionByName(rows.withColumn("modified", F.lit(4)).withColumn("source", F.lit("Old"))))
    items = wh._items(keyed).checkpoint()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fresh = wh._fresh(keyed.checkpoint(), items)
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert sorted((str(r.file_date), r.in_date_id, r.source) for r in fresh.collect()) == [(f"2024-01-0{d}", n, "Wire") for d in (1, 2) for n in range(4)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") <= 2  # rows and winners


def test_pieces_of_a_group_are_numbered_like_the_group(spark):
    """Cut at any size, with nulls and ties: the same numbers as a window over whole groups."""
    df = spark.range(0, 600).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 2).alias("g"), F.when(F.col("id") % 5 > 0, (F.col("id") % 11).cast("string")).alias("s"),
        (F.col("id") * 31 % 601).alias("k"), F.array("id").alias("nested")).repartition(5)
    w = Window.partitionBy("g").orderBy("s", "k")
    want = sorted(map(str, df.withColumn("n", (F.row_number().over(w) - 1).cast("long")).collect()))
    for piece in (1, 7, 100, 1000):
        assert sorted(map(str, numbering.number_and_deal(df, "g", ["s", "k"], "n", 6, piece).collect())) == want
    ties = numbering.number_and_deal(df, "g", ["s"], "n", 6, 10).collect()
    for g in (None, 0, 1):
        of_group = sorted(((r.n, r.s) for r in ties if r.g == g), key=lambda x: x[0])
        assert [n for n, _ in of_group] == list(range(len(of_group)))
        assert [s or "" for _, s in of_group] == sorted(s or "" for _, s in of_group)
    assert numbering.number_and_deal(df.where("false"), "g", ["k"], "n", 3).collect() == []


def test_land_news_moves_nested_rows_once(spark):
    """They are numbered where they are written: nothing is moved after the first exchange."""
    from candleworks.plans import landing_jobs
    from candleworks.sources import landing as landing_src

    feed = _news_days(spark, 3, 5, 4).drop("file_date", "in_date_id").checkpoint()
    plan = landing_jobs.news_objects(feed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange range" not in plan
    base = S.scratch_path(spark, "t-land-once", unique=True)
    landing_jobs.land_news(feed, base)
    rows = landing_src.read_news(spark, base).collect()
    assert sorted((str(r.file_date), r.in_date_id, r.title, len(r.topics)) for r in rows) == [(f"2024-01-0{d}", n, f"t{n}", 2) for d in (1, 2, 3) for n in range(6)]
    assert _files_a_day(spark, base, "object") == {f"news_2024-01-0{d}.json": 1 for d in (1, 2, 3)}


def test_tables_are_listed_by_a_bounded_number_of_tasks(spark):
    """Not by a task for each day's folder; a number that the session has chosen stays."""
    try:
        spark.conf.unset(S.LISTING_TASKS)
        S.configure(spark)
        assert int(spark.conf.get(S.LISTING_TASKS)) <= max(32, 4 * spark.sparkContext.defaultParallelism)
        spark.conf.set(S.LISTING_TASKS, "7")
        S.configure(spark)
        assert spark.conf.get(S.LISTING_TASKS) == "7"
    finally:
        spark.conf.unset(S.LISTING_TASKS)
        S.configure(spark)
