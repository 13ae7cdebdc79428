"""The warehouse: 16 parquet tables below one shared folder, and the composite
jobs that fill them (initial load, daily candles, indicators, daily news).

Every job is repeatable: partitioned tables are written with dynamic partition
overwrite (a re-run replaces the days it writes), dimensions only ever receive
members they do not hold yet, and whole-table rewrites go beside the old table
and are swapped in when complete.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleworks import schemas
from candleworks import session as _session
from candleworks.functions import sql_functions
from candleworks.operators import candles as cd
from candleworks.operators import dimensions as dm
from candleworks.operators import indicators
from candleworks.operators import news as ns
from candleworks.operators.numbering import number_within
from candleworks.sinks import tables as sink


class Warehouse:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = _session.configure(spark)
        self.root = (root or _session.scratch_path(spark, "warehouse")).rstrip("/")

    # ---- catalog ------------------------------------------------------------------
    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        return _session.path_exists(self.spark, self.path(table))

    def read(self, table: str) -> DataFrame:
        """Whole-table scan with the contract schema (``select * from T``)."""
        return sink.read_table(self.spark, self.path(table), table)

    def register_views(self) -> None:
        """Expose every existing table to SQL under its contract name."""
        for t in schemas.TABLES:
            if self.exists(t):
                self.read(t).createOrReplaceTempView(t)

    def sql(self, text: str) -> DataFrame:
        """Run arbitrary SQL over the warehouse tables; the date rules are at hand as functions
        (:mod:`candleworks.functions.sql_functions`)."""
        self.register_views()
        sql_functions.register(self.spark)
        return self.spark.sql(text)

    def catalog(self) -> DataFrame:
        """(table_name, n_columns, n_rows) for every contract table."""
        parts = []
        for t, meta in schemas.TABLES.items():
            rows = self.read(t).agg(F.count(F.lit(1)).alias("n_rows")) if self.exists(t) else \
                self.spark.range(1).select(F.lit(None).cast("long").alias("n_rows"))
            parts.append(rows.select(F.lit(t).alias("table_name"),
                                     F.lit(len(meta["schema"].fields)).cast("long").alias("n_columns"),
                                     "n_rows"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    # ---- writes -------------------------------------------------------------------
    def append(self, table: str, df: DataFrame) -> None:
        sink.write_table(df, self.path(table), table, mode="append")

    def replace_partitions(self, table: str, df: DataFrame) -> None:
        sink.write_table(df, self.path(table), table, mode="overwrite")

    def replace_table(self, table: str, df: DataFrame) -> None:
        meta = schemas.TABLES[table]
        sink.write_beside_then_swap(sink.conform(df, table), self.path(table),
                                    meta.get("partition"), meta.get("sort"))

    # ---- M1: schema ---------------------------------------------------------------
    def init_schema(self) -> list[str]:
        """Create every missing table, then reseed the exchange dimension. The 16
        creations are independent tiny jobs, submitted from a few threads at once."""
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max_workers=8) as pool:
            made = list(pool.map(lambda t: sink.create_if_missing(self.spark, self.path(t), t),
                                 schemas.TABLES))
        created = [t for t, m in zip(schemas.TABLES, made) if m]
        # Written beside the old table and swapped in, so reading it here is safe.
        self.replace_table("exchange_DIM", dm.reseed_exchanges(self.read("exchange_DIM")))
        return created

    # ---- M2 / M3: dimensions and symbols -------------------------------------------
    def load_dimensions(self, screener: DataFrame) -> None:
        s = dm.clean_screener(screener)
        for column, dim in dm.SCREENER_DIMS.items():
            rows = dm.load_dimension(s, column, dim, current=self.read(dim.table))
            self.append(dim.table, rows)

    def load_stock_symbols(self, screener: DataFrame) -> None:
        """Symbols not in the table yet, with their member ids (re-run safe)."""
        s = dm.clean_screener(screener)
        rows = dm.stock_symbols(s, self.read("country_DIM"), self.read("sector_DIM"),
                                self.read("industry_DIM"))
        rows = rows.join(self.read("stock_symbol_DIM").select("stock_symbol"), "stock_symbol", "left_anti")
        # A symbol on two exchange lists is one symbol, of the smallest exchange id.
        others = [c for c in rows.columns if c != "stock_symbol"]
        first = F.struct("exchange", *[c for c in others if c != "exchange"])
        rows = rows.groupBy("stock_symbol").agg(F.min(first).alias("_first"))
        self.append("stock_symbol_DIM", rows.select("stock_symbol", *[F.col(f"_first.{c}").alias(c) for c in others]))

    # ---- days of the candle fact ----------------------------------------------------
    def days(self) -> DataFrame:
        """``trade_date``, ``rows``, ``upto`` and ``nulls`` of every loaded day, as the loads keep them: counted
        from the rows that a load writes, so neither dates nor null tests need a scan of the fact. A
        fact that no load has counted yet is counted once."""
        path = self.path(LOADED_DAYS)
        if not _session.path_exists(self.spark, path):
            self._write_days(indicators.day_counts(self.read("candles_FACT")))
        return self.spark.read.schema(schemas.LOADED_DAYS).parquet(path)

    def _write_days(self, counts: DataFrame) -> None:
        # A row a trading day, so one file; a reader of the old folder finds a whole table.
        out = sink.typed(indicators.running_days(counts), schemas.LOADED_DAYS).coalesce(1)
        sink.write_beside_then_swap(out, self.path(LOADED_DAYS), sort_by=["trade_date"])

    def _count_days(self, written: DataFrame, before: DataFrame) -> None:
        """Days that were written have the rows that were written; others keep theirs."""
        counts = _materialized(indicators.day_counts(written))
        others = before.select("trade_date", "rows", "nulls").join(counts.select("trade_date"), "trade_date", "left_anti")
        self._write_days(_materialized(counts.unionByName(others)))

    def co_located(self, tables: dict[str, DataFrame], buckets: int, prefix: str = "co_located_") -> dict[str, DataFrame]:
        """Write frames as catalog tables in ``buckets`` buckets of ``stock_symbol`` (sorted by it), so that joins
        and groupings by symbol among them need no shuffle. Returned read back, by name."""
        out = {}
        for name, rows in tables.items():
            (rows.write.mode("overwrite").format("parquet").option("path", self.path(prefix + name))
             .bucketBy(buckets, "stock_symbol").sortBy("stock_symbol").saveAsTable(prefix + name))
            out[name] = self.spark.table(prefix + name)
        return out

    # ---- M4: candles --------------------------------------------------------------
    def load_candles(self, landing_rows: DataFrame, quarantine_dir: str | None = None,
                     batch: str | None = None) -> bool:
        """Load landed bars of any set of days (one day per run normally).

        A bar that the fact holds already is skipped (re-delivery); a further file of a
        known day is merged into that day, so the fact doesn't depend on how the files
        were batched. If anything is new before the newest loaded day, the carry-forward
        of every later day is recomputed, so late files never leave stale fills behind.
        Rejected rows are written once per ``batch`` (a retried batch of the same name
        replaces only its own). Returns whether anything was new."""
        return self._load_candles(landing_rows, quarantine_dir, batch, counted=False)[0]

    def load_candle_objects(self, landing_rows: DataFrame, quarantine_dir: str | None = None,
                            batch: str | None = None) -> DataFrame:
        """As :meth:`load_candles`; returns ``file``, ``rows_in``, ``loaded``, ``quarantined`` and ``equal``
        (to a stored or another landed bar) of every landed file (column ``file``)."""
        return self._load_candles(landing_rows, quarantine_dir, batch, counted=True)[1]

    def _load_candles(self, landing_rows: DataFrame, quarantine_dir: str | None, batch: str | None,
                      counted: bool) -> tuple[bool, DataFrame | None]:
        dim = self.read("stock_symbol_DIM").select("stock_symbol")
        fact = self.read("candles_FACT")
        incoming = cd.with_trade_date(landing_rows)
        if quarantine_dir:
            self._quarantine(cd.quarantine(incoming, dim), quarantine_dir, batch)
        landed = cd.landed_days(incoming)
        lo, hi = landed.agg(F.min("trade_date"), F.max("trade_date")).first()
        near = fact.where(F.col("trade_date").between(F.lit(lo), F.lit(hi))) if lo is not None else fact.where("false")
        # A bar delivered twice is one fact; distinct bars of one symbol-day are kept and
        # reported by the unique test. Dropping copies combines map-side.
        rows = cd.accepted(incoming, dim).withColumnRenamed("trans", "Trans").withColumn("filled", F.lit(False))
        rows = rows.select("file", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.schema_of("candles_FACT").fields])
        bars = rows.groupBy(*cd.FACT_COLS).agg(F.min("file").alias("file"))
        bars = cd.not_stored(bars, near)
        counts = _materialized(_object_counts(incoming, cd.quarantine(incoming, dim), bars)) if counted else None
        if lo is None:  # no usable row: leave every table as it is
            return False, counts
        bars = bars.select(*[f.name for f in schemas.schema_of("candles_FACT").fields])
        new_days = landed.join(near.select("trade_date").distinct(), "trade_date", "left_anti")
        first_new = (bars.select("trade_date").unionByName(new_days.select("trade_date"))
                     .agg(F.min("trade_date")).first()[0])
        if first_new is None:  # everything is stored already
            return False, counts
        loaded = self.days()
        from_new = F.col("trade_date") >= F.lit(first_new)
        seed_day = loaded.where(F.col("trade_date") < F.lit(first_new)).agg(F.max("trade_date")).scalar()
        seed = fact.where(F.col("trade_date") == seed_day)
        # Stored trades from that day on take part in the recompute.
        todo = bars.unionByName(cd.traded(fact.where(from_new)).select(*bars.columns))
        days = landed.where(from_new).unionByName(fact.where(from_new).select("trade_date", "t"))
        out = _materialized(cd.carry_forward(todo, dim, seed=seed, days=days))
        before = _materialized(loaded)
        self.replace_partitions("candles_FACT", out)
        self._count_days(out, before)
        return True, counts

    @staticmethod
    def _quarantine(rows: DataFrame, quarantine_dir: str, batch: str | None) -> None:
        """Rejected landing rows as NDJSON, one object per day (``OHCL_<day>.json``) below
        the folder of their batch, so no batch replaces another's rows. A line that couldn't be parsed
        is kept as its text (``raw``), under the day of its object."""
        from candleworks.sinks import landing as landing_sink
        landing_sink.write_daily_json(
            rows.select(F.col("stock_symbol").alias("ticker"), "o", "c", "h", "l", "v", "vwap",
                        F.col("t").alias("time"), "trans", "reason", "raw", F.col("object").alias("landed_as"),
                        F.coalesce("trade_date", "file_date").alias("trade_date")),
            f"{quarantine_dir}/batch={batch or uuid.uuid4().hex}", "OHCL", "trade_date", mode="overwrite")

    # ---- M5: indicators -----------------------------------------------------------
    def compute_indicators(self) -> None:
        """Indicator rows of the latest date; re-running replaces that date."""
        rows = indicators.ohcl_indicator(self.read("candles_FACT"), days=self.days())
        self.replace_partitions("ohcl_indicator", rows)

    # ---- F1 F2 F3 / B13: moving averages and the calendar ----------------------------
    def compute_moving_averages(self, since=None, short: int = 3, long: int = 5,
                                volume: int = 5) -> None:
        """Fill shot_MA, long_MA and avg_volume for the trading days from ``since``
        (default: all). Each needs the previous ``n - 1`` trading days of history,
        (the load keeps a row for every known symbol and day from its first trade on),
        so the fact is read from the earliest such day on (a partition filter on a date from the
        loaded days: what is read doesn't grow with the history), and
        only days >= ``since`` are written (their partitions replaced). One shuffle by symbol serves
        the three averages."""
        fact = self.read("candles_FACT")
        rows, start = fact, None
        if since is not None:
            start = F.lit(since).cast("date")
            back = (self.days().where(F.col("trade_date") < start).orderBy(F.col("trade_date").desc())
                    .limit(max(short, long, volume) - 1).agg(F.min("trade_date")).scalar())
            rows = fact.where(F.col("trade_date") >= F.coalesce(back, start))
        made = indicators.moving_averages(rows, short, long, volume)
        made = _materialized(made if start is None else made.where(F.col("trade_date") >= start))
        self.replace_partitions("shot_MA", made.withColumnRenamed("short_ma", "ma"))
        self.replace_partitions("long_MA", made.withColumnRenamed("long_ma", "ma"))
        self.replace_partitions("avg_volume", made.select("stock_symbol", F.col("trade_date").alias("date"),
                                                          F.col("avg_volume").alias("sliding_avg")))

    def build_calendar(self) -> None:
        """date_DIM over the fact's first..last trade date (whole table, swapped in)."""
        self.replace_table("date_DIM", dm.calendar(self.read("candles_FACT")))

    # ---- M6: news -----------------------------------------------------------------
    def load_news(self, news: DataFrame, quarantine_dir: str | None = None, batch: str | None = None) -> None:
        """Sources, topics, news items and both sentiment facts for the given items
        (any number of file days).

        An item of a day is one of its url, title and publish time (:func:`news.item_key`). Of its
        versions the one whose object was modified last stays (``modified``, the time of the load for rows
        that are of no object; of one time, the one of the greatest digest), whether they come in one batch or in several. An item keeps the
        number in the day that it came under; where several came under one, the first seen keeps it
        and the others follow after the day's greatest. All this follows from the set of
        items, so the tables don't depend on batches. Lines that can't be parsed or have no day or number are not loaded but
        written to ``quarantine_dir``, once per ``batch``."""
        self._load_news(news, quarantine_dir, batch)

    def load_news_objects(self, news: DataFrame, quarantine_dir: str | None = None, batch: str | None = None) -> DataFrame:
        """As :meth:`load_news`; returns ``file``, ``rows_in``, ``loaded``, ``quarantined`` and ``equal`` (to
        a version that is stored, or older than one) of every landed file."""
        return self._load_news(news, quarantine_dir, batch, counted=True)

    def _load_news(self, news: DataFrame, quarantine_dir: str | None, batch: str | None, counted: bool = False) -> DataFrame | None:
        for name, kind in (("file", "string"), ("object", "string"), ("modified", "bigint"), (schemas.CORRUPT, "string")):
            if name not in news.columns:
                news = news.withColumn(name, F.lit(None).cast(kind))
        news = news.withColumn("modified", F.coalesce("modified", F.lit(time.time_ns() // 1000)))
        news = _keyed(news).persist()  # memory, spilling to disk: it feeds several writes
        usable = F.col("file_date").isNotNull() & F.col("in_date_id").isNotNull() & F.col(schemas.CORRUPT).isNull()
        reason = F.when(F.col(schemas.CORRUPT).isNotNull(), F.lit("malformed")).otherwise(F.lit("no_identity"))
        try:
            if quarantine_dir:
                (news.where(~usable).drop(*KEYED).withColumn("reason", reason).withColumnRenamed(schemas.CORRUPT, "raw").write.mode("overwrite")
                 .json(f"{quarantine_dir}/batch={batch or uuid.uuid4().hex}"))
            rows = news.where(usable)
            items = _materialized(self._items(rows))
            fresh = self._fresh(rows, items)
            counts = _materialized(_object_counts(news, news.where(~usable), fresh)) if counted else None
            self._write_news(fresh, items)
            return counts
        finally:
            news.unpersist()

    def _items(self, news: DataFrame) -> DataFrame:
        """Every item of the days that ``news`` (keyed) touches, stored ones too: ``_day``, ``item``, ``want``,
        ``first_seen``, ``modified``, ``tie``, its ``number``, whether it ``had`` one and whether its version is of this batch
        (``_fresh``). Only flat keys are grouped; nested rows are not."""
        came = news.groupBy("_day", "item").agg(
            F.max(F.struct("modified", "tie")).alias("version"), F.min("want").alias("want"), F.min("modified").alias("first_seen"),
        ).withColumn("_new", F.lit(True))
        stored = self._stored_items().join(F.broadcast(came.select("_day").distinct()), "_day", "left_semi").select(
            "_day", "item", F.struct("modified", "tie").alias("version"), "want", "first_seen", F.lit(False).alias("_new"))
        stored = stored.groupBy("_day", "item").agg(*[F.max(c).alias(c) for c in ("version", "want", "first_seen", "_new")])
        both = came.unionByName(stored).groupBy("_day", "item").agg(
            F.max(F.struct("version", (~F.col("_new")).alias("_stored"))).alias("best"), F.min("want").alias("want"),
            F.min("first_seen").alias("first_seen"), (F.count(F.when(~F.col("_new"), 1)) > 0).alias("had"))
        items = both.select("_day", "item", "want", "first_seen", F.col("best.version.modified").alias("modified"),
                            F.col("best.version.tie").alias("tie"), (~F.col("best._stored")).alias("_fresh"), "had")
        of_number = items.groupBy("_day", "want").agg(F.min(F.struct("first_seen", "item")).alias("_holder"))
        placed = _materialized(items.join(of_number, ["_day", "want"]).withColumn("_keeps", F.col("_holder.item") == F.col("item")).drop("_holder"))
        moved = placed.where(~F.col("_keeps"))
        numbers = placed.where("_keeps").withColumn("number", F.col("want"))
        if not moved.isEmpty():
            last = placed.groupBy("_day").agg(F.max("want").alias("_last"))
            moved = number_within(moved, ["_day"], ["want", "first_seen", "item"], "_k").join(last, "_day")
            numbers = numbers.unionByName(moved.withColumn("number", F.col("_last") + 1 + F.col("_k")).drop("_last", "_k"))
        return numbers.drop("_keeps")

    def _stored_items(self) -> DataFrame:
        return sink.read_table(self.spark, self.path("news_DIM"), "news_DIM", schemas.NEWS_ITEM.fields).where("item is not null").withColumnRenamed("insert_date", "_day")

    def _fresh(self, news: DataFrame, items: DataFrame) -> DataFrame:
        """The rows of this batch (keyed) that are to be stored, one for each item, under its number."""
        won = items.where("_fresh").select("_day", "item", F.col("modified").alias("_modified"), F.col("tie").alias("_tie"),
                                           F.col("want").alias("_want"), "first_seen", "number")
        same = ["_day", "item"]
        # Bounds, and not equality, keep the version out of the join's keys: nested rows then move once, to where copies are dropped.
        won_version = F.col("modified").between(F.col("_modified"), F.col("_modified")) & F.col("tie").between(F.col("_tie"), F.col("_tie"))
        rows = news.join(won, same).where(won_version)
        rows = rows.drop("_modified", "_tie", "want").withColumnRenamed("_want", "want")
        return rows.withColumn("in_date_id", F.col("number")).dropDuplicates(same)

    def _write_news(self, fresh: DataFrame, items: DataFrame) -> None:
        fresh = _materialized(fresh)
        self._load_sources(fresh)
        self.append("topic_DIM", ns.new_topics(fresh, self.read("topic_DIM")))
        of_item, whole = schemas.NEWS_ITEM.fields[:1], schemas.NEWS_ITEM.fields
        names = tuple(f.name for f in whole)
        # The items' own table comes last: a retried batch then finds its items still to be stored.
        for table, rows, extra in (
                ("new_sentiment_industry_FACT", ns.topic_facts(fresh, self.read("topic_DIM"), ("item",)), of_item),
                ("new_sentiment_stock_FACT", ns.stock_facts(fresh, self.read("stock_symbol_DIM"), ("item",)), of_item),
                ("news_DIM", ns.news_rows(fresh, self.read("source_DIM"), names), whole)):
            held = sink.read_table(self.spark, self.path(table), table, extra)
            held = held.join(F.broadcast(items.select(F.col("_day").alias("insert_date")).distinct()), "insert_date", "left_semi")
            state = items.select(F.col("_day").alias("insert_date"), "item", "number", "_fresh", F.col("want").alias("_want"),
                                 F.col("first_seen").alias("_first_seen"))
            kept = held.join(state, ["insert_date", "item"], "left").where("_fresh is null or not _fresh")
            kept = kept.withColumn("in_date_id", F.coalesce("number", "in_date_id"))
            if extra is whole:
                kept = kept.withColumn("want", F.coalesce("_want", "want")).withColumn("first_seen", F.coalesce("_first_seen", "first_seen"))
            out = sink.conform(rows, table, extra).unionByName(_materialized(sink.conform(kept, table, extra)))
            # A file a day (numbers have no gaps, so a hot day has one for every so many items), and not one of every task that has rows of the day.
            piece = F.floor(F.col("in_date_id") / ITEMS_A_FILE)
            sink.write_table(out, self.path(table), table, mode="overwrite", extra=extra, deal_by=[F.col("insert_date"), piece])

    def _load_sources(self, news: DataFrame) -> None:
        """New sources are appended. A known source whose smallest domain is only now
        seen makes the (small) table be rewritten, so that the order of loads is of no
        account."""
        current, seen = self.read("source_DIM"), ns.sources(news)
        had = current.select("source_name", F.col("source_domain").alias("_had"))
        if seen.join(had, "source_name").where("source_domain < _had or (_had is null and source_domain is not null)").isEmpty():
            self.append("source_DIM", ns.new_sources(news, current))
        else:
            merged = current.unionByName(seen).groupBy("source_id", "source_name")
            self.replace_table("source_DIM", merged.agg(F.min("source_domain").alias("source_domain")))


LOADED_DAYS = "_loaded_days"
#: What :func:`_keyed` adds.
KEYED = ("_day", "item", "want", "tie")
#: Items of a day whose rows one task writes to one file of a news table.
ITEMS_A_FILE = 250_000


def _keyed(news: DataFrame) -> DataFrame:
    """News rows with their day, what they are (``item``), the number they came under (``want``) and a digest of
    the whole row (``tie``)."""
    payload = [c for c in news.columns if c not in ("object", "file", "modified", "in_date_id", schemas.CORRUPT)]
    return (news.withColumn("_day", ns.insert_date()).withColumn("item", ns.item_key())
            .withColumn("want", F.col("in_date_id").cast("long"))
            .withColumn("tie", F.sha2(F.to_json(F.struct(*payload)), 256)))


def _object_counts(landed: DataFrame, rejected: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows of each file: landed, loaded, quarantined, and the rest."""
    parts = [df.select("file", *[F.lit(int(i == j)).cast("long").alias(n) for j, n in enumerate(("rows_in", "loaded", "quarantined"))])
             for i, df in enumerate((landed, loaded, rejected))]
    sums = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("file").agg(
        *[F.sum(n).alias(n) for n in ("rows_in", "loaded", "quarantined")])
    return sums.withColumn("equal", F.col("rows_in") - F.col("loaded") - F.col("quarantined"))


def _materialized(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder (the plan
    reads the table it is about to replace)."""
    return df.checkpoint(eager=True)
