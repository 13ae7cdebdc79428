"""Candle indicators: latest/previous day, day-over-day change, the reference's
"sliding" averages (as written and as intended), moving averages.

Input is the candle fact (``stock_symbol, trade_date, c, v, t, ...``), which the
warehouse stores partitioned by ``trade_date``. Every date used to select rows is a
scalar subquery, so on the stored table it becomes a partition filter and only the
needed days are read. No window runs without ``partitionBy``; the per-symbol
windows see at most one row per trading day (the fact's key is symbol x day).

``days`` (``trade_date``, ``rows``, ``upto``), where given, are the fact's days with running row
counts, as the load keeps them: dates are then looked up there and no row of the
fact is touched to find them. Without it they are found from the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candleworks.functions import times

DATE = "trade_date"


def latest_trade_date(candles: DataFrame) -> DataFrame:
    """``max(date)`` over the fact (one row)."""
    return candles.agg(F.max(DATE).alias("max_date"))


def _max_date(candles: DataFrame):
    return latest_trade_date(candles).scalar()


def previous_trade_date(candles: DataFrame) -> DataFrame:
    """Second-largest distinct date: max over rows whose date differs from the max.
    (A global window or a sort would funnel every row through one task; this is
    two partial aggregates.)"""
    return (candles.where(F.col(DATE) != _max_date(candles))
            .agg(F.max(DATE).alias("max_date_2")))


def _prev_date(candles: DataFrame):
    return previous_trade_date(candles).scalar()


def latest_day_close(candles: DataFrame) -> DataFrame:
    """Close of every symbol on the latest date."""
    return candles.where(F.col(DATE) == _max_date(candles)).select("stock_symbol", "c")


def close_delta(candles: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """Latest close minus previous-date close, for symbols present on both dates
    (inner self-join on symbol, as the reference's SQL). Each side is one day of
    the fact, whose key (symbol, trade_date) the load keeps unique, so the join
    pairs one row with one row."""
    dates = candles if days is None else days
    cur = candles.where(F.col(DATE) == _max_date(dates)).select(
        "stock_symbol", F.col("c").alias("c_cur"))
    prv = candles.where(F.col(DATE) == _prev_date(dates)).select(
        "stock_symbol", F.col("c").alias("c_prv"))
    return (cur.join(prv, "stock_symbol", "inner")
            .select(_max_date(dates).alias("date"),
                    (F.col("c_cur").cast("double") - F.col("c_prv").cast("double")).alias("delta"),
                    "stock_symbol"))


def running_days(rows_of_day: DataFrame) -> DataFrame:
    """``trade_date``, ``rows``, ``upto``, the rows of all days up to it, and ``nulls``, of ``trade_date``, ``rows``
    and ``nulls``. Sums run within a year, then over the years (a row each)."""
    year = F.year(DATE)
    years = rows_of_day.groupBy(year.alias("_year")).agg(F.sum("rows").alias("_n"))
    before = years.alias("a").join(years.alias("b"), F.col("b._year") < F.col("a._year"), "left").groupBy(
        F.col("a._year").alias("_year")).agg(F.coalesce(F.sum("b._n"), F.lit(0)).alias("_before"))
    within = F.sum("rows").over(Window.partitionBy("_year").orderBy(DATE).rowsBetween(Window.unboundedPreceding, 0))
    return rows_of_day.withColumn("_year", year).join(before, "_year").select(
        DATE, F.col("rows").cast("long").alias("rows"), (F.col("_before") + within).cast("long").alias("upto"), "nulls")


def day_counts(candles: DataFrame) -> DataFrame:
    """``trade_date``, ``rows`` and ``nulls`` (column to number), in one aggregate that combines within tasks."""
    columns = [c for c in candles.columns if c != DATE]
    counts = candles.groupBy(DATE).agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)])
    pairs = [x for i, c in enumerate(columns) for x in (F.lit(c), F.col(f"_{i}"))]
    return counts.select(DATE, "rows", F.create_map(*pairs).alias("nulls"))


def first_rows_dates(candles: DataFrame, k: int, days: DataFrame | None = None) -> DataFrame:
    """Dates of the ``k`` earliest rows (rows, not distinct dates: ``ORDER BY date
    LIMIT k``). From ``days`` each day gives its date as often as it has rows among them; else a
    top-k: each task keeps k rows, the driver merges k x tasks."""
    if days is not None:
        before = F.col("upto") - F.col("rows")
        copies = F.sequence(F.lit(1).cast("bigint"), F.least("rows", F.lit(k) - before))
        return days.where((before < k) & (F.col("rows") > 0)).select(F.col(DATE).alias("row_date"), F.explode(copies)).select("row_date")
    return candles.select(F.col(DATE).alias("row_date")).orderBy("row_date").limit(k)


def _kth_row_date(candles: DataFrame, k: int, days: DataFrame | None = None):
    if days is not None:  # the first day up to which there are k rows; the last day if there are fewer
        return days.agg(F.coalesce(F.min(F.when(F.col("upto") >= k, F.col(DATE))), F.max(DATE))).scalar()
    # The k earliest rows hold exactly the dates <= the k-th row's date, so the
    # semi join ``date IN (first k rows)`` is the range filter ``date <= kth``.
    return first_rows_dates(candles, k).agg(F.max("row_date")).scalar()


def avg_close_first_rows(candles: DataFrame, k: int, days: DataFrame | None = None) -> DataFrame:
    """Average close per symbol over the dates of the ``k`` earliest rows."""
    return (candles.where(F.col(DATE) <= _kth_row_date(candles, k, days))
            .groupBy("stock_symbol").agg(F.avg(F.col("c").cast("double")).alias("avg_close")))


def ohcl_indicator(candles: DataFrame, short: int = 3, long: int = 5, days: DataFrame | None = None) -> DataFrame:
    """The indicator row per symbol for the latest date: delta, and the averages
    over the first ``short`` / ``long`` rows' dates (kept as written, see README).

    One scan serves both averages: the short dates are a prefix of the long ones.
    A symbol must appear in all three parts (inner joins).
    """
    lo, hi = sorted((short, long))
    d_lo, d_hi = _kth_row_date(candles, lo, days), _kth_row_date(candles, hi, days)
    c = F.col("c").cast("double")
    avgs = (candles.where(F.col(DATE) <= d_hi)
            .groupBy("stock_symbol")
            .agg(F.avg(F.when(F.col(DATE) <= d_lo, c)).alias("_avg_lo"),
                 F.count(F.when(F.col(DATE) <= d_lo, F.lit(1))).alias("_n_lo"),
                 F.avg(c).alias("_avg_hi"))
            .where(F.col("_n_lo") > 0))
    a_short, a_long = ("_avg_lo", "_avg_hi") if short <= long else ("_avg_hi", "_avg_lo")
    return (close_delta(candles, days).join(avgs, "stock_symbol", "inner")
            .select("stock_symbol", times.iso_text("date").alias("date"), "delta",
                    F.col(a_short).alias(f"sliding_avg_{short}"),
                    F.col(a_long).alias(f"sliding_avg_{long}")))


def last_n_dates(candles: DataFrame, n: int) -> DataFrame:
    """The ``n`` latest distinct trading dates (distinct first: at most one row per
    date reaches the top-n)."""
    return (candles.select(DATE).distinct().orderBy(F.col(DATE).desc()).limit(n)
            .withColumnRenamed(DATE, "d"))


def avg_close_last_n_days(candles: DataFrame, windows: tuple[int, ...] = (3, 5)) -> DataFrame:
    """What the "sliding" averages evidently meant: average close per symbol over the
    last n trading dates, for each n, in one scan of the fact. Each cut-off date is a
    small scalar subquery (distinct dates, top-n) that reads only the partition column."""
    widest = max(windows)
    since = {n: last_n_dates(candles, n).agg(F.min("d")).scalar() for n in windows}
    c = F.col("c").cast("double")
    return (candles.where(F.col(DATE) >= since[widest])
            .groupBy("stock_symbol")
            .agg(*[F.avg(F.when(F.col(DATE) >= since[n], c)).alias(f"avg_close_{n}")
                   for n in windows]))


def moving_average(candles: DataFrame, column: str, n: int, out: str = "ma",
                   keep: tuple[str, ...] = ("stock_symbol", "t")) -> DataFrame:
    """Trailing ``n``-row average of ``column`` per symbol ordered by trade date.
    Partitioned by symbol; a partition holds one row per trading day."""
    w = (Window.partitionBy("stock_symbol").orderBy(DATE)
         .rowsBetween(-(n - 1), Window.currentRow))
    return candles.select(*keep, DATE, F.avg(F.col(column).cast("double")).over(w).alias(out))


def moving_averages(candles: DataFrame, short: int = 3, long: int = 5, volume: int = 5) -> DataFrame:
    """``stock_symbol``, ``t``, ``trade_date`` and the three trailing averages ``short_ma``, ``long_ma``
    and ``avg_volume``, from one shuffle by symbol."""
    by_day = Window.partitionBy("stock_symbol").orderBy(DATE)
    mean = lambda column, n: F.avg(F.col(column).cast("double")).over(by_day.rowsBetween(-(n - 1), Window.currentRow))
    return candles.select("stock_symbol", "t", DATE, mean("c", short).alias("short_ma"), mean("c", long).alias("long_ma"),
                          mean("v", volume).alias("avg_volume"))


def short_ma(candles: DataFrame, n: int = 3) -> DataFrame:
    return moving_average(candles, "c", n).select("stock_symbol", "t", "ma")


def long_ma(candles: DataFrame, n: int = 5) -> DataFrame:
    return moving_average(candles, "c", n).select("stock_symbol", "t", "ma")


def avg_volume(candles: DataFrame, n: int = 5) -> DataFrame:
    return (moving_average(candles, "v", n, out="sliding_avg", keep=("stock_symbol",))
            .select("stock_symbol", F.col(DATE).alias("date"), "sliding_avg"))
