"""News loads: sources and topics (new members only), the news dimension and
the two sentiment facts exploded from the nested arrays.

Input is news in landing form (``file_date, in_date_id, title, url,
time_published, source, source_domain, overall_sentiment_score, topics[],
ticker_sentiment[]``). The news identity is ``(insert_date, in_date_id)`` with
``insert_date = file_date + 2`` (the reference's rule, kept).

Array rules: a null or empty array, and a null element, yield no fact row
(``explode`` + not-null filter). An element whose ``topic`` / ``ticker`` is
missing yields a fact with a null key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candleworks.functions import times, uuid_key
from candleworks.operators.dimensions import SOURCE, TOPIC

INSERT_LAG_DAYS = 2
# A total order of the items of one day (the feed's own order is not kept by files).
FEED_ORDER = ("time_published", "url", "title")


def insert_date(file_date: Column | str = "file_date") -> Column:
    c = F.col(file_date) if isinstance(file_date, str) else file_date
    return F.date_add(c, INSERT_LAG_DAYS)


def item_key() -> Column:
    """What an item is, whatever file of its day brought it: its url, title and full publish
    time; where it has none of them, its number in the day."""
    nothing = F.col("url").isNull() & F.col("title").isNull() & F.col("time_published").isNull()
    number = F.when(nothing, F.col("in_date_id").cast("long"))
    return F.sha2(F.to_json(F.struct("url", "title", "time_published", number.alias("number"))), 256)


def source_key(name: Column | str = "source_name") -> Column:
    """Id of a source: keyed on the name, the column the news rows look it up by,
    so incremental and one-shot loads agree whatever domains arrive later."""
    return uuid_key(SOURCE.table, name)


# ---- sources ------------------------------------------------------------------------

def sources(news: DataFrame, one_per_name: bool = True) -> DataFrame:
    """Distinct sources. ``one_per_name``: one row per name with its smallest
    domain (the job's rule); otherwise every distinct (name, domain) pair, which
    is what the reference inserts - two domains then mean two rows for one name."""
    pairs = news.select(F.col("source").alias("source_name"), "source_domain")
    if one_per_name:
        pairs = pairs.groupBy("source_name").agg(F.min("source_domain").alias("source_domain"))
    else:
        pairs = pairs.distinct()
    return pairs.where(F.col("source_name").isNotNull()).select(
        source_key().alias("source_id"), "source_name", "source_domain")


def new_sources(news: DataFrame, current: DataFrame, one_per_name: bool = True) -> DataFrame:
    """Sources whose name is not in the dimension yet (compared on the name)."""
    return sources(news, one_per_name).join(current.select("source_name"), "source_name", "left_anti") \
        .select("source_id", "source_name", "source_domain")


# ---- topics ---------------------------------------------------------------------------

def topic_entries(news: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per (news item, topic element); scores stay text until cast."""
    return (news.select("file_date", "in_date_id", *extra, F.explode("topics").alias("_t"))
            .where(F.col("_t").isNotNull())
            .select("file_date", "in_date_id", *extra, F.col("_t.topic").alias("topic"),
                    F.col("_t.relevance_score").alias("relevance_score")))


def topics(news: DataFrame) -> DataFrame:
    return (topic_entries(news).select(F.col("topic").alias(TOPIC.name_col))
            .where(F.col(TOPIC.name_col).isNotNull()).distinct()
            .select(uuid_key(TOPIC.table, TOPIC.name_col).alias(TOPIC.id_col), TOPIC.name_col))


def new_topics(news: DataFrame, current: DataFrame) -> DataFrame:
    return topics(news).join(current.select(TOPIC.name_col), TOPIC.name_col, "left_anti") \
        .select(TOPIC.id_col, TOPIC.name_col)


# ---- news dimension -------------------------------------------------------------------

def news_rows(news: DataFrame, source_dim: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """news_DIM rows (and the columns ``extra``): the source looked up by name (left join: an unknown source
    leaves a null id; several rows for one name multiply the item)."""
    src = source_dim.select(F.col("source_id"), F.col("source_name").alias("_src_name"))
    return (news.join(src, F.col("source") == F.col("_src_name"), "left")
            .select(insert_date().alias("insert_date"),
                    F.col("in_date_id").cast("long").alias("in_date_id"),
                    "title", "url",
                    times.publish_date("time_published").alias("time_publish_id"),
                    "source_id", "overall_sentiment_score", *extra))


# ---- facts ----------------------------------------------------------------------------

def topic_facts(news: DataFrame, topic_dim: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """new_sentiment_industry_FACT: per topic element, the topic id and - as in the
    reference - the topic's *relevance* score in the sentiment column."""
    t = topic_dim.select(F.col(TOPIC.id_col), F.col(TOPIC.name_col).alias("_topic_name"))
    return (topic_entries(news, extra)
            .join(t, F.col("topic") == F.col("_topic_name"), "left")
            .select(insert_date().alias("insert_date"),
                    F.col("in_date_id").cast("long").alias("in_date_id"),
                    TOPIC.id_col,
                    F.col("relevance_score").try_cast("double").alias("sentiment_score"), *extra))


def ticker_entries(news: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    return (news.select("file_date", "in_date_id", *extra, F.explode("ticker_sentiment").alias("_s"))
            .where(F.col("_s").isNotNull())
            .select("file_date", "in_date_id", *extra, F.col("_s.ticker").alias("ticker"),
                    F.col("_s.ticker_sentiment_score").alias("ticker_sentiment_score")))


def stock_facts(news: DataFrame, symbol_dim: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """new_sentiment_stock_FACT: per ticker element of a known symbol (inner join:
    unknown tickers are dropped)."""
    sym = symbol_dim.select(F.col("stock_symbol"))
    return (ticker_entries(news, extra)
            .join(sym, F.col("ticker") == F.col("stock_symbol"), "inner")
            .select(insert_date().alias("insert_date"),
                    F.col("in_date_id").cast("long").alias("in_date_id"),
                    "stock_symbol",
                    F.col("ticker_sentiment_score").try_cast("double").alias("sentiment_score"), *extra))


# ---- extraction slice (landing side) ----------------------------------------------------

def day_slice(news: DataFrame, limit: int | None = None, lag_days: int = 2, run_dates: DataFrame | None = None) -> DataFrame:
    """What each daily extraction returns: for every run date (of ``run_dates``, column ``run_date``; by default
    each one that has items), the items published on ``run date - lag``. Items without a readable publish time belong to no day. ``limit``
    (none by default) keeps a day's earliest items, as a request with a size parameter
    does; it is a per-day top-k, computed without sending a hot day through one task."""
    from candleworks.operators.numbering import top_k_within

    day = F.to_date(F.try_to_timestamp(F.col("time_published"), F.lit("yyyyMMdd'T'HHmmss")))
    rows = news.withColumn("extract_day", day).where("extract_day is not null")
    if run_dates is not None:  # bounded by the calendar
        asked = run_dates.select(F.date_sub("run_date", lag_days).alias("extract_day")).distinct()
        rows = rows.join(F.broadcast(asked), "extract_day", "left_semi")
    if limit is not None:
        rows = top_k_within(rows, ["extract_day"], [F.col(c) for c in FEED_ORDER], limit)
    return rows.select(
        F.date_add("extract_day", lag_days).alias("run_date"), "extract_day",
        times.compact_day_text("extract_day", "T0000").alias("time_from"),
        times.compact_day_text("extract_day", "T2359").alias("time_to"),
        *[c for c in news.columns if c not in ("extract_day",)])
