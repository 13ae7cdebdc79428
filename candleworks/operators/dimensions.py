"""Dimension loads: default word for missing members, distinct, only unseen
members, deterministic id; the stock-symbol table with its star-schema lookups."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleworks.functions import na_to_null, or_default, uuid_key


@dataclass(frozen=True)
class Dim:
    table: str
    id_col: str
    name_col: str


COUNTRY = Dim("country_DIM", "country_id", "country_name")
SECTOR = Dim("sector_DIM", "sector_id", "sector")
INDUSTRY = Dim("industry_DIM", "industry_id", "industry_name")
SOURCE = Dim("source_DIM", "source_id", "source_name")
TOPIC = Dim("topic_DIM", "topic_id", "topic_name")

# Screener column feeding each dimension.
SCREENER_DIMS = {"Country": COUNTRY, "Sector": SECTOR, "Industry": INDUSTRY}

# Exchange ids and names that reseeding restores, and the
# company whose ticker is literally "NA".
EXCHANGES = [(1, "nasdaq"), (2, "nyse"), (3, "amex")]
SYMBOL_REPAIRS = {"Nano Labs Ltd Class A Ordinary Shares": "NA"}


def clean_screener(raw: DataFrame) -> DataFrame:
    """Missing-value words -> null on the descriptive columns (never on Symbol)."""
    out = raw
    for c in ("Name", "Country", "Sector", "Industry"):
        if c in raw.columns:
            out = out.withColumn(c, na_to_null(c))
    return out


def members(raw: DataFrame, column: str, dim: Dim) -> DataFrame:
    """Distinct member names, null -> the default word (distinct is map-side combined,
    so a hot value costs one row per task before the shuffle)."""
    return raw.select(or_default(column).alias(dim.name_col)).distinct()


def new_members(incoming: DataFrame, current: DataFrame, dim: Dim) -> DataFrame:
    """Members not yet in the dimension (anti join, not ``NOT IN``, whose null
    rule differs; names are never null here)."""
    return incoming.join(current.select(dim.name_col), dim.name_col, "left_anti")


def with_key(df: DataFrame, dim: Dim) -> DataFrame:
    return df.select(uuid_key(dim.table, dim.name_col).alias(dim.id_col), dim.name_col)


def load_dimension(raw: DataFrame, column: str, dim: Dim, current: DataFrame | None = None) -> DataFrame:
    """Rows to append to ``dim``: unseen members of ``raw[column]`` with their ids."""
    m = members(raw, column, dim)
    if current is not None:
        m = new_members(m, current, dim)
    return with_key(m, dim)


def reseed_exchanges(current: DataFrame) -> DataFrame:
    """Delete ids 1..3 and insert the fixed members again (re-runnable)."""
    spark = current.sparkSession
    seed = spark.createDataFrame(EXCHANGES, "exchange_id smallint, exchange_name string")
    return current.where(F.col("exchange_id") >= 4).unionByName(seed)


def repair_symbols(screener: DataFrame) -> DataFrame:
    sym = F.col("Symbol")
    for name, symbol in SYMBOL_REPAIRS.items():
        sym = F.when(F.col("Name") == name, F.lit(symbol)).otherwise(sym)
    return screener.withColumn("Symbol", sym)


def stock_symbols(screener: DataFrame, country: DataFrame, sector: DataFrame,
                  industry: DataFrame) -> DataFrame:
    """stock_symbol_DIM rows: defaults, then left lookups of the three member ids.
    The dimensions are small (distinct names); AQE broadcasts them after measuring."""
    s = repair_symbols(screener)
    for c in ("Country", "Sector", "Industry"):
        s = s.withColumn(c, or_default(c))
    return (s.join(country, s.Country == country[COUNTRY.name_col], "left")
            .join(sector, s.Sector == sector[SECTOR.name_col], "left")
            .join(industry, s.Industry == industry[INDUSTRY.name_col], "left")
            .select(F.col("Symbol").alias("stock_symbol"), F.col("Name").alias("stock_symbol_name"),
                    COUNTRY.id_col, SECTOR.id_col, INDUSTRY.id_col,
                    F.col("exchange").cast("short").alias("exchange")))


def calendar(dates: DataFrame, column: str = "trade_date") -> DataFrame:
    """date_DIM: one row per calendar day between the first and the last date
    (id = ``yyyyMMdd`` text). The range is bounded by the calendar, not the data."""
    bounds = dates.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    return (bounds.select(F.explode(F.sequence("_lo", "_hi")).alias("date"))
            .select(F.date_format("date", "yyyyMMdd").alias("date_id"), "date"))
