"""The indicator as Spark SQL text over the warehouse views (for SQL users; same
result and the same plan shape as :func:`candleworks.operators.indicators.ohcl_indicator`:
every date is a scalar subquery, so it becomes a partition filter on the fact)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from candleworks.plans.warehouse import Warehouse

OHCL_INDICATOR = """
WITH days AS (SELECT trade_date, count(*) AS n FROM candles_FACT GROUP BY trade_date),
placed AS (SELECT trade_date, row_number() OVER (ORDER BY trade_date DESC) AS age,
                  sum(n) OVER (ORDER BY trade_date) AS upto FROM days),
marks AS (SELECT max(CASE age WHEN 1 THEN trade_date END) AS newest, max(CASE age WHEN 2 THEN trade_date END) AS older,
                 coalesce(min(CASE WHEN upto >= 3 THEN trade_date END), max(trade_date)) AS third,
                 coalesce(min(CASE WHEN upto >= 5 THEN trade_date END), max(trade_date)) AS fifth FROM placed),
moves AS (
    SELECT stock_symbol,
           sum(CASE WHEN trade_date = (SELECT newest FROM marks) THEN CAST(c AS DOUBLE) END)
             - sum(CASE WHEN trade_date = (SELECT older FROM marks) THEN CAST(c AS DOUBLE) END) AS delta
    FROM candles_FACT WHERE trade_date >= (SELECT older FROM marks)
    GROUP BY stock_symbol HAVING count(DISTINCT trade_date) = 2),
avgs AS (
    SELECT stock_symbol,
           avg(CASE WHEN trade_date <= (SELECT third FROM marks) THEN CAST(c AS DOUBLE) END) AS sliding_avg_3,
           count(CASE WHEN trade_date <= (SELECT third FROM marks) THEN 1 END) AS n_3,
           avg(CAST(c AS DOUBLE)) AS sliding_avg_5
    FROM candles_FACT WHERE trade_date <= (SELECT fifth FROM marks)
    GROUP BY stock_symbol)
SELECT moves.stock_symbol,
       date_format((SELECT newest FROM marks), 'yyyy-MM-dd') AS date,
       moves.delta, avgs.sliding_avg_3, avgs.sliding_avg_5
FROM moves JOIN avgs ON moves.stock_symbol = avgs.stock_symbol
WHERE avgs.n_3 > 0
"""


def ohcl_indicator_sql(wh: Warehouse) -> DataFrame:
    return wh.sql(OHCL_INDICATOR)
