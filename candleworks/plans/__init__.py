"""Composite jobs over the warehouse: initial load, daily candles, indicators and
moving averages, daily news (``warehouse``); landing jobs (``landing_jobs``); the
newest-object daily entry points (``daily``); the indicator as SQL text (``sql``)."""
