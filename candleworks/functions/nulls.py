"""Missing-value rules of the screener and dimension loads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words a CSV reader of the original tool chain turns into a
# missing value. Applied to Name/Country/Sector/Industry, never to Symbol (a
# ticker may literally be "NA").
NA_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Fixed value: the member name that stands for "unknown" in every dimension.
DEFAULT_MEMBER = "unpredict"


def na_to_null(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.isin(NA_WORDS), F.lit(None).cast("string")).otherwise(col)


def or_default(c: Column | str, default: str = DEFAULT_MEMBER) -> Column:
    """A missing member becomes the default word."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col, F.lit(default))
