"""Date and epoch-text helpers (all built-in expressions, session zone UTC).

The fact table keeps the vendor's epoch-millisecond text ``t``; the trade date is
derived from it once at ingest. Malformed text never raises: ``try_cast`` turns it
into null, and the row goes to quarantine instead of failing the load.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Years 1 to 9999; other epoch texts give null.
EPOCH_MILLIS = (-62_135_596_800_000, 253_402_300_799_999)


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_seconds_text(t: Column | str) -> Column:
    """``left(t, 10)``: epoch-ms text -> epoch-s text (13-digit inputs)."""
    return F.left(_c(t), F.lit(10))


def text_to_long(x: Column | str) -> Column:
    """``toInt64(text)`` without raising on junk: null instead."""
    return _c(x).try_cast("bigint")


def date_from_epoch_seconds_text(t: Column | str) -> Column:
    """Reference form: ``toDate(toInt64(left(t, 10)))``."""
    return F.to_date(F.timestamp_seconds(text_to_long(epoch_seconds_text(t))))


def date_from_epoch_millis_text(t: Column | str) -> Column:
    """``datetime.fromtimestamp(int(t)/1000).date()`` in UTC."""
    millis = text_to_long(t)
    in_range = millis.between(*EPOCH_MILLIS)
    return F.to_date(F.timestamp_millis(F.when(in_range, millis)))


def epoch_millis_text_at(date: Column | str, hour_utc: int = 20) -> Column:
    """Epoch-ms text of ``date`` at ``hour_utc`` (how a daily bar is stamped)."""
    return ((F.unix_date(_c(date)).cast("bigint") * 86400 + hour_utc * 3600) * 1000).cast("string")


def publish_date(time_published: Column | str) -> Column:
    """First 8 characters ``yyyyMMdd`` of the publish time -> date."""
    return F.to_date(F.try_to_timestamp(F.left(_c(time_published), F.lit(8)), F.lit("yyyyMMdd")))


def iso_text(date: Column | str) -> Column:
    """Date -> ``yyyy-MM-dd`` text."""
    return F.date_format(_c(date), "yyyy-MM-dd")


def compact_day_text(date: Column | str, suffix: str = "T0000") -> Column:
    """Date -> ``yyyyMMdd`` + suffix (vendor time_from / time_to parameters)."""
    return F.concat(F.date_format(_c(date), "yyyyMMdd"), F.lit(suffix))


def object_date(name: Column | str) -> Column:
    """Date inside a landing object name ``XXXX_yyyy-MM-dd.json`` (characters 6..15)."""
    return F.to_date(F.try_to_timestamp(F.substring(_c(name), 6, 10), F.lit("yyyy-MM-dd")))


def object_name(prefix: str, date: Column | str) -> Column:
    """Landing object name for a day: ``<prefix>_<yyyy-MM-dd>.json``."""
    return F.concat(F.lit(prefix + "_"), iso_text(date), F.lit(".json"))


def date_of_day_number(days: int) -> datetime.date:
    """The date that is ``days`` days after 1970-01-01."""
    return datetime.date(1970, 1, 1) + datetime.timedelta(days=int(days))
