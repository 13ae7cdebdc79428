"""Scalar helpers: surrogate keys, epoch/date text, missing-value words."""

from candleworks.functions.keys import uuid_key, uuid_key_sql
from candleworks.functions.nulls import DEFAULT_MEMBER, NA_WORDS, na_to_null, or_default
from candleworks.functions import times

__all__ = ["uuid_key", "uuid_key_sql", "DEFAULT_MEMBER", "NA_WORDS", "na_to_null",
           "or_default", "times"]
