"""Deterministic surrogate keys (I13: replaces a random UUID column default).

A key is ``md5('<table>:' || natural key)`` laid out 8-4-4-4-12 like a UUID, so a
retried or repeated load produces the same id, facts can derive the id of a
dimension member without re-reading the dimension, and the SQL oracle computes the
same text with its own ``md5``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uuid_key(namespace: str, natural_key: Column | str) -> Column:
    """UUID-shaped md5 of ``namespace:natural_key`` (null key -> null id)."""
    key = F.col(natural_key) if isinstance(natural_key, str) else natural_key
    h = F.md5(F.concat(F.lit(namespace + ":"), key.cast("string")))
    return F.when(key.isNotNull(), F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
        F.substring(h, 17, 4), F.substring(h, 21, 12)))


def uuid_key_sql(namespace: str, expr: str) -> str:
    """The same key as SQL text (used by the oracle and by SQL-first callers)."""
    h = f"md5('{namespace}:' || CAST({expr} AS VARCHAR))"
    return (f"CASE WHEN {expr} IS NOT NULL THEN "
            f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
            f"substr({h}, 17, 4) || '-' || substr({h}, 21, 12) END")
