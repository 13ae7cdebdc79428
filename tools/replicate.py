"""Build a scaled copy of a test-data folder: ``events`` (k times the candle symbols),
``orders`` and ``lineitem`` (k times the news items and their entries) replicated
k times with disjoint keys; the other tables linked as they are.

Usage: python tools/replicate.py <src_sf_dir> <dst_dir> <k>
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


REPLICATED = ("events.parquet", "orders.parquet", "lineitem.parquet")


def replicate(spark, src: str, dst: str, k: int) -> str:
    """Write ``events``, ``orders`` and ``lineitem`` replicated k times with disjoint
    keys (user and event ids; order keys, shared by orders and their lines) below
    ``dst``; link the other tables when ``dst`` is a local path."""
    from pyspark.sql import functions as F

    def copies(df):
        return df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))

    ev = spark.read.parquet(f"{src}/events.parquet")
    span = ev.agg(F.max("user_id") + 1, F.max("event_id") + 1).first()
    out = copies(ev).select((F.col("event_id") + F.col("_copy") * span[1]).alias("event_id"), "ts",
                            (F.col("user_id") + F.col("_copy") * span[0]).alias("user_id"),
                            "event_type", "value", "props")
    out.repartition(max(1, k // 4)).write.mode("overwrite").parquet(f"{dst}/events.parquet")
    orders = spark.read.parquet(f"{src}/orders.parquet")
    okey = orders.agg(F.max("o_orderkey") + 1).first()[0]
    (copies(orders).withColumn("o_orderkey", F.col("o_orderkey") + F.col("_copy") * okey).drop("_copy")
     .repartition(max(1, k // 4)).write.mode("overwrite").parquet(f"{dst}/orders.parquet"))
    lines = spark.read.parquet(f"{src}/lineitem.parquet")
    (copies(lines).withColumn("l_orderkey", F.col("l_orderkey") + F.col("_copy") * okey).drop("_copy")
     .repartition(max(1, k // 4)).write.mode("overwrite").parquet(f"{dst}/lineitem.parquet"))
    local = dst[len("file:"):] if dst.startswith("file:") else dst
    if local.startswith("/"):
        for name in os.listdir(src):
            if name.endswith(".parquet") and name not in REPLICATED:
                link = os.path.join(local, name)
                if not os.path.exists(link):
                    os.symlink(os.path.join(src, name), link)
    return dst


def main() -> None:
    src, dst, k = sys.argv[1], sys.argv[2], int(sys.argv[3])
    from candleworks.session import get_session

    spark = get_session("local[8]", 16, app_name="replicate")
    spark.sparkContext.setLogLevel("ERROR")
    os.makedirs(dst, exist_ok=True)
    replicate(spark, src, dst, k)
    spark.stop()


if __name__ == "__main__":
    main()
