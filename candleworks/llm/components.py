"""Connected components of a link table, by alternating large and small stars.

Each round is four aggregations and two joins over the links; the number of rounds grows
with the logarithm of a component's size. The centre of a star holds all its links, so the
least neighbour of a node is found per salt of its links first, then over the salts, and is joined
back by node and salt. The driver sees one row per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candleworks.llm._store import written

SALTS = 16


def _mark(stars: DataFrame) -> tuple:
    return tuple(stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _with_least(pairs: DataFrame) -> DataFrame:
    """``u``, ``v`` and ``m``, the least ``v`` of the row's ``u``."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    least = salted.groupBy("u", "salt").agg(F.min("v").alias("m"))
    return salted.join(least.select("u", "salt", F.min("m").over(Window.partitionBy("u")).alias("m")), ["u", "salt"]).select("u", "v", "m")


def roots(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node that links lead to, for every node of a
    link that is not its component's smallest. Self-links and repeated links are fine."""
    pair = lambda x, y: (F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
    stars = written(links.where(F.col(a) != F.col(b)).select(*pair(a, b)).distinct(), "links")
    before = None
    while (now := _mark(stars)) != before:
        before = now
        both = stars.select("u", "v").unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        small = _with_least(large).select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        stars = written(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u != v").distinct(), "links")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))


def joined(known: DataFrame, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``known`` (``node``, ``root``) and the components that ``links`` join them to. Only the
    links between the components known so far are worked on."""
    root = known.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    ends = links.select(F.col(a).alias("_a"), F.col(b).alias("_b"))
    for end in ("_a", "_b"):
        ends = ends.join(root, F.col(end) == F.col("_node"), "left").withColumn(end, F.coalesce("_root", end)).drop("_node", "_root")
    new = written(roots(ends, "_a", "_b"), "joined")
    moved = known.join(new.select(F.col("node").alias("root"), F.col("root").alias("_root")), "root", "left").select("node", F.coalesce("_root", "root").alias("root"))
    # A node that was its component's smallest is not in ``known`` yet.
    return written(moved.unionByName(new), "components")
