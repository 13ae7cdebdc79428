"""Gap-free numbering 0..n-1 inside groups and the first k of each group, the same plan at every size.

``row_number() OVER (PARTITION BY g ORDER BY k)`` sends a whole group through one
task. Here the distinct (group, key) pairs - flat columns only - are counted and range-partitioned
into slices instead; each slice sums its own counts, and a per-(group, slice) table - at most
``groups + slices`` rows - turns local sums into global ones. The numbers are then joined back to the
rows, so nested columns are moved once, by that join. The sliced pairs are checkpointed to the
shared folder so that the slice a pair lands in cannot change if an executor is lost and work is recomputed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def number_within(df: DataFrame, group_cols: list[str], order_cols: list[str], out: str, slices: int | None = None) -> DataFrame:
    """Add ``out`` = 0-based position of the row in its group under ``order_cols``. Rows
    that agree in all of them (nulls too) follow one another in an order of no meaning."""
    keys = [*group_cols, *order_cols]
    numbered = _first_numbers(df, group_cols, order_cols, slices)
    have = numbered.select(*[F.col(c).alias(f"_n_{i}") for i, c in enumerate(keys)], "_number", "_copies")
    same = [F.col(c).eqNullSafe(F.col(f"_n_{i}")) for i, c in enumerate(keys)]
    rows = df.join(have, same).drop(*[f"_n_{i}" for i in range(len(keys))])
    if numbered.where("_copies > 1").isEmpty():
        number = F.col("_number")
    else:  # rows of one key: which of them is which is of no account
        number = F.col("_number") + F.row_number().over(Window.partitionBy(*keys).orderBy("_number")) - 1
    return rows.withColumn(out, number.cast("long")).drop("_number", "_copies")


def number_and_deal(df: DataFrame, group: str, order_cols: list[str], out: str, tasks: int, piece_rows: int = 250_000) -> DataFrame:
    """As :func:`number_within`, for a group with few values (a day), with nested rows moved only once: each is dealt to the
    task (of ``tasks``) that numbers it, and a write by group can leave it there. A group lies in one task, unless it has more than
    ``piece_rows`` rows: such a group is cut at the keys that hold every so many numbers, found on the flat keys of these groups alone. The
    cuts, at most one for ``piece_rows`` rows, are broadcast."""
    large = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > piece_rows).select(F.col(group).alias("_g")).checkpoint(eager=True)
    together, rows, off = [group], df, F.lit(0)
    if not large.isEmpty():
        firsts = _first_numbers(df.join(F.broadcast(large), F.col(group).eqNullSafe(F.col("_g")), "left_semi"), [group], order_cols, None)
        cut = F.struct("_number", F.struct(*order_cols).alias("key"))
        cuts = (firsts.groupBy(group, F.floor(F.col("_number") / piece_rows).alias("_p")).agg(F.min(cut).alias("_cut")).where("_p > 0")
                .groupBy(F.col(group).alias("_g")).agg(F.array_sort(F.collect_list("_cut")).alias("_cuts")).checkpoint(eager=True))
        rows = (df.join(F.broadcast(cuts), F.col(group).eqNullSafe(F.col("_g")), "left").drop("_g")
                .withColumn("_passed", F.filter(F.coalesce("_cuts", F.array()), lambda c: c["key"] <= F.struct(*order_cols)))
                .withColumn("_piece", F.size("_passed")).withColumn("_off", F.coalesce(F.try_element_at("_passed", F.lit(-1))["_number"], F.lit(0)))
                .drop("_cuts", "_passed"))
        together, off = [group, "_piece"], F.col("_off")
    within = Window.partitionBy(*together).orderBy(*order_cols)
    return rows.repartition(tasks, *together).withColumn(out, (F.row_number().over(within) - 1 + off).cast("long")).drop("_piece", "_off")


def _first_numbers(df: DataFrame, group_cols: list[str], order_cols: list[str], slices: int | None) -> DataFrame:
    """Every distinct (group, key) with its rows (``_copies``) and the number of the first of them."""
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group_cols, *order_cols]
    ranged = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
              .repartitionByRange(n, *keys).withColumn("_slice", F.spark_partition_id()).checkpoint(eager=True))
    counts = ranged.groupBy(*group_cols, "_slice").agg(F.sum("_copies").alias("_n"))
    before = Window.partitionBy(*group_cols).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(c).alias(f"_g_{i}") for i, c in enumerate(group_cols)], F.col("_slice").alias("_s"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = Window.partitionBy(*group_cols, "_slice").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    of_group = [F.col(c).eqNullSafe(F.col(f"_g_{i}")) for i, c in enumerate(group_cols)]
    return (ranged.withColumn("_local", F.coalesce(F.sum("_copies").over(local), F.lit(0)))
            .join(offsets, [*of_group, F.col("_slice") == F.col("_s")])
            .select(*keys, "_copies", (F.col("_off") + F.col("_local")).alias("_number")))


def top_k_within(df: DataFrame, group_cols: list[str], order_cols: list, k: int, salts: int | None = None) -> DataFrame:
    """The first ``k`` rows of each group under ``order_cols`` (a total order),
    without sending a hot group through one task: the first k of each group and input split stay (the
    split is the salt, so a piece is bounded by its size), of those the first k of each group and one of
    ``salts`` (by default the root of the number of splits), then the first k of each group."""
    def keep_first_k(frame: DataFrame, *salt: str) -> DataFrame:
        w = Window.partitionBy(*group_cols, *salt).orderBy(*order_cols)
        return frame.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    level = keep_first_k(df.withColumn("_split", F.spark_partition_id()), "_split")
    level = keep_first_k(level.withColumn("_salt", F.pmod("_split", F.lit(salts or max(1, round(n ** 0.5))))).drop("_split"), "_salt")
    return keep_first_k(level.drop("_salt"))
