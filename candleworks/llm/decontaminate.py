"""Benchmark decontamination, DataFrame functions only (operator 7).

An item is found in a document if at least ``threshold`` of the item's distinct word
shingles occur there, however long the document is. Search and proof are two steps:

1. Size-partitioned MinHash: items are partitioned by their number of shingles
   (powers of two). An item of a partition with at most ``u`` shingles is represented
   by its ``u - ceil(threshold * u) + 1`` smallest shingle hashes. A document that
   holds ``threshold`` of an item misses fewer than that many of its shingles, so it
   holds at least one of these minima: the search loses nothing. Documents only hash
   their shingles and probe the minima.
2. Exact containment: the shingles of candidate documents are compared as words.

Words are runs of letters and digits, in lower case. Shingles have five words; an item
with fewer words is one shingle, its whole sequence, looked for at that length. Cases:
null or wordless texts and items, and rows with a null id, are never part of a pair;
rows of one item id pool their shingles, as do rows of one document id; repeated rows
and extra columns change nothing; an empty table gives no pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from candleworks.llm._store import same_class_small, written

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 80
#: A side is broadcast up to this many rows (of under 100 bytes each); beyond, Spark shuffles it.
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _grams(rows: DataFrame, n: int) -> DataFrame:
    """``_id`` and the words ``w0`` to ``w(n-1)`` of every run of ``n`` words."""
    count = F.greatest(F.size("_words") - (n - 1), F.lit(0))
    zipped = F.arrays_zip(*[F.slice("_words", i + 1, count).alias(f"w{i}") for i in range(n)])
    return rows.select("_id", F.inline(zipped).alias(*[f"w{i}" for i in range(n)]))


def _hash(n: int) -> Column:
    return F.xxhash64(*[f"w{i}" for i in range(n)])


def _gram(n: int) -> Column:
    return F.concat_ws(" ", *[f"w{i}" for i in range(n)])


def _maybe_broadcast(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if same_class_small(df, BROADCAST_ROWS) else df


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", shingle: int = SHINGLE_WORDS,
         percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """Pairs of a document and an item that it holds: the ids, ``n_item`` (the item's
    shingles), ``n_found`` (those in the document) and ``containment``."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where("_id is not null")
    doc_words = lambda d: d.select("_id", words(F.col("_text")).alias("_words"))
    item_words = items.select(F.col(item_col).alias("_id"), words(F.col(item_text_col)).alias("_words")).where(
        F.col("_id").isNotNull() & (F.size("_words") > 0))
    sized = item_words.withColumn("_len", F.least(F.size("_words"), F.lit(shingle)))
    kinds = sorted(r[0] for r in sized.select("_len").distinct().collect())  # at most ``shingle`` values
    id_type, item_type = docs.schema[id_col].dataType, items.schema[item_col].dataType
    shingles = None
    for n in kinds:
        part = _grams(sized.where(F.col("_len") == n), n).select(
            F.col("_id").alias("_item"), F.lit(n).alias("_len"), _hash(n).alias("_hash"), _gram(n).alias("_gram")).distinct()
        shingles = part if shingles is None else shingles.unionByName(part)
    if shingles is None:
        return spark.createDataFrame([], "_id int").select(
            F.lit(None).cast(id_type).alias(id_col), F.lit(None).cast(item_type).alias(item_col),
            F.lit(0).cast("long").alias("n_item"), F.lit(0).cast("long").alias("n_found"), F.lit(0.0).alias("containment"))
    shingles = written(shingles, "benchmark-shingles")

    # The minima of each size partition.
    of_item = Window.partitionBy("_item")
    ranked = shingles.withColumn("_q", F.count(F.lit(1)).over(of_item)).withColumn(
        "_rank", F.row_number().over(of_item.orderBy("_hash", "_gram")))
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("_q").cast("double")))).cast("long")
    minima = ranked.where(F.col("_rank") <= upper - F.ceil(upper * percent / 100) + 1).select("_len", "_hash", "_item")
    minima = written(minima, "benchmark-minima")

    found = None
    for n in kinds:
        probe = _maybe_broadcast(minima.where(F.col("_len") == n).select("_hash", "_item"))
        hits = _grams(doc_words(texts), n).select("_id", _hash(n).alias("_hash")).join(probe, "_hash").select("_id", "_item")
        found = hits if found is None else found.unionByName(hits)
    candidates = written(found.distinct(), "benchmark-candidates")

    chosen = _maybe_broadcast(candidates.select("_id").distinct())
    held = None
    for n in kinds:
        of_kind = _maybe_broadcast(shingles.where(F.col("_len") == n).select("_gram", "_item"))
        part = _grams(doc_words(texts.join(chosen, "_id", "left_semi")), n).select("_id", _gram(n).alias("_gram")).join(
            of_kind, "_gram").select("_id", "_item", "_gram").distinct()
        held = part if held is None else held.unionByName(part)
    counts = held.join(candidates, ["_id", "_item"], "left_semi").groupBy("_id", "_item").agg(F.count(F.lit(1)).alias("n_found"))
    sizes = shingles.groupBy("_item").agg(F.count(F.lit(1)).alias("n_item"))
    return counts.join(_maybe_broadcast(sizes), "_item").where(F.col("n_found") * 100 >= F.col("n_item") * percent).select(
        F.col("_id").alias(id_col), F.col("_item").alias(item_col), "n_item", "n_found",
        (F.col("n_found") / F.col("n_item")).alias("containment"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns. Each row is judged by its own
    text: rows are known by a 64-bit hash of id and text, so rows of one id, or without one, are told apart."""
    key = F.xxhash64(id_col, text_col)
    texts = docs.select(key.alias("_row"), F.col(text_col).alias("_text"))
    leaks = find(texts, items.select(F.xxhash64("item_id", "text").alias("item_id"), "text"), "_row", "_text")
    leaks = written(leaks.select(F.col("_row").alias("_leak")).distinct(), "benchmark-leaks")
    rows = docs.select(F.struct("*").alias("_doc"), key.alias("_row"))
    return rows.join(_maybe_broadcast(leaks), F.col("_row") == F.col("_leak"), "left_anti").select("_doc.*")
