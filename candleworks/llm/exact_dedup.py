"""Exact deduplication of whole texts, DataFrame functions only (operator 2).

Texts are equal if they are identical after every run of ASCII white space became
one space. Rows are combined in three stages, each of which groups by the digest
*and* the full text: within each input task (Spark's partial aggregate), then per
salt of a digest, then over the at most ``salts`` winners of a digest. A digest
that a third of all rows share therefore never meets in one task, neither while
combining nor when the decision is joined back to the rows (by digest and salt).

Cases: a null text counts as empty; an empty table gives an empty result; rows that
repeat a doc_id with an equal text are the same document and get the same verdict; a
null doc_id never stays before another one and is kept only if its whole group has
none; extra columns are ignored. ``keep_first`` decides by id *and* text, so an id that
occurs with several texts loses none of them, and leaves exactly one row of every group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candleworks.llm._store import one_each, written

SPACES = r"[\x20\x09-\x0D]+"
SALTS = 32


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _decided(rows: DataFrame) -> tuple[DataFrame, bool]:
    """Per digest and salt (and text, ``_content``, where texts share a digest): the id
    that stays and the size of the group; and whether any texts do."""
    salted = rows.groupBy("_digest", "_salt", "_text").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    one_digest = Window.partitionBy("_digest")
    one_text = Window.partitionBy("_digest", "_text")
    merged = salted.repartition("_digest").select(
        "*", (F.min("_text").over(one_digest) != F.max("_text").over(one_digest)).alias("_clash")).select(
        "_digest", "_salt", F.when(F.col("_clash"), F.col("_text")).alias("_content"),
        F.min("_first").over(one_text).alias("_keep"), F.sum("_n").over(one_text).alias("_size"))
    merged = written(merged, "exact-dedup")
    return merged, not merged.where("_content is not null").isEmpty()


def _rows(docs: DataFrame, id_col: str, text_col: str, salts: int, digest, *more: Column) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_text"), *more)
    return rows.select("*", digest(F.col("_text")).alias("_digest"), F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int").alias("_salt"))


def _same(clash: bool) -> Column:
    same = (F.col("r._digest") == F.col("m._digest")) & (F.col("r._salt") == F.col("m._salt"))
    return same & (F.col("m._content").isNull() | (F.col("m._content") == F.col("r._text"))) if clash else same


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
           digest=sha256) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_digest``.

    ``digest`` may be any function of the text: different texts that share a digest
    are told apart by their content.
    """
    rows = _rows(docs, id_col, text_col, salts, digest)
    merged, clash = _decided(rows)
    return rows.alias("r").join(merged.alias("m"), _same(clash)).select(
        F.col("r._id").alias(id_col), F.col("m._keep").alias("keep_id"), F.col("m._size").alias("group_size"),
        F.col("r._id").eqNullSafe(F.col("m._keep")).alias("kept"), F.col("r._digest").alias("text_digest"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS, digest=sha256) -> DataFrame:
    """The rows of ``docs`` that stay, one of every group of equal texts, with all their columns."""
    merged, clash = _decided(_rows(docs, id_col, text_col, salts, digest))
    rows = _rows(docs, id_col, text_col, salts, digest, F.struct("*").alias("_doc"))
    kept = rows.alias("r").join(merged.alias("m"), _same(clash) & F.col("r._id").eqNullSafe(F.col("m._keep")), "left_semi")
    return one_each(kept, "_digest", "_id", *["_text"] * clash).select("_doc.*")
