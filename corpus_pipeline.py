"""The training-corpus pipeline: toxic documents go, then copies, then near copies, then
documents that hold benchmark items; what stays is encoded.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet in
the shared folder and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candleworks.llm import bpe, decontaminate, exact_dedup, ngram_join, toxicity
from candleworks.llm._store import workers_find_package, written
from candleworks.llm.queries import TOXIC_FROM, table
from candleworks.session import configure

# A stage has no SQL counterpart (toxicity, encoding); tests hold the stages against brute force.
ORACLE_SQL = None
#: The executors' heaps are at their full size when the last stage begins, so the workers keep less.
ENCODER_SHARE = 4


def _ready(spark: SparkSession) -> None:
    configure(spark)
    workers_find_package(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxic bound. The model learns from the labelled
    documents of this stage's input, outside the held-out fold."""
    _ready(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.below(docs, model, TOXIC_FROM)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of every group of equal texts."""
    _ready(spark)
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of every component of linked documents. The
    pipeline's shingles have five words, and documents link from a similarity of 0.8."""
    _ready(spark)
    return ngram_join.keep_one(docs, n=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    _ready(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    _ready(spark)
    return bpe.digests(bpe.encode(docs, bpe.default_path(), share=ENCODER_SHARE))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("decontamination", drop_benchmark), ("encoding", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    _ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, f"pipeline-{name}")
    return docs
