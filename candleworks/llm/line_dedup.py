"""Removal of repeated runs of lines (operator 9), by winnowing line hashes.

Every window of ``run`` consecutive lines selects its smallest line hash (the last one on
ties): two equal windows select the same line, so any repeated run of ``run`` lines or
more shares a fingerprint. Fingerprints that occur once are dropped. Each occurrence of
the others is extended both ways, to the windows that selected it; a window whose lines
already start earlier (smaller doc_id, or earlier in the same document) is a repeat, and
the union of a document's repeated windows is the runs that are deleted.

With ``words``, a run also counts by its words: every single line and every two
consecutive lines of that many words or more are windows of their own, so a repeated
passage of whole lines goes from ``run`` lines *or* from ``words`` words. The earliest
place of a window always stays, as a longer window around it would have to be a repeat.

Windows are compared by a 128-bit digest of their lines. Firsts are found by aggregates
that combine within tasks and per salt, so a frequent line never meets in one task.

Cases: null and empty texts have no lines; a text with fewer lines than ``run`` keeps
them (but for those that count by words); blank lines are lines; rows that repeat a doc_id with an equal text are the same
document, those with different texts are documents of their own, in an order fixed by their texts; rows with
a null doc_id are not compared and keep their lines; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candleworks.llm._store import text_key

RUN_LINES = 3
#: Words from which a repeated run of fewer lines counts as a passage.
PASSAGE_WORDS = 50
SALTS = 32


def selected(hashes: np.ndarray, run: int) -> np.ndarray:
    """The line that each window of ``run`` lines selects."""
    windows = np.lib.stride_tricks.sliding_window_view(hashes, run)
    return np.arange(len(windows)) + run - 1 - np.argmin(windows[:, ::-1], axis=1)


def _fingerprints(batches: Iterable[pa.RecordBatch], run: int, words: int | None) -> Iterator[pa.RecordBatch]:
    """Per fingerprint: document, hash, first window that selects it, the digests of the
    windows (consecutive) that do, and their lines. A window that counts by its words is a
    fingerprint alone."""
    for batch in batches:
        doc, key, first, windows, size = [], [], [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            lines = text.split("\n") if text else []
            if len(lines) < run and words is None:
                continue
            raw = [x.encode() for x in lines]
            digests = [hashlib.blake2b(x, digest_size=16).digest() for x in raw]
            if words is not None:
                n_words = [len(x.split()) for x in raw]  # of bytes, so at ASCII white space
                for k in range(1, run):
                    for a in range(len(lines) - k + 1):
                        if sum(n_words[a:a + k]) >= words:
                            window = hashlib.blake2b(b"".join(digests[a:a + k]), digest_size=16).digest()
                            doc.append(i), key.append(int.from_bytes(window[:8], "little", signed=True)), first.append(a)
                            windows.append([window]), size.append(k)
            if len(lines) < run:
                continue
            hashes = np.frombuffer(b"".join(digests), np.int64)[::2]
            at = selected(hashes, run)
            cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1], [True]]))
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
                doc.append(i), key.append(int(hashes[at[a]])), first.append(a), size.append(run)
                windows.append([hashlib.blake2b(b"".join(digests[w:w + run]), digest_size=16).digest() for w in range(a, b)])
        row = pa.array(doc, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(2).take(row), pa.array(key, pa.int64()), pa.array(first, pa.int64()),
                                          pa.array(windows, pa.list_(pa.binary())), pa.array(size, pa.int32())],
                                         names=["doc", "body", "key", "first", "windows", "size"])


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN_LINES,
            words: int | None = None) -> DataFrame:
    """``doc`` (with the text that ``body`` stands for, see :func:`candleworks.llm._store.text_key`), ``at``, the first line, and ``size``, the lines, of every window that starts earlier elsewhere."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), text_col, text_key(docs, id_col, text_col)).where("doc is not null")
    prints = texts.mapInArrow(lambda it: _fingerprints(it, run, words), "doc bigint, body bigint, key bigint, first bigint, windows array<binary>, size int")
    salted = prints.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)))
    per_salt = salted.groupBy("key", "salt").agg(F.count(F.lit(1)).alias("n"))
    many = per_salt.withColumn("n", F.sum("n").over(Window.partitionBy("key"))).where("n > 1").select("key", "salt")
    places = salted.join(many, ["key", "salt"]).select("doc", "body", "salt", F.posexplode("windows").alias("i", "lines"), "first", "size").select(
        "doc", "body", "salt", "lines", "size", (F.col("first") + F.col("i")).alias("at"))
    place = F.struct("doc", "body", "at")
    firsts = places.groupBy("lines", "salt").agg(F.min(place).alias("p")).select(
        "lines", "salt", F.min("p").over(Window.partitionBy("lines")).alias("p"))
    return places.join(firsts, ["lines", "salt"]).where(F.col("p") < place).select("doc", "body", "at", "size")


def _keep(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, gone, kept = [], [], []
        for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            lines = text.split("\n") if text else []
            drop = {r["at"] + i for r in found or () for i in range(r["size"])}
            n.append(len(lines)), gone.append(len(drop))
            kept.append("\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else text or "")
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=names)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN_LINES, words: int | None = None) -> DataFrame:
    """Per row: the id, ``n_lines``, ``n_removed`` and ``kept``, the text of the lines that stay."""
    found = repeats(docs, id_col, text_col, run, words).groupBy("doc", "body").agg(F.collect_set(F.struct("at", "size")).alias("_at"))
    rows = docs.select(F.col(id_col), F.col(text_col), text_key(docs, id_col, text_col).alias("_body"))
    rows = rows.join(found, (F.col(id_col).cast("long") == F.col("doc")) & (F.col("_body") == F.col("body")), "left").select(id_col, text_col, "_at")
    names = [id_col, "n_lines", "n_removed", "kept"]
    return rows.mapInArrow(lambda it: _keep(it, names), f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_lines bigint, n_removed bigint, kept string")
