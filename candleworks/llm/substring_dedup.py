"""Removal of repeated word windows (operator 10), by super-k-mer partitioning.

A window is ``window`` consecutive words of one document. Its minimiser is the smallest
hash of a word triple in it, so equal windows have equal minimisers. Consecutive windows
with one minimiser travel together, as one packed string of words (a super-k-mer), to
the minimiser's bucket; there all windows are sorted by hash, windows of equal hash are
compared as text, and every window but the first in (doc_id, start) order is reported.

Before the shuffle, equal super-k-mers of a chunk of input are combined: the earliest
travels, the later ones are reported at once. A passage that a third of all documents
share thus reaches its bucket once per chunk and not once per document. Strings travel
in compressed blocks, one per bucket that a chunk has strings for.

Cases: a null text has no words; a text with fewer words than a window keeps them all;
a document that repeats a window of its own loses the later one; rows that repeat a
doc_id with an equal text are the same document (equal starts don't make each other a repeat); rows
of one doc_id and different texts are documents of their own, in an order fixed by their texts; rows with a
null doc_id are not compared and keep all words; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleworks.llm._store import text_key
from candleworks.llm._words import Words, _words, chunks, grams, packed_words, sliding_min

WINDOW = 20
MINIMISER_WORDS = 3
#: Buckets per shuffle partition, and bytes of text for which there is one bucket at least; a task holds one bucket at a time.
BUCKETS_PER_TASK = 8
BUCKET_BYTES = 16 << 20
_BLOCK = "bucket int, n int, block binary, doc bigint, body bigint, a bigint, b bigint"
_BLOCK_ARROW = pa.schema([("bucket", pa.int32()), ("n", pa.int32()), ("block", pa.binary()), ("doc", pa.int64()), ("body", pa.int64()),
                          ("a", pa.int64()), ("b", pa.int64())])


def _pack(ids: np.ndarray, bodies: np.ndarray, starts: np.ndarray, strings: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, strings), np.int32, len(strings))
    return zstandard.ZstdCompressor(level=3).compress(ids.tobytes() + bodies.tobytes() + starts.tobytes() + sizes.tobytes() + b"".join(strings))


def _unpack(block: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    return (*(np.frombuffer(raw, np.int64, n, 8 * n * i) for i in range(3)), np.frombuffer(raw, np.int32, n, 24 * n), np.frombuffer(raw, np.uint8, offset=28 * n))


def super_kmers(words: Words, window: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end word and minimiser of every super-k-mer of a chunk."""
    low = sliding_min(grams(words.hash, m), window - m + 1)
    doc = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    whole = np.flatnonzero(doc[:len(low)] == doc[window - 1:window - 1 + len(low)]) if len(low) else np.zeros(0, np.int64)
    if len(whole) == 0:
        return whole, whole, low[:0]
    value = low[whole]
    new = np.concatenate([[True], (value[1:] != value[:-1]) | (np.diff(whole) != 1)])
    begin = np.flatnonzero(new)
    last = np.concatenate([begin[1:], [len(whole)]]) - 1
    return whole[begin], whole[last] + window, value[begin]


def _ranges(*columns: np.ndarray) -> pa.RecordBatch:
    none = [None] * len(columns[0])
    return pa.RecordBatch.from_arrays([pa.array(none, pa.int32()), pa.array(none, pa.int32()), pa.array(none, pa.binary()),
                                       *[pa.array(c, pa.int64()) for c in columns]], schema=_BLOCK_ARROW)


def _send(batches: Iterable[pa.RecordBatch], window: int, m: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        texts = batch.column(2).to_numpy(zero_copy_only=False)
        for words in chunks(batch.column(1)):
            first, end, value = super_kmers(words, window, m)
            if len(first) == 0:
                continue
            text, at = packed_words(words)
            row = np.searchsorted(words.first, first, side="right") - 1
            doc, body = ids[words.rows][row].astype(np.int64), texts[words.rows][row]
            start = first - words.first[row]
            strings = [text[x:y] for x, y in zip(at[first], at[end] - 1)]
            # Equal strings of the chunk, the earliest first: it travels.
            kept: dict[bytes, int] = {}
            repeats: list[int] = []
            for i in np.lexsort((start, body, doc)).tolist():
                k = kept.setdefault(strings[i], i)
                if k != i and (doc[k], body[k], start[k]) != (doc[i], body[i], start[i]):
                    repeats.append(i)
            if repeats:
                yield _ranges(doc[repeats], body[repeats], start[repeats], start[repeats] + (end - first)[repeats])
            go = np.fromiter(kept.values(), np.int64, len(kept))
            bucket = (value[go] % np.uint64(buckets)).astype(np.int64)
            go, bucket = go[order := np.argsort(bucket, kind="stable")], bucket[order]
            cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
            out = [(bucket[x], y - x, _pack(doc[go[x:y]], body[go[x:y]], start[go[x:y]], [strings[i] for i in go[x:y]])) for x, y in zip(cut[:-1], cut[1:])]
            none = pa.array([None] * len(out), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32()),
                                              pa.array([o[2] for o in out], pa.binary()), none, none, none, none], schema=_BLOCK_ARROW)


def repeated_windows(ids: np.ndarray, bodies: np.ndarray, starts: np.ndarray, words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document (id and text) and start of every window of a bucket whose text starts earlier elsewhere."""
    hashes = grams(words.hash, window)
    string = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    whole = np.flatnonzero(string[:len(hashes)] == string[window - 1:window - 1 + len(hashes)]) if len(hashes) else np.zeros(0, np.int64)
    h = hashes[whole]
    order = np.argsort(h, kind="stable")
    h = h[order]
    same = h[1:] == h[:-1]
    many = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    at = whole[order[many]]
    if len(at) == 0:
        return at, at, at
    group = np.cumsum(np.concatenate([[False], ~same]))[many]
    doc, body = ids[string[at]], bodies[string[at]]
    start = starts[string[at]] + at - words.first[string[at]]
    order = np.lexsort((start, body, doc, group))
    at, doc, body, start = at[order], doc[order], body[order], start[order]
    data = words.data.tobytes()
    firsts: dict[bytes, int] = {}
    out = []
    for i, (x, y) in enumerate(zip(words.start[at].tolist(), words.end[at + window - 1].tolist())):
        k = firsts.setdefault(data[x:y], i)
        if k != i and (doc[k] != doc[i] or body[k] != body[i] or start[k] != start[i]):
            out.append(i)
    return doc[out], body[out], start[out]


def _count(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    now = None

    def done() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        ids, bodies, starts, sizes, data = (np.concatenate([h[i] for h in held]) for i in range(5))
        held.clear()
        off = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        doc, body, start = repeated_windows(ids, bodies, starts, _words(data, off, False, slice(0, len(sizes))), window)
        if len(doc) == 0:
            return
        order = np.lexsort((start, body, doc))
        doc, body, start = doc[order], body[order], start[order]
        new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (body[1:] != body[:-1]) | (start[1:] - start[:-1] > 1)])
        begin = np.flatnonzero(new)
        last = np.concatenate([begin[1:], [len(doc)]]) - 1
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (doc[begin], body[begin], start[begin], start[last] + window)],
                                         names=["doc", "body", "a", "b"])

    for batch in batches:
        direct = batch.filter(batch.column(0).is_null())
        if direct.num_rows:
            yield direct.select(["doc", "body", "a", "b"])
        for bucket, n, block in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if bucket is None:
                continue
            if bucket != now:
                yield from done()
                now = bucket
            held.append(_unpack(block, n))
    yield from done()


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Word ranges ``a`` to ``b - 1`` of document ``doc`` (with the text that ``body`` stands for, see
    :func:`candleworks.llm._store.text_key`) that repeat earlier windows; they may overlap."""
    spark = docs.sparkSession
    size, = docs.agg(F.sum(F.octet_length(text_col))).first()
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // (BUCKETS_PER_TASK * BUCKET_BYTES)), 1)
    buckets = tasks * BUCKETS_PER_TASK
    m = min(MINIMISER_WORDS, window)
    texts = docs.select(F.col(id_col).cast("long"), text_col, text_key(docs, id_col, text_col)).where(F.col(id_col).isNotNull())
    blocks = texts.mapInArrow(lambda it: _send(it, window, m, buckets), _BLOCK)
    # Ranges that are known already are spread over the tasks by their document.
    dealt = F.coalesce(F.col("bucket"), F.pmod(F.xxhash64("doc"), F.lit(buckets)).cast("int"))
    return blocks.repartition(tasks, dealt).sortWithinPartitions("bucket").mapInArrow(
        lambda it: _count(it, window), "doc bigint, body bigint, a bigint, b bigint")


def _keep(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ranges = batch.column(2).to_pylist()
        for words in chunks(batch.column(1)):
            count = np.diff(words.first)
            edge = np.zeros(len(words.start) + 1, dtype=np.int32)
            for base, found in zip(words.first, ranges[words.rows]):
                for r in found or ():
                    edge[base + r["a"]] += 1
                    edge[base + r["b"]] -= 1
            keep = np.cumsum(edge[:-1]) == 0
            text, at = packed_words(words, keep)
            kept = np.concatenate([[0], np.cumsum(keep)])[words.first]
            body = [text[at[x]:max(at[x], at[y] - 1)] for x, y in zip(kept[:-1], kept[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(words.rows.start, len(body)), pa.array(count, pa.int64()),
                                              pa.array(count - np.diff(kept), pa.int64()), pa.array(body, pa.binary()).cast(pa.string())], names=names)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: the id, ``n_words``, ``n_removed`` and ``kept``, the words that stay joined by one space."""
    found = repeats(docs, id_col, text_col, window).groupBy("doc", "body").agg(F.collect_list(F.struct("a", "b")).alias("_ranges"))
    rows = docs.select(F.col(id_col), F.col(text_col), text_key(docs, id_col, text_col).alias("_body"))
    rows = rows.join(found, (F.col(id_col).cast("long") == F.col("doc")) & (F.col("_body") == F.col("body")), "left").select(id_col, text_col, "_ranges")
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_words", "n_removed", "kept"]
    return rows.mapInArrow(lambda it: _keep(it, names), f"`{id_col}` {kind}, n_words bigint, n_removed bigint, kept string")
