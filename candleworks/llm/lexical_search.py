"""Ranked lexical search by presence masks (operator 13).

Every document is scored for every item; the best ``top`` of each item are found in two steps.

1. Index: the terms of the items (and only those) are looked up in every document: a row a document
   with its number of terms, the numbers of the items' terms in it and how often each occurs. From it
   come the corpus' counts: documents, terms, and documents of each term.
2. Search: a task goes through its documents block by block. In a block, each posting list sets its
   term's bit in its documents' masks, so documents fall into groups of one mask for
   each item. The greatest score of a mask is the sum of its terms' weights times each term's
   greatest share in the block. Groups are scored by descending greatest score, and the rest
   is left as soon as that is below the item's last place so far (equal scores may still
   win by their id). A block whose greatest score is below isn't grouped at all. A task ends
   with its best of each item, and the best of all tasks are merged.

Items are worked off in blocks of at most ``BLOCK_BYTES`` of terms (or one item), whose terms are
sent to the tasks. Documents are never shuffled, only the tasks' best.

Terms are runs of ASCII digits, letters (A-Z in lower case) and non-ASCII characters. Cases:
null and termless texts count nothing and are never found; a termless item finds nothing; an
item's repeated terms count once; rows of one item id pool their terms, rows with a null item id are left out; rows that repeat a
doc_id are documents of their own; rows with a null doc_id count in the corpus but are never returned; texts of any length
are read whole, in slices; an empty table on either side gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import insort
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candleworks.llm._store import empty, written
from candleworks.llm._words import text_groups

TOP = 10
#: Bytes of terms that are looked up in one pass over the documents.
BLOCK_BYTES = 32 << 20
#: Documents and postings of a block of a task.
BLOCK_DOCS = 16_384
BLOCK_POSTINGS = 2_000_000
#: Bytes of texts that are handled together, and of a slice of a long text.
GROUP_BYTES = 4 << 20
SLICE_BYTES = 1 << 20
#: Constants of the score.
WEIGHT_SCALE, SHARE_SCALE = 1000, 1_000_000_000
TF_SCALE, LENGTH_SCALE, LENGTH_PART, LENGTH_WHOLE = 1000, 8, 90, 100

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


def slices(data: bytes, most: int = SLICE_BYTES) -> Iterator[bytes]:
    """Slices of ``most`` bytes or a little more that end between terms."""
    a = 0
    while len(data) - a > most:
        cut = _GAP.search(data, a + most)
        if cut is None:
            break
        yield data[a:cut.start()]
        a = cut.start()
    yield data[a:]


def terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, slice by slice. (Lower-casing bytes changes A-Z only.)"""
    for part in slices(text.encode("utf-8").lower()):
        yield _TERM.findall(part)


def weight(documents: int, holders: int) -> int:
    """The weight of a term that ``holders`` of the documents hold."""
    return math.floor(WEIGHT_SCALE * math.log((2 * documents + 2) / (2 * holders + 1)))


def lengths(n: list[int], documents: int, total: int) -> np.ndarray:
    """The length measure of documents of ``n`` terms; exact for any numbers."""
    return np.array([LENGTH_WHOLE - LENGTH_PART + LENGTH_PART * x * documents // total for x in n], dtype=np.int64)


def shares(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What an occurrence count adds to a score, before the term's weight."""
    return SHARE_SCALE * tf // (TF_SCALE * tf + LENGTH_SCALE * m)


@dataclass
class Items:
    """Items of a block: ids, and for each its terms' numbers and weights (above 0)."""

    ids: pa.Array
    terms: list[np.ndarray]
    weights: list[np.ndarray]


class Best:
    """The best documents of one item so far, as (-score, id)."""

    def __init__(self, top: int) -> None:
        self.top, self.rows = top, []

    @property
    def least(self) -> int:
        """Scores below can't get in."""
        return -self.rows[-1][0] if len(self.rows) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for s, i in zip(scores.tolist(), ids.tolist()):
            if s >= self.least:
                insort(self.rows, (-s, i))
                del self.rows[self.top:]


class Block:
    """Postings of some documents: by document as they come, and by term."""

    def __init__(self, ids: np.ndarray, first: np.ndarray, term: np.ndarray, share: np.ndarray) -> None:
        self.ids, self.first, self.term, self.share = ids, first, term, share
        order = np.argsort(term, kind="stable")
        self.doc = np.repeat(np.arange(len(ids)), np.diff(first))[order]
        held = term[order]
        begin = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]])) if len(held) else np.zeros(0, np.int64)
        self.known = held[begin]
        self.begin = np.concatenate([begin, [len(held)]])
        self.greatest = np.maximum.reduceat(share[order], begin) if len(held) else np.zeros(0, np.int64)

    def search(self, wanted: np.ndarray, weights: np.ndarray, every: np.ndarray, best: Best) -> None:
        """Add the block's documents for one item. ``every`` is a zero for each term, used and left zero."""
        if len(self.known) == 0 or len(wanted) == 0:
            return
        at = np.minimum(np.searchsorted(self.known, wanted), len(self.known) - 1)
        here = self.known[at] == wanted
        at, wanted, weights = at[here], wanted[here], weights[here]
        most = weights * self.greatest[at]
        if len(at) == 0 or int(most.sum()) < best.least:
            return
        docs, masks, greatest = self.masks(at, most)
        # Groups of one mask, by descending greatest score.
        order = np.argsort(-greatest, kind="stable")
        every[wanted] = weights
        done = 0
        while done < len(order) and greatest[order[done]] >= best.least:
            some = order[done:done + max(2 * best.top, done)]
            some = some[greatest[some] >= best.least]
            of_groups = docs[np.isin(masks, some)]
            best.add(self.scores(of_groups, every), self.ids[of_groups])
            done += len(some)
        every[wanted] = 0

    def masks(self, at: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents that hold any of the terms ``at``, the group of each, and each group's greatest score."""
        wide = -(-len(at) // 64)
        mask = np.zeros((len(self.ids), wide), dtype=np.uint64)
        for j, t in enumerate(at.tolist()):
            mask[self.doc[self.begin[t]:self.begin[t + 1]], j >> 6] |= np.uint64(1 << (j & 63))
        docs = np.flatnonzero(mask.any(axis=1))
        held = mask[docs]
        if wide == 1:
            distinct, group = np.unique(held[:, 0], return_inverse=True)
            distinct = distinct[:, None]
        else:
            _, first, group = np.unique(held.view(np.dtype((np.void, 8 * wide)))[:, 0], return_index=True, return_inverse=True)
            distinct = held[first]
        bits = np.unpackbits(distinct.view(np.uint8), axis=1, bitorder="little")[:, :len(at)]
        return docs, group, bits.astype(np.int64) @ most

    def scores(self, docs: np.ndarray, every: np.ndarray) -> np.ndarray:
        """The exact scores of documents (each with postings), by the weights ``every`` of all terms."""
        if len(docs) == 0:
            return np.zeros(0, np.int64)
        length = self.first[docs + 1] - self.first[docs]
        begin = np.cumsum(length) - length
        place = np.repeat(self.first[docs] - begin, length) + np.arange(int(length.sum()))
        return np.add.reduceat(every[self.term[place]] * self.share[place], begin)


def _item_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, texts in text_groups(batch.column(1), GROUP_BYTES):
            found = [set().union(*terms(t)) for t in texts]
            row = np.repeat(np.arange(start, start + len(texts)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array([t for f in found for t in f], pa.binary())], names=["item", "term"])


def _index(batches: Iterable[pa.RecordBatch], number: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, texts in text_groups(batch.column(1), GROUP_BYTES):
            n, held = [], []
            for text in texts:
                count: Counter = Counter()
                for part in terms(text):
                    count.update(map(number.get, part))
                n.append(sum(count.values()))
                count.pop(None, None)
                held.append(count)
            ends = pa.array(np.concatenate([[0], np.cumsum([len(c) for c in held])]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(values, pa.int32())) for values in ([t for c in held for t in c], [f for c in held for f in c.values()])]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), pa.array(n, pa.int64()), *lists], names=["doc", "n", "terms", "tf"])


def _search(batches: Iterable[pa.RecordBatch], items: Items, vocabulary: int, documents: int, total: int, top: int) -> Iterator[pa.RecordBatch]:
    best = [Best(top) for _ in items.terms]
    every = np.zeros(vocabulary, dtype=np.int64)
    for batch in batches:
        a = 0
        ends = batch.column(2).offsets.to_numpy()
        while a < batch.num_rows:
            b = min(int(np.searchsorted(ends, ends[a] + BLOCK_POSTINGS, side="right")) - 1, a + BLOCK_DOCS, batch.num_rows)
            b = max(b, a + 1)
            part = batch.slice(a, b - a)
            first = (ends[a:b + 1] - ends[a]).astype(np.int64)
            term, tf = (part.column(i).flatten().to_numpy().astype(np.int64) for i in (2, 3))
            m = lengths(part.column(1).to_pylist(), documents, total)
            block = Block(part.column(0).to_numpy(), first, term, shares(tf, np.repeat(m, np.diff(first))))
            for wanted, weights, found in zip(items.terms, items.weights, best):
                block.search(wanted, weights, every, found)
            a = b
    rows = [(i, -s, d) for i, found in enumerate(best) for s, d in found.rows]
    if rows:
        i, s, d = zip(*rows)
        yield pa.RecordBatch.from_arrays([items.ids.take(pa.array(i)), pa.array(d, pa.int64()), pa.array(s, pa.int64())], names=["item", "doc", "score"])


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
           top: int = TOP) -> DataFrame:
    """``item_col``, ``rank`` (from 1), ``id_col`` and ``score`` of the ``top`` documents of each item."""
    spark = docs.sparkSession
    kind = items.schema[item_col].dataType.simpleString()
    asked = items.where(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    asked = written(asked.mapInArrow(_item_terms, f"item {kind}, term binary").distinct(), "search-terms")
    size, = asked.agg(F.sum(F.octet_length("term") + 32)).first()
    blocks = -(-(size or 0) // BLOCK_BYTES)
    found = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        part = _of_block(docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")), rows, kind, top)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = empty(spark, T.StructType([T.StructField("item", items.schema[item_col].dataType), T.StructField("doc", T.LongType()), T.StructField("score", T.LongType())]))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score")


def _of_block(docs: DataFrame, asked: DataFrame, kind: str, top: int) -> DataFrame:
    """``item``, ``doc`` and ``score``: every task's best documents of the items of a block."""
    spark = docs.sparkSession
    told = asked.toArrow().combine_chunks()  # at most BLOCK_BYTES, or one item
    number = {t: i for i, t in enumerate(sorted(set(told.column("term").to_pylist())))}
    sent = spark.sparkContext.broadcast(number)
    index = written(docs.mapInArrow(lambda it: _index(it, sent.value), "doc bigint, n bigint, terms array<int>, tf array<int>"), "search-index")
    documents, total = index.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    held = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("f")).toArrow()
    weights = np.zeros(len(number), dtype=np.int64)
    weights[held.column("term").to_numpy()] = [weight(documents, f) for f in held.column("f").to_pylist()]
    coded = told.column("item").dictionary_encode().combine_chunks()
    coded = coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded
    term = np.fromiter(map(number.__getitem__, told.column("term").to_pylist()), np.int64, told.num_rows)
    item = coded.indices.to_numpy()
    order = np.lexsort([term, item])
    term, cut = term[order], np.searchsorted(item[order], np.arange(1, len(coded.dictionary)))
    known = [t[weights[t] > 0] for t in np.split(term, cut)]
    queries = spark.sparkContext.broadcast(Items(coded.dictionary, known, [weights[t] for t in known]))
    size = len(number)
    return index.where("doc is not null and size(terms) > 0").mapInArrow(
        lambda it: _search(it, queries.value, size, documents, total, top), f"item {kind}, doc bigint, score bigint")
