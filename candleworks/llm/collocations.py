"""Phrase collocations by Toivonen's sampling method (operator 11).

Texts are cut at sentence marks and line ends into pieces, pieces at spaces and tabs into
words (A-Z in lower case). Everything is counted per language. A phrase that occurs
``least`` times is frequent; only phrases whose parts are all frequent can be.

1. Sample: an eighth of the documents (by a hash of the row) is counted, one and two words at a time
   (in general up to one word less than the longest phrase). What reaches a lowered threshold
   there is the *proposal*.
2. Full pass: over all documents the proposal and its negative border are counted exactly.
   The border are the phrases outside the proposal whose parts (all but the last word, all but the
   first) lie inside; every word is in one of the two. So an occurrence is counted if its
   parts are proposed, and whatever is proposed or in the border is counted.
3. Expansion: border phrases that turn out frequent are failures of the sample. They are added to the
   proposal, and a further pass counts what they newly admit, until a pass adds nothing.
   Then every frequent phrase has been counted, by all of its occurrences, in one pass.

The proposal is sent to the tasks as a bit table of hashes (two bits an entry) whose size
is bounded (``MOST_BITS``), whatever the corpus. A hash that hits by chance admits a phrase
that needn't be counted; its count is exact, so results don't depend on the table. A phrase
is admitted by the table of one pass for the first time and is counted in that pass only.
Within a chunk of documents phrases are told apart by exact numbers of their words, after that by
their text. A chunk's phrases and counts travel packed, one row for each bucket of phrases (by hash);
a bucket is merged in one task. There are as many buckets as the corpus is large, and a frequent
phrase costs its bucket one entry per chunk, summed as they come.

A candidate phrase of two words or more is scored by its worst cut into two parts,
``floor(1000000 a a / (l r))``, in 38-digit integers. Candidates inside a longer one that
occurs at least half as often are dropped.

Cases: a null text counts as empty, a null language is ``und``; words of one text never meet those of
another; rows that repeat are counted as often as they occur; ties in score are ordered by frequency, then by the phrase's
bytes; texts of any length are counted whole, in slices that share their border words; an empty table
or one without frequent phrases gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candleworks.llm._store import written
from candleworks.llm._words import _BYTE_VALUE, _LOWER, _ODD, _POWERS, _buffers, mix

LEAST = 10
MOST_WORDS = 3
TOP = 2000
#: One of this many documents is in the sample.
SAMPLE_ONE_OF = 8
#: Share of the expected number that a phrase must reach in the sample to be proposed.
SAMPLE_SLACK = 0.8
#: Bits of the proposal's table: this many for each entry, up to a bound (32 MB).
BITS_EACH = 16
MOST_BITS = 1 << 28
#: Bytes of texts that are counted together.
CHUNK_BYTES = 4 << 20
#: Phrases are merged in buckets, one for this many bytes of text, so a bucket's size doesn't grow with the corpus.
BUCKET_BYTES = 4 << 20
BUCKETS_A_TASK = 8
#: Rows of a bucket that are held before they are summed.
MERGED_TOGETHER = 1_500_000
#: Parts of cuts that are looked up in a table of bounded size, as one task would get too many of them.
HOT_PARTS = 10_000
COUNTS = "lang string, phrase string, k int, f bigint"

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[0x0A, 0x0B, 0x0C, 0x0D, *b".,;:!?"]] = 2
_U = np.uint64


@dataclass
class Tokens:
    """Words of some texts: number of each word in ``names``, its text's and piece's number, its start."""

    word: np.ndarray
    text: np.ndarray
    piece: np.ndarray
    start: np.ndarray
    names: pa.Array


def tokens(data: np.ndarray, off: np.ndarray) -> Tokens:
    """The words of the texts that lie end to end in ``data``."""
    none = np.zeros(0, np.int64)
    if len(data) == 0:
        return Tokens(none, none, none, none, pa.array([], pa.binary()))
    data = _LOWER[data]
    kind = _KIND[data]
    solid = kind == 0
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[off] = True
    start = np.flatnonzero(solid & (~np.concatenate([[False], solid[:-1]]) | edge[:-1]))
    end = np.flatnonzero(solid & (~np.concatenate([solid[1:], [False]]) | edge[1:])) + 1
    text = np.repeat(np.arange(len(off) - 1), np.diff(np.searchsorted(start, off)))
    piece = np.cumsum((kind == 2) | edge[:-1])[start]
    # A text of no bytes shares its edge with the next one, so pieces of two texts always differ.
    places = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    flat = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(places), pa.py_buffer(data[solid])])
    coded = flat.dictionary_encode()
    return Tokens(coded.indices.to_numpy().astype(np.int64), text, piece, start, coded.dictionary)


def word_hashes(names: pa.Array) -> np.ndarray:
    """A 64-bit hash of every (non-empty) word."""
    if len(names) == 0:
        return np.zeros(0, np.uint64)
    names = names.cast(pa.large_binary())
    _, offsets, data = names.buffers()
    off = np.frombuffer(offsets, np.int64, len(names) + 1 + names.offset)[names.offset:]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]]
    length = np.diff(off)
    begin = off[:-1] - off[0]
    place = np.arange(len(raw)) - np.repeat(begin, length)
    value = _BYTE_VALUE[raw] * _POWERS.upto(int(length.max()) + 1)[place]
    return mix(np.add.reduceat(value, begin) + length.astype(np.uint64) * _ODD)


def lang_hashes(langs: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "little") for s in langs], dtype=np.uint64)


def extended(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of phrases with one more word, of the hashes of both."""
    return mix(phrase * _U(0xC6A4A7935BD1E995) + word)


class Proposal:
    """A set of phrase hashes as a bit table; it may hold more than was put in, never less."""

    def __init__(self, words: np.ndarray) -> None:
        self.words, self.mask = words, _U(len(words) * 64 - 1)

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return h & self.mask, (h >> _U(32)) & self.mask

    def has(self, h: np.ndarray) -> np.ndarray:
        x, y = self.places(h)
        bit = lambda p: (self.words[(p >> _U(6)).astype(np.int64)] >> (p & _U(63))) & _U(1)
        return (bit(x) & bit(y)).astype(bool)


def count_chunk(found: Tokens, lang_of: np.ndarray, langs: list[str], longest: int, now: Proposal | None, before: Proposal | None,
                own: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]]:
    """Distinct phrases of a chunk that ``now`` admits and ``before`` doesn't: their length,
    their languages' numbers, hashes, their words' numbers (one array for each place) and counts. Phrases that start at
    ``own`` or later are left out. No ``now`` admits all."""
    n = len(found.word)
    if n == 0:
        return
    width = len(found.names)
    # The number and hash of every distinct word of a language.
    distinct, number = _numbered(lang_of[found.text].astype(np.int64) * width + found.word, len(langs) * width)
    names = word_hashes(found.names)
    hashes = mix(names[distinct % width] ^ lang_hashes(langs)[distinct // width])
    mine = np.ones(n, bool) if own is None else found.start < own
    if before is None:
        yield 1, distinct // width, hashes, [distinct % width], np.bincount(number[mine], minlength=len(distinct))
    # For each place: whether the phrase that starts there is admitted, now and before, and its hash.
    holds = lambda table, h, ok: ok & table.has(h) if table else ok
    at = np.arange(n)
    phrase = hashes[number]
    is_now = holds(now, hashes, np.ones(len(distinct), bool))[number]
    was = holds(before, hashes, np.ones(len(distinct), bool))[number] if before else np.zeros(n, bool)
    for k in range(2, longest + 1):
        # A phrase of k words at i: those of k - 1 words at i and at i + 1, in one piece.
        ok = is_now[:-1] & is_now[1:] & (at[1:] == at[:-1] + 1)
        i = np.flatnonzero(ok)
        i = i[found.piece[at[i]] == found.piece[at[i] + k - 1]]
        at, was, phrase = at[i], was[i] & was[i + 1], extended(phrase[i], names[found.word[at[i] + k - 1]])
        if len(at) == 0:
            return
        new = np.flatnonzero(~was & mine[at])
        if len(new):
            first, count = _distinct([number[at[new]], *(found.word[at[new] + j] for j in range(1, k))], [len(distinct), *[width] * (k - 1)])
            first = new[first]
            yield k, distinct[number[at[first]]] // width, phrase[first], [found.word[at[first] + j] for j in range(k)], count
        is_now = holds(now, phrase, np.ones(len(at), bool))
        # A chance hit for a phrase that wasn't admitted itself admitted nothing.
        was = holds(before, phrase, was) if before else was


def _numbered(values: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values (below ``most``), sorted, and which of them each is."""
    if most > 8 * len(values) + 1024:
        return np.unique(values, return_inverse=True)
    held = np.zeros(most, bool)
    held[values] = True
    return np.flatnonzero(held), (np.cumsum(held) - 1)[values]


def _distinct(columns: list[np.ndarray], sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Of rows of numbers (each below its column's size): a row of each kind, and how many there are."""
    key, size = columns[0], sizes[0]
    for column, width in zip(columns[1:], sizes[1:]):
        if size * width >= 1 << 62:
            held, key = np.unique(key, return_inverse=True)
            size = len(held)
        key, size = key * width + column, size * width
    order = np.argsort(key, kind="stable")
    key = key[order]
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return order[begin], np.diff(np.concatenate([begin, [len(key)]]))


def long_slices(data: np.ndarray, most: int, longest: int) -> Iterator[tuple[np.ndarray, int]]:
    """Slices of a long text, with the number of bytes that are a slice's own; after them come
    the words that a phrase which starts before may go on with."""
    kind = _KIND[data]

    def next_of(solid: bool, at: int) -> int:
        while at < len(data):
            here = np.flatnonzero((kind[at:at + most] == 0) == solid)
            if len(here):
                return at + int(here[0])
            at += most
        return len(data)

    a = 0
    while a < len(data):
        b = end = next_of(False, a + most)
        for _ in range(longest - 1):
            end = next_of(False, next_of(True, end))
        yield data[a:end], b - a
        a = b


def _chunks(batch: pa.RecordBatch, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, slice, int | None]]:
    off, raw = _buffers(batch.column(1))
    n, a = batch.num_rows, 0
    while a < n:
        b = min(n, max(int(np.searchsorted(off, off[a] + CHUNK_BYTES, side="right")) - 1, a + 1))
        data = raw[off[a]:off[b]]
        if len(data) > CHUNK_BYTES:
            for part, own in long_slices(data, CHUNK_BYTES, longest):
                yield part, np.array([0, len(part)]), slice(a, b), own
        else:
            yield data, off[a:b + 1] - off[a], slice(a, b), None
        a = b


def _packed(bucket: np.ndarray, keys: pa.Array, count: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row per bucket: the bytes of its keys, one after the other, their lengths and counts, compressed."""
    order = np.argsort(bucket, kind="stable")
    bucket, keys, count = bucket[order], keys.take(pa.array(order)), count[order]
    begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    _, offsets, data = keys.buffers()
    off = np.frombuffer(offsets, np.int64, len(keys) + 1)
    length = np.diff(off).astype(np.int32)
    rows = []
    for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(bucket)]):
        body = count[a:b].astype(np.int64).tobytes() + length[a:b].tobytes() + memoryview(data)[off[a]:off[b]].tobytes()
        rows.append((int(bucket[a]), b - a, len(body), pa.compress(body, codec="zstd", asbytes=True)))
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.binary()))],
                                     names=["bucket", "n", "size", "body"])


def _unpacked(n: int, size: int, body: bytes) -> pa.Table:
    raw = pa.decompress(body, decompressed_size=size, codec="zstd", asbytes=True)
    ends = np.concatenate([[0], np.cumsum(np.frombuffer(raw, np.int32, n, 8 * n))]).astype(np.int64)
    keys = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(raw[12 * n:])])
    return pa.table({"key": keys, "f": np.frombuffer(raw, np.int64, n).copy()})


def _summed(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by("key", use_threads=False).aggregate([("f", "sum")]).rename_columns(["key", "f"])


def _count(batches: Iterable[pa.RecordBatch], longest: int, now: Proposal | None, before: Proposal | None, buckets: int) -> Iterator[pa.RecordBatch]:
    """The phrases of every chunk and their counts, packed by bucket. A key is language, line end and phrase (which holds
    no line end); a key without phrase counts a language's words."""
    for batch in batches:
        for data, off, at, own in _chunks(batch, longest):
            coded = batch.column(0).slice(at.start, at.stop - at.start).dictionary_encode()
            lang_of, langs = coded.indices.to_numpy(), coded.dictionary.to_pylist()
            found = tokens(data, off)
            names = found.names.cast(pa.large_binary())
            starts = pa.array([s.encode() + b"\n" for s in langs], pa.large_binary())
            for _, lang, hashes, parts, count in count_chunk(found, lang_of, langs, longest, now, before, own):
                if len(parts) == 1:
                    words = np.bincount(lang, weights=count, minlength=len(langs)).astype(np.int64)
                    having = np.flatnonzero(words)
                    if len(having):
                        yield from _packed((lang_hashes(langs)[having] % _U(buckets)).astype(np.int32), starts.take(pa.array(having)), words[having])
                some = np.flatnonzero(count)
                if len(some):
                    phrase = pc.binary_join_element_wise(*[names.take(pa.array(p[some])) for p in parts], pa.scalar(b" ", pa.large_binary()))
                    keys = pc.binary_join_element_wise(starts.take(pa.array(lang[some])), phrase, pa.scalar(b"", pa.large_binary()))
                    yield from _packed(((hashes[some] >> _U(32)) % _U(buckets)).astype(np.int32), keys, count[some])


def _merge(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """``lang``, ``phrase``, ``k``, ``f`` of the frequent phrases of every bucket, and the languages' words; rows of a bucket
    follow one another. What is held is summed whenever it has doubled."""
    bucket, held, rows, settled = None, [], 0, 0

    def done() -> pa.RecordBatch:
        whole = _summed(held)
        whole = whole.filter(pc.or_(pc.greater_equal(whole.column("f"), least), pc.ends_with(whole.column("key"), b"\n")))
        out = [(k.rsplit(b"\n", 1), c) for k, c in zip(whole.column("key").to_pylist(), whole.column("f").to_pylist())]
        phrases = [p.decode() or None for (_, p), _ in out]
        return pa.RecordBatch.from_arrays([pa.array([x.decode() for (x, _), _ in out], pa.string()), pa.array(phrases, pa.string()),
                                           pa.array([p.count(" ") + 1 if p else 0 for p in phrases], pa.int32()), pa.array([c for _, c in out], pa.int64())],
                                          names=["lang", "phrase", "k", "f"])

    for batch in batches:
        for at, n, size, body in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if at != bucket and held:
                yield done()
                held, rows, settled = [], 0, 0
            bucket = at
            held.append(_unpacked(n, size, body))
            rows += n
            if rows > max(MERGED_TOGETHER, 2 * settled):
                held = [_summed(held)]
                rows = settled = held[0].num_rows
    if held:
        yield done()


def _bits(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """``at`` and ``bits``: the words of a table of ``size`` bits that hold the phrases (``lang``, ``phrase``)."""
    table = Proposal(np.zeros(size // 64, np.uint64))
    for batch in batches:
        if batch.num_rows == 0:
            continue
        coded = batch.column(0).dictionary_encode()
        off, raw = _buffers(batch.column(1))
        found = tokens(raw[off[0]:off[-1]], off - off[0])
        names = word_hashes(found.names)
        first = np.searchsorted(found.text, np.arange(batch.num_rows + 1))
        count = np.diff(first)
        h = mix(names[found.word[first[:-1]]] ^ lang_hashes(coded.dictionary.to_pylist())[coded.indices.to_numpy()])
        for k in range(1, int(count.max())):
            more = np.flatnonzero(count > k)
            h[more] = extended(h[more], names[found.word[first[more] + k]])
        place = np.unique(np.concatenate(table.places(h)))
        at = place >> _U(6)
        begin = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        bits = np.bitwise_or.reduceat(_U(1) << (place & _U(63)), begin)
        yield pa.RecordBatch.from_arrays([pa.array(at[begin].astype(np.int32)), pa.array(bits.view(np.int64))], names=["at", "bits"])


def _proposal(phrases: DataFrame, size: int, held: np.ndarray | None) -> np.ndarray:
    """The bit table of the phrases, and of what ``held`` has. The driver sees its words only."""
    words = np.zeros(size // 64, np.uint64) if held is None else held.copy()
    made = phrases.select("lang", "phrase").mapInArrow(lambda it: _bits(it, size), "at int, bits bigint").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    words[made.column("at").to_numpy()] |= made.column("bits").to_numpy().view(np.uint64)
    return words


def _counts(rows: DataFrame, longest: int, least: int, buckets: int, now=None, before=None) -> DataFrame:
    """Phrases that occur ``least`` times in ``rows`` (and are admitted), and the words of each language."""
    table = lambda sent: Proposal(sent.value) if sent is not None else None
    found = rows.mapInArrow(lambda it: _count(it, longest, table(now), table(before), buckets), "bucket int, n int, size bigint, body binary")
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-buckets // BUCKETS_A_TASK))
    merged = found.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(lambda it: _merge(it, least), COUNTS)
    return written(merged, "phrase-counts")


def mine(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", longest: int = MOST_WORDS, least: int = LEAST) -> DataFrame:
    """``lang``, ``phrase``, ``k`` (its words) and ``f`` of every phrase of up to ``longest`` words that occurs
    ``least`` times, and a row without phrase, of the number of words, for every language that has any."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    sample = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(SAMPLE_ONE_OF)) == 0).select("lang", "text")
    rows = rows.select("lang", "text")
    size, = rows.agg(F.sum(F.octet_length("text"))).first()
    buckets = max(1, (size or 0) // BUCKET_BYTES)
    likely = max(2, int(least / SAMPLE_ONE_OF * SAMPLE_SLACK))
    proposed = _counts(sample, longest - 1, likely, buckets).where("phrase is not null")
    size = 1 << min(MOST_BITS.bit_length() - 1, max(16, (BITS_EACH * proposed.count()).bit_length()))
    held = _proposal(proposed, size, None)
    before = None
    now = spark.sparkContext.broadcast(held)
    counted = None
    while True:
        part = _counts(rows, longest, least, buckets, now, before)
        counted = part if counted is None else counted.unionByName(part)
        # Failures of the border: frequent, shorter than the longest, and not in the proposal.
        new = part.where(F.col("phrase").isNotNull() & (F.col("k") < longest)).join(proposed, ["lang", "phrase"], "left_anti")
        if new.isEmpty():
            return counted
        new = written(new, "phrase-failures")
        proposed = proposed.unionByName(new)
        held = _proposal(new, size, held)
        before, now = now, spark.sparkContext.broadcast(held)


def _words(a: Column, b: Column) -> Column:
    """Words ``a`` (from 1) to ``b`` of a phrase."""
    return F.array_join(F.slice(F.split("phrase", " "), a, b - a + 1), " ")


def _looked_up(cuts: DataFrame, total: int, counts: DataFrame, part: str, name: str) -> DataFrame:
    """``cuts`` with the count ``name`` of the phrase in column ``part``. Parts of very many cuts, of which there are at most
    ``HOT_PARTS``, are sent to every task; the others are joined."""
    hot = cuts.groupBy("lang", part).agg(F.count(F.lit(1)).alias("cuts")).where(F.col("cuts") > max(1000, total // HOT_PARTS)).select("lang", part)
    count = counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
    hot = written(count.join(hot, ["lang", part], "left_semi"), "phrase-hot-parts")
    marked = cuts.join(F.broadcast(hot), ["lang", part], "left")
    rest = marked.where(F.col(name).isNull()).drop(name).join(count, ["lang", part])
    return marked.where(F.col(name).isNotNull()).unionByName(rest)


def collocations(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", longest: int = MOST_WORDS,
                 least: int = LEAST, top: int = TOP, percent: int = 50) -> DataFrame:
    """The ``top`` candidates of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``. Candidates inside
    a longer one with ``percent`` of their occurrences are left out."""
    counts = mine(docs, id_col, text_col, lang_col, longest, least)
    words = counts.where("phrase is null").groupBy("lang").agg(F.sum("f").alias("n"))
    phrases = counts.where("phrase is not null")
    longer = phrases.where("k > 2").select("lang", F.col("f").alias("whole"), "phrase", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"), "k").select(
        "lang", "whole", "phrase", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("from"))
    longer = longer.select("lang", _words(F.col("from"), F.col("from") + F.col("size") - 1).alias("phrase"), "whole").groupBy("lang", "phrase").agg(F.max("whole").alias("whole"))
    stays = F.col("whole").isNull() | (F.col("whole") * 100 < F.col("f") * percent)
    candidates = phrases.where("k > 1").join(longer, ["lang", "phrase"], "left").where(stays)
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = written(cuts.select("lang", "phrase", "a", "cut", _words(F.lit(1), F.col("cut")).alias("head"), _words(F.col("cut") + 1, F.col("k")).alias("tail")), "phrase-cuts")
    total = cuts.count()
    both = _looked_up(_looked_up(cuts, total, phrases, "head", "l"), total, phrases, "tail", "r")
    scored = both.withColumn("score", F.expr("(1000000 * cast(a as decimal(38,0)) * a) div (cast(l as decimal(38,0)) * r)"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("w")).select("lang", "phrase", "a", "w.l", "w.r", "w.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salts = max(1, isqrt(total // top))
    part = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts))).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
